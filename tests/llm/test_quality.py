import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from quern.llm import quality, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").withColumn("grade", F.col("quality") * (2 - F.col("toxic")))
    train = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 > 0)
    model = quality.train(docs, train, "doc_id", "text", "grade", 3)
    assert model.thresholds[0] < model.thresholds[1]
    held = quality.score(docs, "text", model, 3, 2, 0.3).join(labels.join(train, "doc_id", "left_anti"), "doc_id").toPandas()
    clean, junk = held[held["grade"] == 2], held[held["grade"] == 0]
    assert clean["kept"].mean() > 0.9 and junk["kept"].mean() < 0.3
    assert ((held["expected_grade"] >= 0) & (held["expected_grade"] <= 2)).all()
    assert all(a >= b for a, b in held["tail"])


def test_gradient():
    """A fit separates what can be separated, and orders its thresholds."""
    r = np.random.default_rng(0)
    rows, grades = [], []
    for _ in range(600):
        g = int(r.integers(0, 3))
        rows.append(np.unique(np.concatenate([r.integers(10, 500, 20), [g]])).astype(np.int32))
        grades.append(g)
    m = quality.fit(rows, np.array(grades), 3, 512)
    score = np.array([m.weights[x].sum() for x in rows])
    assert ((m.tails(score) > 0.5).sum(axis=1) == np.array(grades)).mean() > 0.97


def loss(rows, grades, w, free, ridge):
    """The penalised mean negative log-likelihood of a cumulative-link model, from its definition."""
    cuts = [free[0]]
    for x in free[1:]:
        cuts.append(cuts[-1] + math.exp(x))
    total = 0.0
    for slots, g in zip(rows, grades):
        score = sum(w[i] for i in slots)
        below = [0.0, *[1 / (1 + math.exp(score - c)) for c in cuts], 1.0]  # P(grade < k)
        total -= math.log(below[g + 1] - below[g])
    return total / len(rows) + ridge / 2 * (sum(x * x for x in w) + sum(x * x for x in free))


def test_fit_is_the_minimum():
    """No direction leads down from the fit: numeric slopes of the definition vanish there."""
    r, ridge, buckets = np.random.default_rng(1), 0.02, 12
    rows = [np.unique(r.integers(0, buckets, 4)).astype(np.int32) for _ in range(90)]
    grades = np.array([min(2, max(0, int(x[0]) // 3 + int(r.integers(-1, 2)))) for x in rows])
    m = quality.fit(rows, grades, 3, buckets, steps=4000, rate=0.01, ridge=ridge, lasso=0.0)
    free = np.array([m.thresholds[0], math.log(m.thresholds[1] - m.thresholds[0])])
    point = np.concatenate([m.weights.astype(float), free])
    at = lambda p: loss(rows, grades, p[:buckets], p[buckets:], ridge)
    for i in range(len(point)):
        step = np.zeros(len(point))
        step[i] = 1e-4
        assert abs(at(point + step) - at(point - step)) / 2e-4 < 2e-4, i
    for _ in range(50):
        assert at(point + r.normal(0, 0.05, len(point))) > at(point)


def plain_features(text):
    """Features character by character: written for the test."""
    found, now, kind = [], "", None
    for c in text + " ":
        k = "word" if c.isalnum() or c == "_" or (not c.isspace() and re.match(r"\w", c)) else None if c.isspace() else "symbol"
        if k != kind and now:
            found.append((kind, now))
            now = ""
        kind, now = k, now + c if k else ""
    out, words, symbols = set(), [], 0
    for k, w in found:
        if w[0].isalnum():
            words.append(w.lower())
        else:
            out.add(w)
            symbols += len(w)
    out |= set(words) | {"^" + w[:5] for w in words if len(w) > 5}
    lines = [x for x in text.split("\n") if x.strip()]
    n, level = max(1, len(text)), lambda x: math.floor(x * 8 + 0.5)
    out.add(f"\tcapital {level(len([c for c in text if c.isupper()]) / n)}")
    out.add(f"\tsymbol {level(2 * symbols / n)}")
    out.add(f"\trepeated {level(1 - len(set(words)) / max(1, len(words)))} {min(4, len(words).bit_length() // 2)}")
    out.add(f"\tlines {level(1 - len(set(lines)) / max(1, len(lines)))}")
    return out


def test_score_is_a_sum(spark, edge, small):
    docs = spark.createDataFrame(small[["doc_id", "text"]])
    model = quality.Model(np.arange(64, dtype=np.float32) / 64 - 0.5, np.array([-1.0, 1.0]))
    for df in (docs, edge):
        for r in quality.score(df, "text", model, 3, 2, 0.5).collect():
            want = sum(float(model.weights[quality.slot(t, 64)]) for t in quality.tokens(r["text"] or ""))
            assert abs(r["score"] - want) < 1e-4
            assert abs(r["tail"][1] - 1 / (1 + np.exp(1.0 - want))) < 1e-5 and r["kept"] == (r["tail"][1] >= 0.5)


def test_edges(spark, edge, empty):
    labels = spark.createDataFrame([(2, 0), (3, 2), (3, 1), (None, 1), (4, None), (4, 2)], "doc_id long, grade int")
    model = quality.train(edge, labels, "doc_id", "text", "grade", 3)
    out = quality.score(edge, "text", model, 3, 2, 0.3)
    assert out.count() == edge.count() and set(edge.columns) <= set(out.columns)
    assert quality.score(empty, "text", model, 3, 2, 0.3).count() == 0
    assert quality.train(edge, labels.limit(0), "doc_id", "text", "grade", 3) is None
    none = quality.score(edge, "text", None, 3, 2, 0.3)
    assert none.where("kept").count() == edge.count()
    assert quality.train(edge, labels, "doc_id", "text", "grade", 3, max_labelled=1) is not None


def test_query(spark):
    out = queries.op1_quality_classifier(spark, "/root/testdata/sf0.001")
    assert out.count() == 200 and out.where("kept IS NULL").count() == 0
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = queries.quality_model(spark, docs, "/root/testdata/sf0.001")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in out.collect():
        score = sum(float(model.weights[zlib.crc32(t.encode()) % len(model.weights)]) for t in plain_features(texts[r["doc_id"]]))
        tails = [1 / (1 + math.exp(c - score)) for c in model.thresholds]
        assert abs(r["score"] - score) < 1e-4 and abs(r["expected_grade"] - sum(tails)) < 1e-4 and abs(r["p_at_least_2"] - tails[1]) < 1e-4
        assert r["kept"] == (r["p_at_least_2"] >= 0.3)
