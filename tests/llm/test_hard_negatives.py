import math
import random

import pytest
from pyspark.sql import functions as F

from quern.llm import hard_negatives


def brute(rows, k=5, low=80, limit=1 << 63):
    width = max((len(v) for _, _, v in rows if v), default=0)
    fit = lambda v: v and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v)
    good = [(i, y, [math.floor(256 * x) for x in [*v, *[0.0] * (width - len(v))]]) for i, y, v in rows if i is not None and y is not None and fit(v)]
    out = []
    for a, label, v in good:
        if a % 100:
            continue
        scored = [(max(-limit, min(limit - 1, sum(x * z for x, z in zip(v, w)))), i, y == label) for i, y, w in good if i != a]
        for s, p in sorted(((-s, i) for s, i, same in scored if same))[:k]:
            fits = sorted((-n, i) for n, i, same in scored if not same and low * -s <= 100 * n <= 100 * -s)
            out += [(a, p, r + 1, i, -s, -n) for r, (n, i) in enumerate(fits[:k])]
    return sorted(out)


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns({"id": F.lit("x"), "asks": F.lit(1), "norm": F.lit(2)}).repartition(5)
    return sorted(tuple(r) for r in hard_negatives.mine(df, "vec_id", "label", "embedding", F.col("vec_id") % 100 == 0, **more).collect())


def clouds(n, dims=6, seed=4):
    r = random.Random(seed)
    centre = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    return [(i, r.randrange(4), [c + r.gauss(0, 0.4) for c in centre[r.randrange(4)]]) for i in range(n)]


@pytest.mark.parametrize("more", [{}, {"k": 2, "low": 50}, {"block_bytes": 100}])
def test_against_brute_force(spark, more):
    rows = clouds(700)
    own = {k: v for k, v in more.items() if k != "block_bytes"}
    assert run(spark, rows, **more) == brute(rows, **own) != []


def test_buckets_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BUCKET", 16)
    long, short = clouds(200), [(i, y, [x / 1000 for x in v]) for i, y, v in clouds(400)[200:]]
    assert run(spark, long + short) == brute(long + short)
    # rows without a chance are not multiplied
    seen = []
    products = hard_negatives._products
    monkeypatch.setattr(hard_negatives, "_products", lambda a, r: (seen.append(len(r)), products(a, r))[1])
    import numpy as np
    import pyarrow as pa

    vectors = np.array([[x] for x in [100.0] * 16 + [1.0] * 64])
    batch = pa.RecordBatch.from_arrays([pa.array(range(1, 81)), pa.array([0] * 80), pa.array(np.abs(vectors[:, 0])), pa.array(list(vectors))], names=["id", "label", "norm", "whole"])

    class sent:
        value = ((np.array([0]), np.array([1]), np.array([10.0]), np.array([[10.0]])), (np.array([0]), np.array([800]), np.array([1000])))

    found = next(hard_negatives._search(iter([batch]), sent, False, 5)).to_pydict()
    assert found["id"] == [1, 2, 3, 4, 5] and seen == [16]


def test_ties_copies_and_a_hot_label(spark):
    rows = [(i, 1, [1.0, 2.0]) for i in range(300)] + [(i, 2, [1.0, 2.0]) for i in range(300, 330)] + [(i, 2, [0.9, 1.9]) for i in range(330, 350)]
    assert run(spark, rows) == brute(rows)


def test_edges(spark):
    rows = [
        (0, 1, [1.0, 2.0]), (1, 1, [1.0, 1.5]), (2, 2, [1.0, 1.4]), (3, None, [9.0, 9.0]), (None, 1, [9.0, 9.0]), (4, 2, None), (5, 2, []), (6, 2, [float("nan"), 1.0]), (7, 2, [float("inf"), 1.0]),
        (8, 2, [None, 1.0]), (9, 2, [2.0]), (10, 1, [-5.0, -5.0]), (100, 3, [1.0, 1.0]), (200, 2, [0.0, 0.0]), (11, 2, [1e308, 1.0]), (12, 1, [1e18, 1e18]), (13, 2, [9e17, 1e18]), (300, 1, [1e18, 0.5]),
    ]
    assert run(spark, rows) == brute(rows) != []
    assert run(spark, []) == [] and run(spark, [(1, 1, [1.0])]) == [] and run(spark, [(0, 1, [1.0])]) == []


def test_repeated_rows(spark):
    rows = [(0, 1, [1.0, 1.0])] * 2 + [(1, 1, [1.0, 0.9])] * 2 + [(2, 2, [0.9, 0.9])] * 3
    assert run(spark, rows) == brute(rows)
    assert len(run(spark, rows)) == 2 * 2 * 3


def test_query(spark):
    from quern.llm import queries

    rows = [(r["vec_id"], (r["label"] + (r["vec_id"] % 7 == 0)) % 10, list(r["embedding"])) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in queries.op11_hard_negatives(spark, "/root/testdata/sf0.001").collect()) == brute(rows)
