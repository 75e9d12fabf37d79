"""Operators on small inline tables."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.functions import chars
from quern.operators import dedup, links, metrics, order, quality, sample, shards, split


def test_quality_bounds(spark):
    hindi = "नमस्ते दुनिया यह एक वाक्य है "
    rows = [(0, "क" * 30), (1, "क" * 29), (2, "क" * 60 + "a" * 40), (3, "क" * 59 + "a" * 41), (4, "क" * 70 + "1" * 30), (5, "क" * 69 + "1" * 31), (6, ""), (7, None), (8, hindi * 10), (9, "क" * 74 + "!" * 26)]
    df = quality.annotate(spark.createDataFrame(rows, "i int, text string"), "text", quality.QualityRules())
    reasons = {r["i"]: r["reject_reason"] for r in df.collect()}
    assert reasons == {0: None, 1: "too_short", 2: None, 3: "script_ratio", 4: None, 5: "digits", 6: "script_ratio", 7: "script_ratio", 8: None, 9: "symbols"}
    passed, rejected = quality.split_passed(df)
    assert passed.count() + rejected.count() == len(rows)


def test_cleaning_reasons(spark):
    good = "यह एक अच्छा वाक्य है और यह लंबा भी है"
    rows = [
        (good, good, None), (good, "", "empty_output"), (good, "  ", "empty_output"), (good, None, "empty_output"), (good, "छोटा", "output_too_short"), (good * 3, good, "output_compressed"),
        (good, good * 2, "output_expanded"), ("", good, None), ("a" * 40, "a" * 40, "script_ratio_low"), (good * 4, good * 4 + " Cleaned Hindi text: ", "prompt_echo_detected"),
        ("\n".join([good] * 3), "\n\n".join([good] * 3), "repeated_lines"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, raw string, cleaned string, want string")
    got = quality.validate(df, "raw", "cleaned", quality.CleaningRules()).orderBy("i").collect()
    assert [r["rejection_reason"] for r in got] == [r["want"] for r in got]
    assert all((r["cleaning_status"] == "clean") == (r["want"] is None) for r in got)


def test_exact_keeps_first(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (4, None), (5, "")], "id int, text string")
    assert sorted(r["id"] for r in dedup.exact(df, "text", "id").collect()) == [1, 2, 4]


def test_exact_and_near_with_nulls_and_repeats(spark):
    rows = [(1, "a"), (1, "a"), (None, "only here"), (2, "b"), (None, "b"), (None, "only here"), (None, None), (3, "")]
    df = spark.createDataFrame(rows, "id int, text string")
    want = [(1, "a"), (2, "b"), (3, ""), (None, "only here")]
    assert sorted(((r["id"], r["text"]) for r in dedup.exact(df, "text", "id").collect()), key=repr) == sorted(want, key=repr)
    for found in (dedup.near(df, "id", "text", "id"), dedup.deduplicate(df, "id", "text", "id")):
        assert sorted(((r["id"], r["text"]) for r in found.collect()), key=repr) == sorted(want, key=repr)
    assert dedup.canonical(df, "id", "text").count() == len(rows)


def test_shingle_hashes(spark):
    texts = ["", "a", "a b", "a b c d", "x y x y x y"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["h"] for r in df.select("i", dedup.shingle_hashes(chars.words(F.col("t"))).alias("h")).orderBy("i").collect()]
    for t, hashes in zip(texts, got):
        w = t.split()
        runs = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
        assert hashes == [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) % dedup.PRIME for x in runs]


def test_shingles(spark):
    df = spark.createDataFrame([(0, ""), (1, "a"), (2, "a b"), (3, "a b c"), (4, "a b c a b c"), (5, None)], "i int, t string")
    got = [r["s"] for r in df.select("i", dedup.shingles(F.col("t")).alias("s")).orderBy("i").collect()]
    assert got == [[""], ["a"], ["a b"], ["a b c"], ["a b c", "b c a", "c a b"], [""]]


def test_near_does_not_chain(spark):
    base = [f"w{i}" for i in range(300)]
    near = base.copy()
    near[150] = "changed"
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(f"z{i}" for i in range(300))), (4, " ".join(base)), (5, ""), (6, "")]
    got = {r["id"]: r["canonical_id"] for r in dedup.canonical(spark.createDataFrame(rows, "id int, text string"), "id", "text").collect()}
    assert got[1] == got[4] == "1" and got[3] == "3" and got[5] == got[6] == "5"
    kept = dedup.deduplicate(spark.createDataFrame(rows, "id int, text string"), "id", "text", "id")
    assert {r["id"] for r in kept.collect()} >= {1, 3, 5}


def test_signature_is_a_minimum():
    words = "a b c d e".split()
    a, b = dedup.permutations()
    hashes = [int(hashlib.md5(" ".join(words[i : i + 3]).encode()).hexdigest()[:8], 16) % dedup.PRIME for i in range(3)]
    assert dedup.signature(np.array(hashes)).tolist() == [min((int(x) * h + int(y)) % dedup.PRIME for h in hashes) for x, y in zip(a, b)]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50])
def test_split(spark, n):
    df = spark.createDataFrame([(f"d{i}", p) for i in range(n) for p in range(3)], "document_id string, p int")
    rows = split.by_document(df, "document_id", 7, 0.1, 0.1).collect()
    assert len(rows) == 3 * n
    by = {}
    for r in rows:
        by.setdefault(r["document_id"], set()).add(r["split_name"])
    assert all(len(s) == 1 for s in by.values())
    sizes = {s: sum(x == {s} for x in by.values()) for s in metrics.SPLITS}
    want = {0: (0, 0, 0), 1: (0, 0, 1), 2: (0, 1, 1), 3: (1, 1, 1), 50: (40, 5, 5)}[n]
    assert tuple(sizes.values()) == want
    assert sorted(map(tuple, split.by_document(df, "document_id", 7, 0.1, 0.1).collect())) == sorted(map(tuple, rows))


def test_packed_split_sizes(spark):
    rows = split.by_file(spark.range(92_332).select(F.lit("f").alias("file"), F.col("id").alias("sequence")), "file", "sequence")
    assert {r["split_name"]: r["count"] for r in rows.groupBy("split_name").count().collect()} == {"train": 90_486, "validation": 923, "test": 923}


def test_running_sums(spark):
    rows = [(i, i % 3, (i * 37) % 11) for i in range(400)]
    got = {r["k"]: r["o"] for r in order.running(spark.createDataFrame(rows, "k int, g int, v int"), 5, "k", F.col("v"), "o", by=("g",)).collect()}
    for g in range(3):
        total = 0
        for k, _, v in sorted((r for r in rows if r[1] == g), key=lambda r: hashlib.md5(f"5:{r[0]}".encode()).hexdigest()):
            assert got[k] == total
            total += v


def test_running_keeps_null_keys_and_the_natural_order(spark):
    rows = [(k, g, n) for n, (k, g) in enumerate([(None, "a"), (5, "a"), (2, "a"), (None, None), (9, None), (7, "b")], 1)]
    df = spark.createDataFrame(rows, "k long, g string, v long")
    got = {r["v"]: r["o"] for r in order.running(df, None, "k", F.col("v"), "o", by=("g",), rows=1).collect()}
    assert got == {1: 0, 3: 1, 2: 4, 4: 0, 5: 4, 6: 0}
    assert sorted(r["o"] for r in order.running(df, None, "k", F.lit(1), "o", rows=2).collect()) == list(range(6))
    assert sorted(r["o"] for r in order.running(df, 3, "k", F.lit(1), "o", rows=2).collect()) == list(range(6))
    assert order.running(df.limit(0), None, "k", F.lit(1), "o").count() == order.running(df.limit(0), 1, "k", F.lit(1), "o", by=("g",)).count() == 0
    assert sample.budget(df.withColumn("t", F.lit("x")), "k", "t", 10**9).count() == len(rows)


def test_buffer_shuffle(spark):
    got = sorted((r["place"], r["id"]) for r in order.buffer_shuffle(spark.range(100), "id", 30, 7).collect())
    assert [p for p, _ in got] == list(range(100)) and [i for _, i in got] != list(range(100))
    for at in range(0, 100, 30):
        assert {i for p, i in got if at <= p < at + 30} == set(range(at, min(100, at + 30)))


def test_batches(spark):
    rows = [("p0", i, [i]) for i in range(5)] + [("p1", i, [10 + i]) for i in range(8)]
    df = spark.createDataFrame(rows, "part string, n long, ids array<int>")
    flat = [r[2][0] for r in rows]
    one = sorted((r["batch"], r["place"], r["ids"]) for r in shards.batches(df, "part", "n", "ids", 4).collect())
    assert [x[2] for x in one] == [[v] for v in flat[:12]] and {x[0] for x in one} == {0, 1, 2}
    two = sorted((r["batch"], r["place"], r["ids"]) for r in shards.batches(df, "part", "n", "ids", 2, factor=3).collect())
    assert [x[2] for x in two] == [flat[i : i + 3] for i in range(0, 12, 3)]
    assert shards.batches(df.limit(0), "part", "n", "ids", 2).count() == 0


def test_chunked_lines(spark):
    r = random.Random(4)
    texts = ["x" * r.randint(0, 60) for _ in range(80)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    lines, total, held, chunk, seen = [], 0, 0, 0, 0
    for i, t in enumerate(texts):
        seen += 1
        if len(t) < 20:
            continue
        n = len(t) + 12
        if total + n > 2000:
            break
        if held + n > 300 and held:
            chunk, held = chunk + 1, 0
        held, total = held + n, total + n
        lines.append((i, n, chunk))
    found = shards.chunked_lines(df, "i", "text", 300, 2000).cache()
    assert sorted((x["i"], x["size"], x["chunk"]) for x in found.collect()) == lines
    assert tuple(shards.download_counts(df, found, "i", "text").first()) == (seen, len(lines), total, chunk + 1)
    all_ = shards.chunked_lines(df, "i", "text", 300, 10**9)
    assert shards.download_counts(df, all_, "i", "text").first()["rows_seen"] == 80
    assert tuple(shards.download_counts(df, shards.chunked_lines(df, "i", "text", 300, 1), "i", "text").first())[1:] == (0, 0, 0)


def test_strata(spark):
    df = spark.createDataFrame([(i, f"s{i % 3}" if i % 7 else None, p) for i in range(120) for p in range(2)], "d long, s string, p int")
    rows = split.by_stratum(df, "d", "s", 3, 0.1, 0.1).collect()
    assert len(rows) == 240
    for s in (None, "s0", "s1", "s2"):
        ids = {r["d"]: r["split_name"] for r in rows if r["s"] == s}
        n = len(ids)
        part = max(1, round(n * 0.1))
        assert sorted(ids.values()) == sorted(["train"] * (n - 2 * part) + ["validation"] * part + ["test"] * part)


def test_budgets(spark):
    df = spark.createDataFrame([(i, "x" * 9) for i in range(100)], "i int, t string")
    assert sample.budget(df, "i", "t", 95).count() == 10 and sample.budget(df, "i", "t", 95, overshoot=False).count() == 9
    assert sample.budget(df, "i", "t", 1).count() == 1 and sample.budget(df, "i", "t", 1, overshoot=False).count() == 0
    ids = lambda s: {r["i"] for r in sample.budget(df, "i", "t", 300, s).collect()}
    assert ids(1) == ids(1) != ids(2)


def test_tokenizer_sample(spark):
    good = "यह एक अच्छा वाक्य है और यह लंबा भी है"
    df = spark.createDataFrame([(1, good), (2, "short"), (3, "a" * 100), (4, None), (5, good + "\n" + good)], "i int, t string")
    assert {r["i"] for r in sample.tokenizer_sample(df, "i", "t", chars.DEVANAGARI, 10_000).collect()} == {1, 5}


def test_next_fit(spark):
    sizes = [5, 5, 1, 20, 3, 0, 7, 10, 1]
    assert shards.fill(np.array(sizes), 10).tolist() == [0, 0, 1, 2, 3, 3, 3, 4, 5]
    r = random.Random(3)
    rows = [("s", i, r.randint(1, 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "s string, i long, n long")
    one = {x["i"]: x["shard"] for x in shards.next_fit(df, "s", "i", "n", 30).collect()}
    assert [one[i] for i in range(200)] == shards.fill(np.array([n for *_, n in rows]), 30).tolist()
    many = {x["i"]: x["shard"] for x in shards.next_fit(df, "s", "i", "n", 30, blocks=4).collect()}
    used = {}
    for i, s in many.items():
        used[s] = used.get(s, 0) + rows[i][2]
    assert sorted(used) == list(range(len(used))) and max(used.values()) <= 30 and [many[i] for i in range(200)] == sorted(many.values())


def test_windows(spark):
    r = random.Random(1)
    rows = [("f", i, [r.randint(0, 99) for _ in range(r.randint(0, 40))]) for i in range(60)] + [("g", 0, [1, 2])]
    flat = [t for _, _, ts in rows[:60] for t in ts]
    df = spark.createDataFrame(rows, "f string, i int, ids array<int>")
    got = sorted((x["sequence"], x["input_ids"]) for x in shards.windows(df, "f", "i", "ids", 16).collect())
    assert [g[1] for g in got] == [flat[k : k + 16] for k in range(0, len(flat) - 15, 16)]
    double = sorted((x["sequence"], x["input_ids"]) for x in shards.joined_windows(shards.windows(df, "f", "i", "ids", 16), "f", 2).collect())
    assert [d[1] for d in double] == [flat[k : k + 32] for k in range(0, len(flat) // 32 * 32, 32)][: len(double)] and len(double) == len(got) // 2


def test_gate_and_choice(spark):
    schema = "variant_name string, vocab_size int, unk_rate double, chars_per_token double, tokens_per_word double, roundtrip_success_rate double, devanagari_char_coverage double, special_token_split_failures int"
    rows = [("a", 24_000, 0.0, 4.0, 1.2, 1.0, 1.0, 0), ("b", 32_000, 0.0, 4.0, 1.2, 1.0, 1.0, 0), ("c", 48_000, 0.0, 3.0, 1.2, 1.0, 1.0, 0)]
    assert metrics.recommended(spark.createDataFrame(rows, schema)).first()["variant_name"] == "b"
    with pytest.raises(ValueError):
        metrics.recommended(spark.createDataFrame(rows[2:], schema))


def test_metrics_without_rows(spark):
    empty = spark.createDataFrame([], "text string, ids array<int>")
    assert tuple(metrics.token_metrics(empty, F.col("text"), F.col("ids"), 0, F.col("text")).first()) == (0.0, 0.0, 0.0, 0.0)
    assert metrics.coverage(metrics.distinct_chars(empty, "text", chars.DEVANAGARI), F.lit(True)).first()["char_coverage"] == 1.0
    assert metrics.perplexity(spark.createDataFrame([], "loss double"), "loss").first()["perplexity"] == 1.0
    assert {r["split_name"]: r["records"] for r in metrics.profile(spark.createDataFrame([], "split_name string, char_count long, word_count long, estimated_token_count long"), spark).collect()} == dict.fromkeys(metrics.SPLITS, 0)


def test_model_arithmetic(spark):
    got = {r["tier"]: r["p"] for r in metrics.tiers(spark).select("tier", metrics.parameters().alias("p")).collect()}
    assert got["SMALL"] == 46_541_312


def test_latest_and_best(spark):
    paths = spark.createDataFrame([("c/step_9",), ("c/step_100",), ("c/final",)], "path string")
    assert metrics.latest(paths, "path").first()["path"] == "c/step_100"
    assert metrics.best(spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)], "n string, l double"), "n", "l").first()["n"] == "a"


def test_crawl(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")], "source string, target string")
    seeds = spark.createDataFrame([("a",)], "title string")
    assert {r["title"]: r["depth"] for r in links.crawl(edges, seeds, 2).collect()} == {"a": 0, "b": 1, "c": 2}
    assert {r["title"] for r in links.crawl(edges, seeds, 9, max_pages=2).collect()} == {"a", "b"}
    assert {r["prefix"]: r["titles"] for r in links.crawl_index(links.crawl(edges, seeds, 9)).collect()} == {"a": ["a"], "b": ["b"], "c": ["c"], "d": ["d"]}


def test_crawl_seeds(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "b"), ("c", "a")], "source string, target string")
    got = sorted((r["seed"], r["title"], r["depth"]) for r in links.crawl_seeds(edges, spark.createDataFrame([("a",), ("x",)], "title string"), 2).collect())
    assert got == [("a", "a", 0), ("a", "b", 1), ("a", "c", 2), ("x", "b", 1), ("x", "c", 2), ("x", "x", 0)]


def test_violations(spark):
    df = spark.createDataFrame([("r", "pdf", 1, 0.5), (None, "web", -1, 1.5)], "record_id string, source_type string, char_count long, quality_score double")
    assert [r["violations"] for r in quality.violations(df).collect()] == [["record_id", "char_count", "quality_score", "source_type"]]


def test_encode_decode(spark):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame([("नमस्ते hello",), ("",)], "t string")
    back = shards.decode(shards.encode(df, "t", path), "ids", path, "back").collect()
    assert all(r["t"] == r["back"] for r in back)
