"""A key that holds a third of the rows, null keys and a query id that repeats are dealt to many tasks."""

from collections import defaultdict

from pyspark.sql import functions as F

from quern.llm import sharding, top_k

from .test_top_k import brute, run


def test_slots_of_hot_keys(spark, monkeypatch):
    tables, written = {}, sharding.written
    monkeypatch.setattr(sharding, "written", lambda df, name: tables.setdefault(name, written(df, name)))
    hot = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id"))
    df = spark.range(60_000).select(hot.alias("doc_id"), (F.col("id") % 5).alias("t"), F.create_map(F.lit("k"), "id").alias("m"))
    made = sharding.shard(df, "doc_id", [1.0] * 3, grown=1.0, tie=["t"], buckets=12)
    assert made.columns == ["doc_id", "t", "m", "shard", "grown_shard", "slot"]
    slots = defaultdict(list)
    for r in made.collect():
        slots[r["shard"]].append((r["slot"], r["doc_id"], r["t"]))
    assert sum(map(len, slots.values())) == 60_000
    for rows in slots.values():
        rows.sort()
        assert [s for s, *_ in rows] == list(range(len(rows)))
        for key in (None, 7):
            own = [(s, t) for s, k, t in rows if k == key]
            assert [t for _, t in own] == sorted(t for _, t in own) and (not own or own[-1][0] - own[0][0] == len(own) - 1)
    # no task wrote more than a small part of the rows
    tasks = [r["count"] for r in tables["numbered"].groupBy(F.input_file_name()).count().collect()]
    assert len(tasks) > 8 and max(tasks) < 60_000 / 6


def test_a_query_that_repeats(spark, monkeypatch):
    rows = [(50, [1.0, 2.0])] * 40 + [(i, [i % 7 * 1.0, i % 3 * 1.0]) for i in range(60, 90)]
    seen = []
    collect = type(spark.range(0)).collect
    monkeypatch.setattr(type(spark.range(0)), "collect", lambda df: (lambda out: (seen.append(len(out)) if "whole" in df.columns else None, out)[1])(collect(df)))
    got = run(spark, rows, k=3, block_bytes=8 * 2 * 10)
    assert got == brute(rows, 3) and len(got) == 120 and max(seen) <= 10 and sum(seen) == 40
    assert top_k.BLOCK_BYTES
