from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quern.llm import sharding


def placed(df, weights, **more):
    return sharding.shard(df, "doc_id", weights, **more).collect()


def test_weights_and_growth(spark):
    df = spark.range(6000).withColumnRenamed("id", "doc_id")
    weights = [1.0, 2.0, 1.0]
    rows = placed(df, weights, grown=4.0)
    share = Counter(r["shard"] for r in rows)
    assert [round(share[i] / 6000, 1) for i in range(3)] == [0.2, 0.5, 0.2] or abs(share[1] / 6000 - 0.5) < 0.03
    assert all(r["grown_shard"] in (r["shard"], 3) for r in rows)
    assert abs(sum(r["grown_shard"] == 3 for r in rows) / 6000 - 0.5) < 0.03
    again = {r["doc_id"]: r["shard"] for r in placed(df, [*weights, 4.0])}
    assert all(again[r["doc_id"]] == r["grown_shard"] for r in rows)  # growing is placing anew


def test_slots(spark):
    df = spark.range(3000).withColumnRenamed("id", "doc_id")
    slots = defaultdict(list)
    for r in placed(df, [1.0] * 7, buckets=16):
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and sum(map(len, slots.values())) == 3000


def test_edges(spark, edge, empty):
    rows = placed(edge, [1.0, 1.0], grown=1.0, tie=["text"])
    assert len(rows) == edge.count()
    assert len({r["shard"] for r in rows if r["doc_id"] == 3}) == 1  # the key decides
    assert placed(empty, [1.0]) == []
    hot = spark.range(500).select(F.lit(1).alias("doc_id"))
    assert sorted(r["slot"] for r in placed(hot, [1.0] * 3)) == list(range(500))
    for bad in ([], [1.0, 0.0]):
        with pytest.raises(ValueError):
            sharding.shard(edge, "doc_id", bad)
