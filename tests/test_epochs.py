"""Epochs are permutations, each another, found row by row."""

import pytest
from pyspark.sql import functions as F

from quern.operators import order, shards


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 16, 17, 50, 101, 1000, 4097])
def test_permutations(spark, n):
    rows = spark.range(n).select(*[order.permuted(F.col("id"), n, 7, e).alias(f"e{e}") for e in range(3)], order.permuted(F.col("id"), n, 8, 0).alias("other")).collect()
    for c in ("e0", "e1", "e2", "other"):
        assert sorted(r[c] for r in rows) == list(range(n))
    if n > 10:
        assert len({tuple(r[c] for r in rows) for c in ("e0", "e1", "e2", "other")}) == 4
        assert sum(r["e0"] == i for i, r in enumerate(rows)) < 10  # few stay in place


def test_batches_of_epochs(spark):
    rows = [(p, i, [p * 100 + i]) for p in range(3) for i in range(11)]
    df = spark.createDataFrame(rows, "part int, sequence long, input_ids array<int>")
    plain = shards.batches(df, "part", "sequence", "input_ids", 4).collect()
    seen = []
    for epoch in (0, 1, 0):
        got = shards.batches(df, "part", "sequence", "input_ids", 4, epoch=epoch, seed=3).orderBy("batch", "place").collect()
        assert [(r["batch"], r["place"]) for r in got] == [(i // 4, i % 4) for i in range(32)]
        seen.append([r["input_ids"][0] for r in got])
    assert seen[0] == seen[2] != seen[1] and len(set(seen[0])) == 32 and len(plain) == 32
    assert "Sort" not in shards.batches(df, "part", "sequence", "input_ids", 4, epoch=1).select("batch")._jdf.queryExecution().optimizedPlan().toString().split("Window")[0]
    assert shards.batches(df.where("false"), "part", "sequence", "input_ids", 4, epoch=1).count() == 0
