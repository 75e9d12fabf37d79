"""Next-fit in ranges is next-fit."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.operators import shards
from quern.sources import sinks


def test_tables():
    r = random.Random(0)
    for _ in range(2000):
        target = r.choice([5, 10, 30, 100])
        sizes = np.array([r.choice([0, 1, 2, 5, target, target + 1, 3 * target]) if r.random() < 0.5 else r.randint(0, target // 3) for _ in range(r.randint(1, 40))])
        table = shards.fill_table(sizes, target)
        for held in (0, 1, target - 1, target, target + 1, 5 * target, r.randint(0, target)):
            filled = shards.fill(sizes, target, held)
            opened = int(filled[-1])
            assert shards.carried(table, target, held) == (int(sizes[filled == opened].sum()) + (0 if opened else held), opened)


@pytest.mark.parametrize("blocks", [1, 4, 50])
def test_ranges_do_not_change_shards(spark, blocks):
    r = random.Random(5)
    groups = {g: [r.choice([0, 1, 9, 31, 90]) if r.random() < 0.3 else r.randint(1, 9) for _ in range(n)] for g, n in (("s", 300), ("t", 7), ("u", 1))}
    df = spark.createDataFrame([(g, i, n) for g, ns in groups.items() for i, n in enumerate(ns)], "s string, i long, n long")
    got = {(x["s"], x["i"]): x["shard"] for x in shards.next_fit(df, "s", "i", "n", 30, blocks=blocks).collect()}
    assert got == {(g, i): s for g, ns in groups.items() for i, s in enumerate(shards.fill(np.array(ns), 30).tolist())}


def test_export_in_ranges(spark, monkeypatch):
    monkeypatch.setattr(shards, "RANGE_IDS", 16)
    rows = spark.range(200).select(F.when(F.col("id") < 170, "train").otherwise("test").alias("split_name"), F.col("id").cast("string").alias("record_id"), F.repeat(F.lit("x"), (F.col("id") * 37 % 101).cast("int")).alias("final_text"))
    got = sinks.with_shards(rows, megabytes=0.0005).withColumn("h", F.md5(F.concat(F.lit("42:"), "record_id"))).orderBy("h").collect()
    assert len(got) == 200
    for split in ("train", "test"):
        mine = [x for x in got if x["split_name"] == split]
        assert [x["shard"] for x in mine] == shards.fill(np.array([len(x["final_text"]) for x in mine]), int(0.0005 * 1024 * 1024)).tolist()


@pytest.mark.parametrize("seed", range(6))
def test_composed_tables(seed):
    """A table of many ranges says what walking them one by one does, for any fill."""
    r = random.Random(seed)
    target = r.choice([7, 50, 400])
    ranges = [[r.choice([0, 1, 3, 8, 60, 500]) if r.random() < 0.5 else r.randrange(1, 12) for _ in range(r.randrange(1, 14))] for _ in range(9)]
    tables = [shards.fill_table(np.array(x), target) for x in ranges]
    for upto in (1, 2, 5, 9):
        one = shards.composed(tables[:upto], target)
        for held in range(0, target + 1, max(1, target // 60)):
            want, opened = held, 0
            for t in tables[:upto]:
                want, more = shards.carried(t, target, want)
                opened += more
            assert shards.carried(one, target, held) == (want, opened)


@pytest.mark.parametrize("blocks", [None, 3, 40])
def test_sparse_ids_and_null_groups(spark, blocks, monkeypatch):
    monkeypatch.setattr(shards, "SPAN", 4)
    r = random.Random(8)
    ids = [-(1 << 62), -5, 0, 1, 5 * 10**15, 9 * 10**18, *r.sample(range(10**17, 10**18), 200)]
    rows = [(g, i, r.randrange(0, 40)) for g in ("a", None) for i in ids]
    got = sorted((str(x["g"]), x["id"], x["shard"]) for x in shards.next_fit(spark.createDataFrame(rows, "g string, id long, size int"), "g", "id", "size", 100, blocks).collect())
    want = []
    for g in ("a", None):
        own = sorted((i, s) for k, i, s in rows if k == g)
        want += [(str(g), i, int(n)) for (i, _), n in zip(own, shards.fill(np.array([s for _, s in own]), 100))]
    assert got == sorted(want)
