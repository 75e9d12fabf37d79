"""A history of hashes answers as a join does, and reads the prefixes that it needs."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quern.operators import dedup, history


def hashed(spark, numbers):
    return spark.createDataFrame([(n,) for n in numbers], "n int").withColumn("dedup_hash", dedup.dedup_hash(F.col("n").cast("string")))


@pytest.fixture
def past(spark, tmp_path):
    return history.History(spark, str(tmp_path / "h"), digits=1, bits=1 << 12)


def test_runs(spark, past):
    first, second = hashed(spark, range(0, 900)), hashed(spark, range(800, 1500))
    assert past.runs() == [] and past.unseen(first).count() == 900
    past.add(first, "a")
    past.add(past.unseen(second, "b"), "b")
    assert past.runs() == ["a", "b"] and past.runs("b") == ["a"]
    new = hashed(spark, [*range(1400, 1600), *range(1590, 1600)]).unionByName(spark.createDataFrame([(-1, None)], "n int, dedup_hash string"))
    got = sorted(r["n"] for r in past.unseen(new).collect())
    assert got == sorted([-1, *range(1500, 1600), *range(1590, 1600)])
    assert got == sorted(r["n"] for r in dedup.unseen(new, first.select("dedup_hash").unionByName(second.select("dedup_hash"))).collect())


def test_a_run_that_is_tried_again(spark, past):
    rows = hashed(spark, range(50))
    past.add(rows, "a")
    assert past.unseen(rows, "a").count() == 50 and past.unseen(rows).count() == 0
    past.add(rows, "a")
    assert spark.read.parquet(f"{past.path}/hashes").count() == 50
    past.add(rows.where("false"), "a")
    assert past.runs() == [] and past.unseen(rows).count() == 50


def test_what_an_interrupted_run_left(spark, past, monkeypatch):
    past.add(hashed(spark, range(10)), "a")
    monkeypatch.setattr(past, "_filters", lambda own: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        past.add(hashed(spark, range(10, 20)), "b")
    assert spark.read.parquet(f"{past.path}/hashes").count() == 20 and past.runs() == ["a"]
    assert past.unseen(hashed(spark, range(5, 15))).count() == 5


def test_prefixes_that_are_read(spark, past):
    past.add(hashed(spark, range(2000)), "a")
    past.add(hashed(spark, range(2000, 2300)), "b")
    one = hashed(spark, [7])
    prefix = one.first()["dedup_hash"][0]
    plan = past.seen(one)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and f"= {prefix})" in plan.replace("IN (", "= ")
    found, other = past.hits(hashed(spark, [7, -5]), ["a", "b"]), next(p for p in Path(f"{past.path}/hashes").iterdir() if p.name.startswith("prefix=") and p.name != f"prefix={prefix}")
    assert [r["prefix"] for r in found.collect()] == [prefix]
    for file in other.rglob("part-*.parquet"):
        file.write_bytes(b"no Parquet")  # files of another prefix are not opened
    assert past.seen(one).count() == 1


def test_false_positives_are_few(spark, past):
    """2300 hashes over 16 filters of 4096 bits let about 3 in a thousand others through; compared exactly, none is left."""
    past.add(hashed(spark, range(2300)), "a")
    others = hashed(spark, range(10_000, 14_000))
    assert past.hits(others, ["a"]).count() < 60 and past.seen(others).count() == 0


def test_parameters(spark):
    for more in ({"bits": 100}, {"bits": 32}, {"digits": 0}, {"probes": 8}):
        with pytest.raises(ValueError):
            history.History(spark, "x", **more)
