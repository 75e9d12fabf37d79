"""Counts of phases are those of the jobs that write, and the log is a table."""

import pytest
from pyspark.sql import functions as F

from quern.sources import run_log


def events(spark, path):
    return [(r["phase"], r["status"], r["records_in"], r["records_out"], r["records_rejected"]) for r in run_log.read(spark, path).orderBy("timestamp").collect()]


def test_events(spark, tmp_path):
    log = run_log.RunLog(spark, str(tmp_path / "log"), "r")
    with log.phase("filter", "rows") as phase:
        kept = phase.written(spark.range(100).repartition(4), "t", F.col("id") % 5 != 0, {"even": F.col("id") % 2 == 0}).where("id % 5 <> 0")
    with log.phase("distinct", "rows", log.out()) as phase:
        phase.written(kept.select(F.col("id") % 7).distinct(), "u")
    with pytest.raises(KeyError), log.phase("export", "rows"):
        raise KeyError("k")
    assert events(spark, str(tmp_path / "log")) == [
        ("filter", "started", 0, 0, 0), ("filter", "completed", 100, 80, 20), ("distinct", "started", 0, 0, 0), ("distinct", "completed", 80, 7, 73), ("export", "started", 0, 0, 0), ("export", "failed", 0, 0, 0),
    ]
    done = run_log.read(spark, str(tmp_path / "log")).where("status = 'completed'").orderBy("timestamp").collect()
    assert done[0]["notes"] == '{"even": 50}' and done[0]["duration_seconds"] > 0 and done[0]["run_id"] == "r"
    failed = run_log.read(spark, str(tmp_path / "log")).where("status = 'failed'").first()
    assert "k" in failed["error_message"] and run_log.read(spark, str(tmp_path / "log")).columns == run_log.LOG
    with pytest.raises(ValueError):
        log.event("x", "y", "z", rows=1)


def test_without_a_path(spark):
    log = run_log.RunLog(spark, None, "r")
    with log.phase("load", "rows") as phase:
        phase.written(spark.range(0), "t")
    assert [e["status"] for e in log.events] == ["started", "completed"] and log.out() == 0


def test_no_further_scan(spark, tmp_path):
    """One job reads the rows: an accumulator in a Python function sees each once."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def touched(x):
        seen.add(1)
        return x

    log = run_log.RunLog(spark, None, "r")
    with log.phase("filter", "rows") as phase:
        phase.written(spark.range(50).repartition(3).select(touched("id").alias("id")), "t", F.col("id") > 9)
    assert seen.value == 50 and log.events[-1]["records_rejected"] == 10


def test_a_task_that_is_tried_again_counts_once(spark, tmp_path):
    flag = str(tmp_path / "flag")

    def fails_once(batches):
        import os

        for batch in batches:
            yield batch
        if not os.path.exists(flag):
            open(flag, "w").close()
            raise RuntimeError("lost")

    log = run_log.RunLog(spark, None, "r")
    if spark.sparkContext.master.startswith("local["):
        from pyspark.errors import PythonException

        with pytest.raises(Exception), log.phase("load", "rows") as phase:  # noqa: B017 - local masters do not retry
            phase.written(spark.range(40).mapInPandas(fails_once, "id long"), "t")
        assert PythonException and log.events[-1]["status"] == "failed"
    with log.phase("load", "rows") as phase:
        phase.written(spark.range(40).mapInPandas(fails_once, "id long"), "t")
    assert log.events[-1]["records_out"] == 40
