"""Streams with state: token buffers that outlive a restart, duplicates that are forgotten in time."""

import random
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from quern.operators import shards
from quern.plans.run_queries import ORACLE_SQL, QUERIES
from quern.streaming import ingest, packing

DATA = Path("/root/testdata/sf0.001")


def feed(spark, rows, folder, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_packed_stream_equals_the_batch(spark, tmp_path):
    r = random.Random(1)
    schema = "file string, line long, ids array<int>"
    rows = [(r.choice(["a", "b", "c", None]), n, [r.randrange(1000) for _ in range(r.randrange(0, 30))] if n % 11 else None) for n in range(300)]
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def run():
        with packing.rocksdb(spark):
            stream = ingest.arriving(spark, source, schema, "parquet", files_per_batch=1)
            return ingest.drain(packing.packed_stream(stream, "file", "line", "ids", 16), out, state)

    for begin in (0, 60, 120):
        feed(spark, r.sample(rows[begin : begin + 60], 60), source, schema)
    assert len([p for p in run() if p["numInputRows"]]) == 3
    for begin in (180, 240):  # a new query from the same checkpoint
        feed(spark, r.sample(rows[begin : begin + 60], 60), source, schema)
    progress = [p for p in run() if p["numInputRows"]]
    assert len(progress) == 2 and progress[-1]["stateOperators"][0]["numRowsTotal"] <= 4
    got = sorted((str(x["file"]), x["sequence"], x["input_ids"]) for x in spark.read.parquet(out).collect())
    want = shards.windows(spark.createDataFrame(rows, schema).where("ids IS NOT NULL").fillna("None"), "file", "line", "ids", 16)
    assert got == sorted((x["file"], x["sequence"], x["input_ids"]) for x in want.collect()) and len(got) > 200
    assert spark.conf.get(packing.STORE_SETTING) != packing.STORE


def test_duplicates_within_a_span(spark, tmp_path):
    schema = "k string, ts timestamp, n int"
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    at = lambda hour, minute=0: f"2024-01-{1 + hour // 24:02d} {hour % 24:02d}:{minute:02d}:00"
    slices = [
        [("a", at(0), 1), ("a", at(0, 5), 2), ("b", at(0), 3), (None, at(0), 4), (None, at(0, 1), 5)],
        [("a", at(0, 50), 6), ("c", at(5), 7)],
        [("d", at(20), 8)],
        [("a", at(21), 9), ("b", at(21), 10), ("d", at(20, 30), 11), ("e", at(2), 12)],  # the last is too late
    ]
    import datetime

    for rows in slices:
        feed(spark, [(k, datetime.datetime.fromisoformat(t), n) for k, t, n in rows], source, schema)
    stream = ingest.arriving(spark, source, schema, "parquet", files_per_batch=1)
    progress = ingest.drain(ingest.distinct_within(stream, "k", "ts", "1 hour"), out, state)
    assert [r["n"] for r in spark.read.parquet(out).orderBy("n").collect() if r["n"] not in (1, 2, 4, 5)] == [3, 7, 8, 9, 10]
    assert spark.read.parquet(out).where("n IN (1, 2)").count() == spark.read.parquet(out).where("n IN (4, 5)").count() == 1
    totals = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    assert max(totals) <= 6 and totals[-1] <= 4  # the first keys are forgotten


def test_the_earliest_of_a_span(spark, tmp_path):
    """Whatever order a micro-batch brings: its largest file, which is read first, holds the later times."""
    import datetime

    schema = "k long, ts timestamp"
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    at = lambda hour, minute=0, us=0: datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=hour, minutes=minute, microseconds=us)
    late = [(k, at(2, 10)) for k in range(50)] + [(90, at(6)), (91, at(4, 0, 1)), (None, at(5))]
    early = [(k, at(2)) for k in range(25)] + [(90, at(3, 30)), (91, at(3)), (92, at(3)), (92, at(4)), (None, at(4, 30)), (93, None)]
    first = [(k, at(2, 10)) for k in range(25, 50)] + [(k, at(2)) for k in range(25)] + [(90, at(3, 30)), (90, at(6)), (91, at(3)), (91, at(4, 0, 1)), (92, at(3)), (None, at(4, 30))]

    def run(times):
        spark.createDataFrame(times, schema).coalesce(1).write.mode("append").parquet(f"{source}/{len(list(tmp_path.glob('in/*')))}")
        stream = ingest.arriving(spark, f"{source}/*", schema, "parquet", files_per_batch=None)
        ingest.drain(ingest.first_within(stream, "k", "ts", "1 hour"), out, state)
        return sorted(map(tuple, spark.read.parquet(out).collect()), key=repr)

    spark.createDataFrame(early, schema).coalesce(1).write.parquet(f"{source}/early")
    # at 5:00, an hour before the latest time, three sessions are open; that of 90 then goes on
    assert set(run(late)) == set(first) - {(90, at(6)), (91, at(4, 0, 1)), (None, at(4, 30))}
    more = run([(90, at(6, 30)), (95, at(30))])
    assert more == sorted(first, key=repr)  # 95 waits


def test_clean_stream_forgets(spark, tmp_path):
    from quern.functions import chars
    from quern.operators.quality import QualityRules

    good = "a plain sentence of latin words that is long enough"
    schema = "text string, ts timestamp"
    import datetime

    for day in (1, 2, 20, 25, 27, 60):
        t = f"{good} too" if day in (20, 25) else good  # the watermark moves on meanwhile
        feed(spark, [(t, datetime.datetime(2024, 1, 1) + datetime.timedelta(days=day)), ("1234", datetime.datetime(2024, 1, 1) + datetime.timedelta(days=day))], str(tmp_path / "in"), schema)
    for time, count in (("ts", 3), (None, 2)):
        stream = ingest.arriving(spark, str(tmp_path / "in"), schema, "parquet", files_per_batch=1)
        out = str(tmp_path / f"out{time}")
        ingest.drain(ingest.clean_stream(stream, "text", QualityRules(script=chars.LATIN_SCRIPT), time, "5 days").select("dedup_hash", F.col("ts")), out, str(tmp_path / f"state{time}"))
        assert spark.read.parquet(out).count() == count


def test_packed_arrivals_equal_the_batch(spark, tmp_path):
    r = random.Random(2)
    schema = "file string, line long, ids array<int>"
    rows = [(r.choice(["a", "b", "c", None]), n, [r.randrange(1000) for _ in range(r.randrange(0, 30))] if n % 11 else None) for n in range(300)]
    # a file that fills its sequences exactly and goes on later, one that comes once, one that never fills any
    rows += [("full", 10, [1] * 16), ("full", 20, [2] * 32), ("full", 250, [3] * 16), ("once", 5, [4] * 20), ("short", 70, [5] * 3)]
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    whole = lambda df: sorted((str(x["file"]), x["sequence"], x["input_ids"]) for x in df.collect())
    for begin in range(0, 300, 60):  # a new query each time, from the same checkpoint
        new = [x for x in rows if begin <= x[1] < begin + 60]
        spark.createDataFrame(r.sample(new, len(new)), schema).repartition(3).write.mode("append").parquet(source)
        stream = ingest.arriving(spark, source, schema, "parquet", files_per_batch=None)
        got = whole(packing.pack_arrivals(stream, "file", "line", "ids", 16, out, state))
        want = shards.windows(spark.createDataFrame([x for x in rows if x[1] < begin + 60], schema), "file", "line", "ids", 16)
        assert got == whole(want)
    assert len(got) > 200 and ("full", 3, [3] * 16) in got
    kept = spark.read.parquet(out).where("open = 'true'")
    assert sorted(kept.select("batch").distinct().toPandas()["batch"]) == [3, 4] and kept.where("batch = 4").count() == 7  # a row per file
    assert all(kept.selectExpr("size(input_ids) < 16 AS fits").toPandas()["fits"])


def test_a_micro_batch_that_runs_again(spark, tmp_path):
    schema = "file string, line long, ids array<int>"
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def run():
        stream = ingest.arriving(spark, source, schema, "parquet", files_per_batch=1)
        return sorted((x["sequence"], x["input_ids"]) for x in packing.pack_arrivals(stream, "file", "line", "ids", 4, out, state).collect())

    for n in range(3):  # a file is a micro-batch
        feed(spark, [("a", n, [n] * 6)], source, schema)
    first = run()
    assert first == [(0, [0] * 4), (1, [0, 0, 1, 1]), (2, [1] * 4), (3, [2] * 4)]
    for f in (tmp_path / "state/commits").glob("*2*"):  # it ended before it was noted that the last one is done
        f.unlink()
    feed(spark, [("a", 3, [3] * 2)], source, schema)
    assert run() == [*first, (4, [2, 2, 3, 3])]


@pytest.mark.skipif(not DATA.exists(), reason="no test tables here")
def test_slices_are_many_files(spark, tmp_path, monkeypatch):
    """A slice is written by many tasks, and no group of a task is a language."""
    docs = spark.read.parquet(str(DATA / "documents.parquet"))
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    seen, arriving = [], ingest.arriving

    def watched(spark, path, *args, **more):
        seen.append(spark.read.parquet(path).inputFiles())
        return arriving(spark, path, *args, **more)

    monkeypatch.setattr(ingest, "arriving", watched)
    monkeypatch.setattr(packing, "packed_stream", None)
    got = sorted(map(tuple, QUERIES["streamed_sequences"](spark, str(tmp_path)).collect()))
    assert [len(s) for s in seen] == [3, 6, 9, 12, 15]
    assert got == sorted(map(tuple, QUERIES["pack_sequences"](spark, str(DATA)).collect())) and got


def test_distinct_events_of_any_times(spark, tmp_path):
    """Files deal repeats out in any order; times lie outside the slices or are none; ids are null or occur often."""
    import datetime

    r, start = random.Random(3), datetime.datetime(2024, 1, 2)
    when = lambda: start + datetime.timedelta(minutes=10 * r.randrange(-6000, 12000))
    rows = [(3 * n, when()) for n in range(300)] + [(r.randrange(60), when()) for _ in range(200)] + [(n, None) for n in (0, 0, 7, 9000, 9001, 9001)]
    rows += [(None, start), (None, start + datetime.timedelta(minutes=20)), (None, None)]
    rows += [(8000 + n, start + datetime.timedelta(minutes=m)) for n, gap in enumerate((59, 60, 61, 120)) for m in (0, gap, 2 * gap)]
    path = str(tmp_path / "events.parquet")
    for part in range(3):
        df = spark.createDataFrame(rows[part::3], "event_id long, ts timestamp").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        df.coalesce(1).write.mode("append").parquet(path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{path}/*.parquet'")
    want = con.sql(f"SELECT event_id, ts FROM ({ORACLE_SQL['distinct_events']})").fetchall()
    got = QUERIES["distinct_events"](spark, str(tmp_path)).select("event_id", "ts").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
