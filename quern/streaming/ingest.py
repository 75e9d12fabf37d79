"""Structured Streaming over arriving files and event logs (an extension: batches would do the same)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..operators import dedup, quality
from ..sources.shared import held


def arriving(spark: SparkSession, path: str, schema: T.StructType | str, kind: str = "json", files_per_batch: int | None = 16) -> DataFrame:
    """Rows of files as they appear in a folder; without a number of files, a micro-batch takes all that are there."""
    stream = spark.readStream.format(kind).schema(schema)
    return (stream if files_per_batch is None else stream.option("maxFilesPerTrigger", files_per_batch)).load(path)


def distinct_within(rows: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Rows of a stream whose key did not occur within `delay` before; older ones are forgotten as the latest time moves on, so state holds the keys of that span only.

    A key is forgotten at the end of the micro-batch that begins with the latest time `delay` past its span; until then
    later occurrences go, too. Rows later than the latest time less `delay` are dropped. A null key is a key.
    Which row of a key stays is open where a micro-batch brings several: `first_within` gives the earliest.
    """
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def first_within(rows: DataFrame, key: str, time: str, span: str, late: str = "1 hour") -> DataFrame:
    """Keys of a stream and their times of which none of the key's own lies at most `span` before, in whatever order a micro-batch brings them.

    These are the begins of the key's sessions. A begin is given out once the latest time less `late` has reached the end of its
    session (its last time and `span`), which state holds until then; earlier rows of no open session are dropped. So a stream that ends needs a row
    that much after its last one. A null key is a key; rows without a time are dropped.
    """
    sessions = rows.withWatermark(time, late).groupBy(key, F.session_window(time, span)).agg(F.count("*"))
    return sessions.select(key, F.col("session_window.start").alias(time))


def clean_stream(rows: DataFrame, column: str, rules: quality.QualityRules, time: str | None = None, delay: str = "1 day") -> DataFrame:
    """Normalised texts that pass the rules, each hash once.

    With a `time` column once within `delay`, which bounds the state; without one once for ever, and state grows with distinct texts.
    """
    # held, as every rule would normalise the text again otherwise
    normal = held(rows, "final_text", text.normalise(F.coalesce(F.col(column), F.lit(""))))
    passed = quality.annotate(normal, "final_text", rules).where("reject_reason IS NULL").withColumn("dedup_hash", dedup.dedup_hash(F.col("final_text")))
    return passed.dropDuplicates(["dedup_hash"]) if time is None else distinct_within(passed, "dedup_hash", time, delay)


def event_windows(events: DataFrame, time: str, kind: str, value: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Events and their value by window and kind; rows later than `late` are dropped."""
    counted = events.withWatermark(time, late).groupBy(F.window(time, width), kind).agg(F.count("*").alias("events"), F.sum(value).alias("total"))
    return counted.select(F.col("window.start").alias("window_start"), kind, "events", "total")


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> list[dict]:
    """Write all that is there as Parquet, then stop; the progress of the last micro-batches. Started again with the same checkpoint, it goes on."""
    query = stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()
    return [json.loads(p.json) for p in query.recentProgress]
