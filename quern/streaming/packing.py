"""Packing of a token stream: each file's tokens are cut into sequences as they arrive, what is left over waits in state.

State per file is a buffer of fewer than `length` tokens and the number of its next sequence, kept in the checkpoint by
`transformWithState`: a query that ends goes on where it was. Sequences are those of `operators.shards.windows`
over all rows, whatever micro-batches they came in; the last tokens of a file, which fill no sequence, stay in state.

Rows of a file must arrive in order from one micro-batch to the next; within one they are put in order. A null or empty
array adds nothing, a null file is a file.

`packed_stream` takes all that a micro-batch brings of a file in one task: it is for streams of many files. Where few files bring much,
`pack_arrivals` cuts each micro-batch in ranges and has the same state, a row per file, as a table beside the sequences.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import shards
from ..sources.shared import delete, scratch, tidied

#: The state store that transformWithState needs.
STORE_SETTING, STORE = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Sequences that a task hands on at once.
SLICE = 512

# Spark also runs the processor in a process of the driver that is not given the session's files: the class goes there by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class TokenBuffer(StatefulProcessor):
    """Full sequences of a file; the rest of its tokens and the next number are its state."""

    def __init__(self, length: int):
        self.length = length

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rest = handle.getValueState("rest", "next long, tokens array<int>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        number, held = self.rest.get() if self.rest.exists() else (0, [])
        came = pd.concat(list(rows)).sort_values("order", kind="stable")
        tokens = np.concatenate([np.asarray(held, np.int32), *(np.asarray(t, np.int32) for t in came["ids"] if t is not None)])
        full = len(tokens) // self.length
        for at in range(0, full, SLICE):
            upto = min(full, at + SLICE)
            cut = list(tokens[at * self.length : upto * self.length].reshape(-1, self.length))
            yield pd.DataFrame({"file": [key[0]] * (upto - at), "sequence": np.arange(number + at, number + upto), "input_ids": cut})
        self.rest.update((number + full, tokens[full * self.length :].tolist()))

    def close(self) -> None:
        pass


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """The session's state store is RocksDB within the block: start queries with transformWithState in it."""
    old = spark.conf.get(STORE_SETTING)
    spark.conf.set(STORE_SETTING, STORE)
    try:
        yield
    finally:
        spark.conf.set(STORE_SETTING, old)


def packed_stream(tokens: DataFrame, file: str, order: str, ids: str, length: int) -> DataFrame:
    """file, sequence (from 0) and input_ids of a stream of token arrays; start it within `rocksdb`."""
    rows = tokens.select(F.col(file).alias("file"), F.col(order).cast("long").alias("order"), F.col(ids).cast("array<int>").alias("ids"))
    schema = f"file {tokens.schema[file].dataType.simpleString()}, sequence long, input_ids array<int>"
    made = rows.groupBy("file").transformWithStateInPandas(TokenBuffer(length), schema, "Append", "None")
    return made.withColumnRenamed("file", file)


def pack_arrivals(tokens: DataFrame, file: str, order: str, ids: str, length: int, path: str, checkpoint: str) -> DataFrame:
    """file, sequence (from 0) and input_ids of all that has come: packs what is there, then stops. Called again with the same folders, it goes on.

    No task sees a file's rows of a micro-batch: they are placed and cut as in `shards.windows`, after the tokens that came before. A micro-batch has a
    folder of its own, which it replaces if it runs again: full sequences, and the open one of every file (perhaps empty), which is the
    state that the next one reads. Open ones of earlier micro-batches are removed.
    """
    spark = tokens.sparkSession
    rows = tokens.select(F.col(file).alias("file"), F.col(order).cast("long").alias("order"), F.col(ids).cast("array<int>").alias("ids"))
    kind = tokens.schema[file].dataType.simpleString()
    made = f"file {kind}, sequence long, input_ids array<int>, open boolean"

    def pack(batch: DataFrame, n: int) -> None:
        with tidied(spark):
            # read again by the outer session: a stream's own has no adaptive plans
            arrived = scratch(spark, "arrived")
            shards.sized(batch, "file", "order", "ids").write.parquet(arrived)
            came = spark.read.schema(f"file {kind}, order long, ids array<int>, _size long").parquet(arrived)
            if n:
                held = spark.read.schema(made).parquet(f"{path}/batch={n - 1}").where("open")
            else:
                held = came.where("false").select("file", F.col("order").alias("sequence"), F.col("ids").alias("input_ids"))
            begin = F.col("sequence") * length
            before = held.select("file", (begin + F.size("input_ids")).alias("_before"))
            ends = before.unionByName(came.select("file", F.col("_size").alias("_before"))).groupBy("file").agg(F.sum("_before").alias("_from"))
            opened = ends.select("file", F.floor(F.col("_from") / length).alias("sequence"), "_from", F.array().cast("array<int>").alias("_part"))
            rest = held.select("file", "sequence", begin.alias("_from"), F.col("input_ids").alias("_part"))
            whole = shards.gathered(shards.parts(came, "file", "order", "ids", length, before).unionByName(rest).unionByName(opened), "file")
            whole.withColumn("open", F.size("input_ids") < length).write.mode("overwrite").partitionBy("open").parquet(f"{path}/batch={n}")
        if n > 1:
            delete(spark, f"{path}/batch={n - 2}/open=true")

    query = rows.writeStream.foreachBatch(pack).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(f"{made}, batch long").parquet(path).where("NOT open").select(F.col("file").alias(file), "sequence", "input_ids")
