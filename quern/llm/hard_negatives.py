"""Hard-negative mining by norm-bucketed search.

For every anchor the `k` best rows of its own label are its positives; for every positive the `k` best rows
of other labels are sought among those whose score lies in the positive's window: at least `low` hundredths of
its score, and not above it. A score is the inner product of vectors of whole numbers, floor(scale * component).

1. The whole numbers are written once, sorted by norm, the longest first. Consecutive rows are a bucket.
2. Two searches run over the buckets, one with a window per anchor (any score, its label), one with a window
   per positive (its range of scores, other labels). By Cauchy-Schwarz no score of a bucket exceeds the
   anchor's norm times that of the bucket's first row: a bucket is skipped for every window whose lower limit, or
   whose running k-th score, lies above that. Whole row groups of the file go by the same bound.
3. Scores of the rest are resolved exactly, and a task passes on k entries per window at most.

Anchors go in blocks of at most `block_bytes` of vectors (numbered as they were written, so that no repeated id makes
a block larger); a block with its windows is all that is broadcast or reaches the driver. Candidates are not
shuffled after the first sort, whatever their labels or copies, and rows of equal norm are dealt out.

Rows with a null key or label, and vectors that are null, empty or hold null or non-finite components (also after
scaling) take no part. Shorter vectors are filled up with zeros. Ties go to the smaller key. Rows that repeat an
anchor's key are not its positives or negatives; each is an anchor of its own, and each of a repeated positive counts.
A positive below zero has an empty window. Scores beyond 64 bits are held at its limits. Other columns
are not read; a table without rows or anchors gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import top_k
from .shared import scratch, ship, written

#: Rows of a bucket.
BUCKET = 1024
#: Bytes of the vectors of a block of anchors, and pairs of windows and rows looked at together.
BLOCK_BYTES, CELLS = 1 << 24, 1 << 21
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1

#: vector rows as written: the key, its label, whether it is an anchor, an upper bound of the norm, whole numbers.
VECTORS = "id long, label long, asks boolean, norm double, whole array<double>"
FOUND = "w int, id long, score long"


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column as a matrix; shorter ones are filled up with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, sizes = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), dims))
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _whole(batches: Iterator[pa.RecordBatch], dims: int, scale: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BUCKET):
            part = batch.slice(at, BUCKET)
            with np.errstate(over="ignore"):
                rows = np.floor(_matrix(part.column("vector"), dims) * scale)
            fine = np.isfinite(rows).all(axis=1)
            rows, part = rows[fine], part.filter(pa.array(fine))
            with np.errstate(over="ignore"):
                norm = np.sqrt((rows * rows).sum(axis=1)) * (1 + 1e-12) + 1e-9
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * dims), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "label", "asks")), pa.array(norm), lists], names=["id", "label", "asks", "norm", "whole"])


def _products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact scores of all anchors with all rows."""
    if top_k._exact(rows, anchors):
        return (anchors @ rows.T).astype(np.int64)
    a, r = (x.astype(object) for x in (anchors, rows))
    a, r = (np.frompyfunc(int, 1, 1)(x) for x in (a, r))
    return np.clip(a @ r.T, _LEAST, _MOST).astype(np.int64)


def _search(batches: Iterator[pa.RecordBatch], sent: Broadcast, same: bool, k: int) -> Iterator[pa.RecordBatch]:
    """The k best entries (w, id, score) of a task for each window, of the anchor's label or of others."""
    (ids, labels, norms, vectors), (owner, low, high) = sent.value
    dims, n = vectors.shape[1], len(owner)
    kth = low.copy()
    held = tuple(np.empty(0, np.int64) for _ in range(3))
    for batch in batches:
        for at in range(0, batch.num_rows, BUCKET):
            part = batch.slice(at, BUCKET)
            longest = float(np.max(part.column("norm").to_numpy(zero_copy_only=False)))
            open_ = np.flatnonzero(norms[owner] * longest * (1 + 1e-12) >= kth.astype(np.float64))
            if not len(open_):
                continue
            row_ids, row_labels = (part.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
            rows = _matrix(part.column("whole"), dims)
            step = max(1, CELLS // len(row_ids))
            for i in range(0, len(open_), step):
                w = open_[i : i + step]
                asked, place = np.unique(owner[w], return_inverse=True)
                score = _products(vectors[asked], rows)[place]
                fits = (score >= kth[w, None]) & (score <= high[w, None]) & ((labels[owner[w], None] == row_labels) == same) & (ids[owner[w], None] != row_ids)
                if fits.shape[1] > k and fits.sum() > 8 * k * len(w):  # only those that reach the k-th of this bucket
                    fits &= score >= np.partition(np.where(fits, score, _LEAST), -k, axis=1)[:, -k, None]
                q, r = np.nonzero(fits)
                held = tuple(np.concatenate(x) for x in zip(held, (w[q], row_ids[r], score[q, r])))
            best = top_k._best(*held, k)
            held = tuple(x[best] for x in held)
            full = np.bincount(held[0], minlength=n) == k
            least = np.full(n, _MOST)
            np.minimum.at(least, held[0], held[2])
            kth[full] = np.maximum(low, least)[full]
    yield pa.RecordBatch.from_arrays([pa.array(held[0].astype(np.int32)), pa.array(held[1]), pa.array(held[2])], names=["w", "id", "score"])


def _reduced(lists: DataFrame, k: int) -> DataFrame:
    """The k best of all tasks' lists with their rank, in two steps, so that no window's lists meet unreduced."""
    nth = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "id"))
    some = lists.withColumn("salt", F.spark_partition_id() % 64).withColumn("rank", nth("w", "salt")).where(F.col("rank") <= k)
    return some.withColumn("rank", nth("w")).where(F.col("rank") <= k).select("w", "rank", "id", "score")


def mine(df: DataFrame, key: str, label: str, vector: str, is_anchor: Column, k: int = 5, low: int = 80, scale: float = 256.0, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor, positive, rank (from 1), negative, positive_score and negative_score of the hard negatives of df's anchors.

    `key` and `label` must be whole numbers. A negative's score n and its positive's p hold low * p <= 100 * n <= 100 * p.
    Results of a block of anchors are written to the shared folder before the next block starts.
    """
    spark = df.sparkSession
    ship(spark)
    known = F.col(key).isNotNull() & F.col(label).isNotNull() & top_k.valid(F.col(vector)) & (F.size(vector) > 0)
    flag = F.coalesce(is_anchor, F.lit(False)).alias("asks")
    rows = df.where(known).select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"), flag)
    seen = rows.agg(F.max(F.size("vector")).alias("dims"), F.count_if("asks").alias("asking")).first()
    dims = max(1, seen["dims"] or 0)
    result = "anchor long, positive long, rank int, negative long, positive_score long, negative_score long"
    path = scratch(spark, "hard_negatives")
    spark.createDataFrame([], result).write.parquet(path)
    if not seen["asking"]:
        return spark.read.schema(result).parquet(path)
    made = rows.mapInArrow(lambda x: _whole(x, dims, scale), VECTORS)
    # rows of one norm are dealt out by chance, so that copies do not end in one task
    vectors = written(made.withColumn("chance", F.rand(7)).repartitionByRange(F.desc("norm"), "chance").sortWithinPartitions(F.desc("norm")).drop("chance"), "vectors")
    block_rows = max(1, block_bytes // (8 * dims))
    asking = vectors.where("asks").repartition(-(-seen["asking"] // block_rows))
    place = F.monotonically_increasing_id()
    asking = written(asking.select("id", "label", "norm", "whole", (place.bitwiseAND(F.lit((1 << 33) - 1)) / block_rows).cast("int").alias("nth"), F.shiftright(place, 33).cast("int").alias("part")), "anchors")
    for b in sorted(asking.select("part", "nth").distinct().collect()):
        own = asking.where((F.col("part") == b["part"]) & (F.col("nth") == b["nth"])).collect()
        ids, labels = (np.array([r[c] for r in own], np.int64) for c in ("id", "label"))
        norms, whole = (np.array([r[c] for r in own], np.float64) for c in ("norm", "whole"))
        anchors, everyone = (ids, labels, norms, whole), np.arange(len(ids))

        def search(windows: tuple, same: bool, least: float) -> tuple[DataFrame, Broadcast]:
            sent = spark.sparkContext.broadcast((anchors, windows))
            near = vectors.where(F.col("norm") >= least).select("id", "label", "norm", "whole")
            return _reduced(near.mapInArrow(lambda x: _search(x, sent, same, k), FOUND), k), sent

        found, sent = search((everyone, np.full(len(ids), _LEAST), np.full(len(ids), _MOST)), True, 0.0)
        positives = [(int(r["w"]), r["id"], r["score"]) for r in found.collect()]  # k times a block's anchors at most
        sent.unpersist()
        # the least n with 100 n >= low p, in whole numbers of any size
        windows = [(a, p, s, -(-low * s // 100)) for a, p, s in positives if s >= 0]
        if not windows:
            continue
        owner = np.array([x[0] for x in windows], np.int64)
        lower, upper = (np.array([x[c] for x in windows], np.int64) for c in (3, 2))
        found, sent = search((owner, lower, upper), False, float((lower / norms[owner]).min()) * (1 - 1e-12))
        names = spark.createDataFrame([(i, int(ids[a]), int(p), int(s)) for i, (a, p, s, _) in enumerate(windows)], "w int, anchor long, positive long, positive_score long")
        named = found.join(F.broadcast(names), "w")
        named.select("anchor", "positive", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative"), "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(path)
        sent.unpersist()
    return spark.read.schema(result).parquet(path)
