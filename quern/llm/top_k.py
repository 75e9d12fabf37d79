"""Exact top-k inner products by the three-phase uniform threshold.

Vectors become whole numbers, floor(scale * component). Their dimensions are cut into `parts`, each
with its own list of partial scores per query, and a score is the sum of `parts` partial scores.

1. Every task gathers, per query and part, its k best partial scores, completes the scores of those
   vectors and passes on the k best. The k-th best of all tasks is a score that k vectors do reach:
   a safe cutoff.
2. The cutoff is broadcast. A vector that reaches it has a partial score of at least cutoff / parts
   in some part (the uniform threshold); tasks collect the entries that do.
3. Only those entries' scores are resolved, exactly, in whole numbers.

The whole numbers are written once, in order of the vectors' norms. No score exceeds the product of two
norms, so rows whose norm is too small for every cutoff are left out of the second pass, whole row groups of
the file by their statistics. Queries go in blocks of as many as `block_bytes` hold (what is broadcast is
bounded by that, whatever the dimension), so the scans do not grow with the queries up to memory. A task
works in slices of SLICE queries and as many rows as keep its products within `block_bytes`, rows are never
shuffled, and it passes on k entries per query at most, ties included, so copies of one vector cannot pile up.

Vectors that are null or hold null or non-finite components, and rows with a null id, take no part.
Shorter vectors are filled up with zeros. Rows that repeat an id are candidates of their own, but none
of a query's own id counts for it. Scores beyond 64 bits are held at its limits. Other columns are not
read; a table without rows or without queries gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import scratch, ship, written

#: Rows and queries whose products are made at once in a task.
CHUNK, SLICE = 2048, 2048
#: Bytes of the queries of a block, of the products of a slice, and of the pairs scored at once.
BLOCK_BYTES = 1 << 25
_LIMIT = 1 << 63


def whole(vectors: list[np.ndarray], dims: int, scale: float) -> np.ndarray:
    """floor(scale * x) as float64 (exact for the whole numbers it holds), filled up with zeros."""
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return np.floor(out * scale)


def _exact(rows: np.ndarray, queries: np.ndarray) -> bool:
    """Whether float64 products and sums of these are exact."""
    most = lambda x: float(np.abs(x).max(initial=0.0))
    return most(rows) * most(queries) * max(1, rows.shape[1]) < 2**53


def _scores(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact sums of products of paired rows and queries, as int64."""
    if _exact(rows, queries):
        return np.einsum("ij,ij->i", rows, queries).astype(np.int64)
    sums = [sum(int(a) * int(b) for a, b in zip(x, y)) for x, y in zip(rows, queries)]
    return np.array([min(max(s, -_LIMIT), _LIMIT - 1) for s in sums], np.int64)


def _best(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best entries of each q: highest score, then least id."""
    order = np.lexsort((ids, -scores.astype(object) if (scores == -_LIMIT).any() else -scores, q))
    sorted_q = q[order]
    first = np.searchsorted(sorted_q, sorted_q)
    return order[np.arange(len(order)) - first < k]


def _task(batches: Iterator[pd.DataFrame], block: Broadcast, cutoff: Broadcast | None, k: int, parts: int) -> Iterator[pd.DataFrame]:
    """A task's k best entries per query; without a cutoff of the first phase, with one of the second and third."""
    query_ids, queries = block.value
    dims = queries.shape[1]
    bounds, floor_ = np.linspace(0, dims, parts + 1).astype(int), None if cutoff is None else cutoff.value
    pairs = max(1, BLOCK_BYTES // (16 * dims))
    slices = [slice(i, i + SLICE) for i in range(0, len(query_ids), SLICE)]
    held = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)) for _ in slices]
    step = max(1, min(CHUNK, BLOCK_BYTES // (8 * max(dims, min(SLICE, len(query_ids))))))
    for batch in batches:
        for at in range(0, len(batch), step):
            ids = batch["id"].to_numpy()[at : at + step].astype(np.int64)
            rows = np.vstack(batch["whole"].iloc[at : at + step].to_numpy())
            for n, own in enumerate(slices):
                asked, sure = queries[own], _exact(rows, queries[own])
                chosen = np.zeros((len(asked), len(ids)), bool)
                for a, b in zip(bounds, bounds[1:]):
                    partial = asked[:, a:b] @ rows[:, a:b].T
                    if floor_ is None:
                        # one more, as a query's own row may be among them
                        top = np.argpartition(-partial, min(k, len(ids) - 1), axis=1)[:, : k + 1]
                        np.put_along_axis(chosen, top, True, axis=1)
                    elif sure:
                        chosen |= partial * parts >= floor_[own, None]
                    else:
                        chosen[:] = True
                chosen &= query_ids[own, None] != ids[None, :]
                q, r = np.nonzero(chosen)
                score = np.concatenate([_scores(rows[r[i : i + pairs]], asked[q[i : i + pairs]]) for i in range(0, len(q), pairs)] or [np.empty(0, np.int64)])
                if floor_ is not None:
                    keep = score >= floor_[own][q]
                    q, r, score = q[keep], r[keep], score[keep]
                joined = tuple(np.concatenate(x) for x in zip(held[n], (q, ids[r], score)))
                best = _best(*joined, k)
                held[n] = tuple(x[best] for x in joined)
    for own, (q, vec, score) in zip(slices, held):
        yield pd.DataFrame({"q": (q + own.start).astype(np.int32), "vec": vec, "score": score})


def _whole_vectors(batches: Iterator[pd.DataFrame], dims: int, scale: float) -> Iterator[pd.DataFrame]:
    """id, asks, whole numbers and an upper bound of the norm of each vector."""
    for batch in batches:
        for at in range(0, len(batch), CHUNK):
            part = batch.iloc[at : at + CHUNK]
            rows = whole(part["vector"].tolist(), dims, scale)
            norm = np.sqrt((rows * rows).sum(axis=1)) * (1 + 1e-12) + 1e-9
            yield pd.DataFrame({"id": part["id"], "asks": part["asks"], "norm": norm, "whole": list(rows)})


def valid(vector: Column) -> Column:
    """Whether a vector holds finite components only."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector.cast("array<double>"), finite), F.lit(False))


def top_k(df: DataFrame, key: str, vector: str, is_query: Column, k: int, scale: float = 256.0, parts: int = 4, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query, rank (from 1), key and score of the k best rows of df for each of its rows where is_query holds.

    Ties go to the smaller id. `key` must be a whole number. Results of a block of queries are written
    to the shared folder before the next block starts.
    """
    spark = df.sparkSession
    ship(spark)
    flag = F.coalesce(is_query, F.lit(False)).alias("asks")
    rows = df.where(F.col(key).isNotNull() & valid(F.col(vector))).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), flag)
    seen = rows.agg(F.max(F.size("vector")).alias("dims"), F.count_if("asks").alias("asking")).first()
    dims = max(1, seen["dims"] or 0)
    block_rows = max(1, block_bytes // (8 * dims))
    parts = min(parts, dims)
    path, result = scratch(spark, "top_k"), "query long, rank int, vec long, score long"
    spark.createDataFrame([], result).write.parquet(path)
    made = rows.mapInPandas(lambda x: _whole_vectors(x, dims, scale), "id long, asks boolean, norm double, whole array<double>")
    # files hold ranges of norms, so that the second pass skips those below every cutoff
    vectors = written(made.repartitionByRange("norm").sortWithinPartitions("norm"), "vectors")
    # blocks by the place in which queries were written, so that a query id that repeats makes no block larger
    place = F.monotonically_increasing_id()
    asking = vectors.where("asks").select("id", "whole", "norm").repartition(max(1, -(-(seen["asking"] or 0) // block_rows)))
    asking = written(asking.select("*", (place.bitwiseAND(F.lit((1 << 33) - 1)) / block_rows).cast("int").alias("nth"), F.shiftright(place, 33).cast("int").alias("part")), "queries")
    nth = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "vec"))
    # two steps, so that no query's lists of all tasks meet in one place unreduced
    reduced = lambda lists: lists.withColumn("salt", F.spark_partition_id() % 64).withColumn("rank", nth("q", "salt")).where(F.col("rank") <= k).withColumn("rank", nth("q")).where(F.col("rank") <= k)
    for b in sorted(asking.select("part", "nth").distinct().collect()):
        block = asking.where((F.col("part") == b["part"]) & (F.col("nth") == b["nth"])).collect()  # block_rows at most
        own = sorted(((r["id"], r["norm"], r["whole"]) for r in block), key=lambda x: x[0])
        query_ids, norms = np.array([x[0] for x in own], np.int64), np.array([x[1] for x in own])
        sent = spark.sparkContext.broadcast((query_ids, np.array([x[2] for x in own], np.float64)))
        schema = "q int, vec long, score long"
        lists = vectors.select("id", "whole").mapInPandas(lambda x: _task(x, sent, None, k, parts), schema)
        least = np.full(len(own), -_LIMIT, np.int64)
        for r in reduced(lists).groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == k).collect():
            least[r["q"]] = r["least"]
        cut = spark.sparkContext.broadcast(least)
        # a row can reach a cutoff only if its norm does with the query's
        needed = float((least / norms).min()) * (1 - 1e-12)
        found = vectors.where(F.col("norm") >= needed).select("id", "whole").mapInPandas(lambda x: _task(x, sent, cut, k, parts), schema)
        names = spark.createDataFrame([(i, int(x)) for i, x in enumerate(query_ids)], "q int, query long")
        reduced(found).join(F.broadcast(names), "q").select("query", F.col("rank").cast("int").alias("rank"), "vec", "score").write.mode("append").parquet(path)
        sent.unpersist()
        cut.unpersist()
    out = spark.read.schema(result).parquet(path)
    return out.select("query", "rank", F.col("vec").alias(key), "score")
