"""Rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair has a score, -ln(u) / weight with u uniform in (0, 1) from a hash of the
pair; a record goes to the shard with the least score. The key and the shards alone decide, so no
row needs another, and a further shard takes rows only into itself.

Nulls: a null key counts as the empty key. Repeated keys share a shard (they must: the key decides)
and get slots of their own. Ties of scores go to the smaller shard. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import fresh, ship, written


def _score(key: Column, shard: int, weight: float) -> Column:
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{shard}")).cast("binary")), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / float(1 << 52)) / F.lit(float(weight))


def _best(key: Column, shards: Sequence[tuple[int, float]]) -> Column:
    scored = [F.struct(_score(key, i, w).alias("score"), F.lit(i).alias("shard")) for i, w in shards]
    return F.least(*scored) if len(scored) > 1 else scored[0]


def rendezvous(key: Column, weights: Sequence[float], grown: float | None = None) -> Column:
    """A struct of `shard` and, with `grown` (the weight of one more shard), `grown_shard`.

    Weights must be positive.
    """
    if not weights or min(*weights, 1.0) <= 0 or (grown is not None and grown <= 0):
        raise ValueError("weights must be positive")
    name = F.coalesce(key.cast("string"), F.lit(""))
    best = _best(name, list(enumerate(weights)))
    if grown is None:
        return F.struct(best["shard"].alias("shard"))
    # one array element binds the scores, so that they are computed once
    both = F.array(F.struct(best.alias("old"), _score(name, len(weights), grown).alias("new")))
    return F.transform(
        both,
        lambda x: F.struct(
            x["old"]["shard"].alias("shard"),
            F.when(x["new"] < x["old"]["score"], F.lit(len(weights))).otherwise(x["old"]["shard"]).alias("grown_shard"),
        ),
    )[0]


def shard(df: DataFrame, key: str, weights: Sequence[float], grown: float | None = None, tie: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """All rows of df with `shard`, `slot` (gapless from 0 in each shard) and, if asked for, `grown_shard`.

    Slots follow md5(key), key, then the columns `tie`, which must have an order. Shards are found once and written; rows are then
    sorted by shard and slot order in ranges (`buckets` of them, or as many as the session shuffles to), and rows that
    are equal in all of that by chance, so that neither null keys nor a hot one meet in one task. A range holds a run of each
    of its shards; the counts of these runs (ranges + shards rows at most) say how many rows precede a run.
    """
    ship(df.sparkSession)
    hashed, part, first, before, spot, chance, row = fresh(df, "_hash", "_part", "_first", "_before", "_spot", "_chance", "_row")
    names = ["shard", "grown_shard"] if grown is not None else ["shard"]
    kept = [c for c in df.columns if c not in (*names, "slot")]
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    placed = df.select(*kept, F.md5(name.cast("binary")).alias(hashed), rendezvous(F.col(key), weights, grown).alias(spot), F.rand(9).alias(chance))
    placed = written(placed.select(*kept, hashed, chance, *[F.col(spot)[n].alias(n) for n in names]), "placed")
    order = ["shard", hashed, key, *tie, chance]
    dealt = placed.repartitionByRange(*([buckets] if buckets else []), *order).sortWithinPartitions(*order)
    numbered = written(dealt.select(*kept, *names, F.monotonically_increasing_id().alias(row)), "numbered")
    numbered = numbered.withColumn(part, F.shiftright(row, 33))
    runs = numbered.groupBy("shard", part).agg(F.count("*").alias(spot), F.min(row).alias(first))
    ahead = F.sum(spot).over(Window.partitionBy("shard").orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("shard", part, first, F.coalesce(ahead, F.lit(0)).alias(before))
    slot = (F.col(before) + F.col(row) - F.col(first)).cast("long").alias("slot")
    return numbered.join(F.broadcast(runs), ["shard", part]).select(*kept, *names, slot)
