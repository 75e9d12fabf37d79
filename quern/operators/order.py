"""Seeded and natural orders, and running sums over them, without a task that sees all rows.

A seeded shuffle is the order of md5(seed:id); the natural order is that of a whole number. Either is a
fraction of a range, which cuts the rows into as many even buckets as their number asks for; the
buckets' totals are summed first, so that a bucket knows what precedes it. (Ids that crowd in few places
of their range make uneven buckets in the natural order.)

Null keys are rows as others: first in the natural order, as the empty key in a seeded one.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a bucket, about.
BUCKET_ROWS = 100_000


def shuffle_key(seed: int, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))


def running(df: DataFrame, seed: int | None, key: str, value: Column, out: str, by: tuple[str, ...] = (), rows: int = BUCKET_ROWS) -> DataFrame:
    """df with `out`: the sum of value over the rows before this one (within `by`) in the seeded order of key or, without a seed, its natural order.

    `rows` is the size of a bucket: fewer where rows are large.
    """
    k = F.col(key)
    facts = [F.count("*").alias("_order_n"), *([F.min(key).cast("double").alias("_order_lo"), F.max(key).cast("double").alias("_order_hi")] if seed is None else [])]
    names = [f"_order_by{i}" for i in range(len(by))]
    matched = lambda: reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, names)))
    if by:  # a null group is a group
        bounds = df.groupBy(*[F.col(c).alias(n) for c, n in zip(by, names)]).agg(*facts)
        known = df.join(bounds, matched()).drop(*names)
    else:
        found = df.agg(*facts).first().asDict()
        known = df.withColumns({c: F.lit(v) for c, v in found.items()})
    if seed is None:
        part = F.coalesce((k - F.col("_order_lo")) / (F.col("_order_hi") - F.col("_order_lo") + 1), F.lit(0.0))
    else:
        part = F.conv(F.substring(shuffle_key(seed, k), 1, 8), 16, 10).cast("double") / float(1 << 32)
    order = [shuffle_key(seed, k), k] if seed is not None else [k]
    placed = known.withColumn("_order_b", F.floor(part * F.ceil(F.col("_order_n") / rows)).cast("long")).withColumn("_order_v", value)
    totals = placed.groupBy(*[F.col(c).alias(n) for c, n in zip(by, names)], F.col("_order_b").alias("_order_bucket")).agg(F.sum("_order_v").alias("_order_t"))
    ahead = Window.partitionBy(*names).orderBy("_order_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*names, "_order_bucket", F.coalesce(F.sum("_order_t").over(ahead), F.lit(0)).alias("_order_o"))
    local = Window.partitionBy(*by, "_order_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("_order_l", F.coalesce(F.sum("_order_v").over(local), F.lit(0)))
    same = F.col("_order_b") == F.col("_order_bucket")
    return summed.join(totals, same & matched() if by else same).select(*df.columns, (F.col("_order_o") + F.col("_order_l")).alias(out))


def rank(df: DataFrame, seed: int | None, key: str, out: str = "rank", by: tuple[str, ...] = ()) -> DataFrame:
    """df with the place (from 1) of each row in the order."""
    ranked = running(df, seed, key, F.lit(1).cast("long"), out, by)
    return ranked.withColumn(out, F.col(out) + 1)


def buffer_shuffle(df: DataFrame, key: str, buffer: int, seed: int, out: str = "place") -> DataFrame:
    """df with the place (from 0) of each row in a shuffle through a buffer: runs of `buffer` rows in the natural order of key, each in seeded order."""
    runs = running(df, None, key, F.lit(1).cast("long"), "_order_run").withColumn("_order_run", F.floor(F.col("_order_run") / buffer))
    within = Window.partitionBy("_order_run").orderBy(shuffle_key(seed, F.col(key)), key)
    return runs.withColumn(out, F.col("_order_run") * buffer + F.row_number().over(within) - 1).drop("_order_run")


#: Rounds of a permutation, and steps after which a walk gives up (no row ever does: each leaves the range with chance 1 / sqrt(n)).
ROUNDS, WALK = 4, 64


def sides(n: int) -> tuple[int, int]:
    """Two numbers near the root of n whose product is n or a little more."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def permuted(place: Column, n: int, seed: int, epoch: int) -> Column:
    """Where a place (0 to n - 1) goes in an epoch's permutation of 0 to n - 1, by the place alone: no sort, no state, another order each epoch.

    A Feistel network over pairs of remainders permutes a little more than n numbers; what falls outside is permuted again until
    it does not (its cycle leads back, and passes the few numbers outside only). Hashes are of seed, epoch and round.
    """
    a, b = sides(n)
    mixed = lambda turn, x: F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:{epoch}:{turn}:"), x.cast("string")).cast("binary")), 1, 15), 16, 10).cast("long")

    def turned(turn: int):
        if turn % 2 == 0:
            return lambda p: p.withField("l", (p["l"] + mixed(turn, p["r"])) % a)
        return lambda p: p.withField("r", (p["r"] + mixed(turn, p["l"])) % b)

    def step(x: Column) -> Column:
        pair = F.array(F.struct(F.floor(x / b).alias("l"), (x % b).alias("r")))
        for turn in range(ROUNDS):
            pair = F.transform(pair, turned(turn))  # the one element binds the pair
        return F.transform(pair, lambda p: p["l"] * b + p["r"])[0]

    at = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), step(place.cast("long")), lambda x, _: F.when(x >= n, step(x)).otherwise(x))
    return F.transform(F.array(at), lambda x: F.when(x < n, x).otherwise(F.raise_error(F.lit("a place left the range too often")).cast("long")))[0]
