"""Exact and near-duplicates: keep-first by text hash, and MinHash with banded buckets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import chars
from ..sources.shared import held, ship, written

PRIME = 2_147_483_647
PERMUTATIONS, THRESHOLD = 128, 0.85
#: Steps of the integrals over similarities.
STEPS = 2_000


def dedup_hash(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def row_hash(df: DataFrame) -> Column:
    """A hash of a row of any types: columns with maps, which have neither order nor hash, count as JSON."""
    return F.xxhash64(*[F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in df.schema.fields])


def first_of(df: DataFrame, by: str, order: str) -> DataFrame:
    """One row per value of `by`: the least by `order` (nulls last), then by a hash of the row, so that equal rows are one.

    An aggregate: rows are reduced before the shuffle, and a value that many rows share costs its partial results.
    """
    place = F.struct(F.col(order).isNull(), F.col(order), row_hash(df))
    return df.groupBy(F.col(by).alias("_by")).agg(F.min_by(F.struct(*df.columns), place).alias("_row")).select("_row.*")


def exact(df: DataFrame, text: str, order: str) -> DataFrame:
    """df with dedup_hash, one row per text: the earliest by `order`. Null texts are empty; null orders come last."""
    return first_of(df.withColumn("dedup_hash", dedup_hash(F.col(text))), "dedup_hash", order)


def unseen(df: DataFrame, history: DataFrame) -> DataFrame:
    """Rows whose dedup_hash an earlier run has not seen."""
    return df.join(history.select("dedup_hash").distinct(), "dedup_hash", "left_anti").select(*df.columns)


def shingles(text: Column, size: int = 3) -> Column:
    """The distinct runs of `size` words; a shorter text is one."""

    def runs(w: Column) -> Column:
        found = F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: F.array_join(F.slice(w, i, size), " "))
        return F.when(F.size(w) >= size, F.array_distinct(found)).otherwise(F.array(F.array_join(w, " ")))

    # the one element binds the words, so that the text is split once
    return F.transform(F.array(chars.words(text)), runs)[0]


@cache
def band_choice(threshold: float = THRESHOLD, permutations: int = PERMUTATIONS, missed: float = 0.5) -> tuple[int, int]:
    """Bands and rows a band, of at most `permutations` together, that err least about a threshold.

    Two texts of similarity s share a band with probability 1 - (1 - s^rows)^bands. The error is the integral of that below
    the threshold (chance links), weighed by 1 - missed, and of its complement above (missed links), weighed by missed.
    """
    if not (0 < threshold < 1 and 0 <= missed <= 1 and permutations > 0):
        raise ValueError("the threshold must be between 0 and 1, and there must be permutations")

    def middles(lo: float, hi: float) -> np.ndarray:
        return lo + (np.arange(STEPS) + 0.5) * (hi - lo) / STEPS

    below, above = middles(0.0, threshold), middles(threshold, 1.0)

    def error(choice: tuple[int, int]) -> float:
        bands, rows = choice
        apart = lambda s: (1 - s**rows) ** bands
        return (1 - missed) * float((1 - apart(below)).mean()) * threshold + missed * float(apart(above).mean()) * (1 - threshold)

    return min(((b, r) for b in range(1, permutations + 1) for r in range(1, permutations // b + 1)), key=error)


def permutations() -> tuple[np.ndarray, np.ndarray]:
    """Factors and summands of the hash family, from a linear rule."""
    i = np.arange(PERMUTATIONS, dtype=np.int64)
    return (i * 1_103_515_245 + 12_345) % (PRIME - 1) + 1, (i * 69_069 + 1) % PRIME


def shingle_hashes(words: Column, size: int = 3) -> Column:
    """The leading 32 bits of MD5 of every run of `size` words, below PRIME (runs that repeat repeat)."""
    ship()

    @F.pandas_udf("array<long>")
    def hashes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([run_hashes([w.encode() for w in words], size) for words in batch], dtype=object)

    return hashes(words)


def run_hashes(words: list[bytes], size: int) -> np.ndarray:
    """`shingle_hashes` of a text's words."""
    whole, at = b" ".join(words), [0, *accumulate(len(w) + 1 for w in words)]
    if len(words) <= size:
        digests = hashlib.md5(whole).digest()
    else:
        digests = b"".join([hashlib.md5(whole[a : b - 1]).digest() for a, b in zip(at, at[size:])])
    return np.frombuffer(digests, ">u4")[::4].astype(np.int64) % PRIME


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least value of each permutation over the hashes of shingles. PRIME is 2^31 - 1, so a remainder is a sum of bits above and below."""
    a, b = permutations()
    out = np.full(PERMUTATIONS, PRIME, np.int64)
    x, y = np.empty((2, 64, PERMUTATIONS), np.int64)
    for at in range(0, len(hashes), 64):  # bounded memory for long texts, within a core's cache
        h = hashes[at : at + 64, None]
        v, w = x[: len(h)], y[: len(h)]
        np.multiply(h, a, out=v)
        v += b
        for _ in range(2):
            np.right_shift(v, 31, out=w)
            v &= PRIME
            v += w
        v[v == PRIME] = 0
        np.minimum(out, v.min(axis=0), out)
    return out


def band_keys(hashes: Column, bands: int, rows: int) -> Column:
    """A key per band of `rows` permutations of the hashes of a text's shingles."""
    ship()

    @F.pandas_udf("array<string>")
    def keys(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            signed = [signature(np.unique(h)) for h in batch]
            yield pd.Series([[f"{b}:" + hashlib.md5(",".join(map(str, s[b * rows : (b + 1) * rows])).encode()).hexdigest() for b in range(bands)] for s in signed])

    return keys(hashes)


def canonical(df: DataFrame, key: str, text: str, threshold: float = THRESHOLD) -> DataFrame:
    """df with canonical_id: the least id (as text) among the rows that share a band with this one; bands are chosen for the threshold.

    Equal texts are one from the start, and each bucket passes on its least id only, so copies and buckets
    cost what their rows cost, however many. Rows without an id take one of their bucket, or their text's hash.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    one = df.groupBy(F.md5(body.cast("binary")).alias("_text")).agg(F.min(F.col(key).cast("string")).alias("_id"), F.min(body).alias("_body"))
    hashed = held(one, "_hashes", shingle_hashes(chars.words(F.col("_body"))))
    keyed = written(hashed.select("_text", "_id", F.explode(band_keys(F.col("_hashes"), *band_choice(threshold))).alias("_band")), "bands")
    least = keyed.groupBy("_band").agg(F.min("_id").alias("_least"))
    found = keyed.join(least, "_band").groupBy("_text").agg(F.coalesce(F.min("_least"), F.concat(F.lit("#"), F.col("_text"))).alias("canonical_id"))
    return df.withColumn("_text", F.md5(body.cast("binary"))).join(found, "_text").drop("_text")


def near(df: DataFrame, key: str, text: str, order: str, threshold: float = THRESHOLD) -> DataFrame:
    """df with canonical_id, one row (the first by `order`, nulls last) per canonical id. Links do not chain."""
    return first_of(canonical(df, key, text, threshold), "canonical_id", order)


def deduplicate(df: DataFrame, key: str, text: str, order: str) -> DataFrame:
    """Exact, then near-duplicates."""
    return near(exact(df, text, order), key, text, order)


def keep_first(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
