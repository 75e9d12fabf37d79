"""The hashes of earlier runs, laid out by prefix, with a Bloom filter per prefix in front.

A run adds its hashes as files by prefix and run, and its filters: per prefix the words of a bit array, in which each hash
sets `probes` bits that its own digits name. Filters of runs merge by OR. A later run looks its hashes up in the filters
first. A filter never misses, so what it lacks is new; only the prefixes of the hits are read, and the hits are
compared exactly. A hit that is none (a false positive) costs a read and no more.

A run counts once its filters are written, which is its last step: what an interrupted run left is not seen, and a run that
is tried again replaces its own. All in the engine: bits are set and tested by expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import sinks
from ..sources.shared import exists, written

HASH = "dedup_hash"


class History:
    """Hashes (hexadecimal, 64 digits) of runs below `path`; digits, bits and probes are those of its first run.

    There are 16^digits prefixes, each with a filter of `bits` bits (a power of two): about bits / 10 hashes a prefix keep
    false positives near one in a hundred; more hashes make more of them.
    """

    def __init__(self, spark: SparkSession, path: str, digits: int = 2, bits: int = 1 << 16, probes: int = 7):
        if bits & (bits - 1) or bits < 64 or not 1 <= digits <= 8 or not 1 <= probes <= 7:
            raise ValueError("bits must be a power of two from 64, digits 1 to 8, probes 1 to 7")
        self.spark, self.path, self.digits, self.bits, self.probes = spark, path.rstrip("/"), digits, bits, probes

    def prefix(self, hashed: Column) -> Column:
        return F.substring(hashed, 1, self.digits)

    def _places(self, hashed: Column) -> list[Column]:
        """The bits of a hash: of eight digits each, behind the prefix."""
        number = lambda i: F.conv(F.substring(hashed, 1 + self.digits + 8 * i, 8), 16, 10).cast("long")
        return [number(i) % self.bits for i in range(self.probes)]

    def add(self, hashes: DataFrame, run_id: str) -> None:
        """The distinct hashes of a run; nulls are none."""
        own = written(hashes.select(HASH).where(F.col(HASH).isNotNull()).distinct().withColumn("prefix", self.prefix(F.col(HASH))), "hashes")
        sinks.replace_run(own.limit(0), f"{self.path}/filters", run_id)  # until it is written anew the run does not count
        sinks.replace(own.withColumn("run_id", F.lit(run_id)).repartition("prefix").sortWithinPartitions("prefix", HASH), f"{self.path}/hashes", ["prefix", "run_id"])
        sinks.replace_run(self._filters(own), f"{self.path}/filters", run_id)

    def _filters(self, own: DataFrame) -> DataFrame:
        """prefix and words of the filters of hashes."""
        place = own.select("prefix", F.explode(F.array(*self._places(F.col(HASH)))).alias("place"))
        bit = F.expr("shiftleft(1L, CAST(place % 64 AS INT))")
        words = place.groupBy("prefix", F.floor(F.col("place") / 64).alias("word")).agg(F.bit_or(bit).alias("bits"))
        return self._dense(words)

    def _dense(self, words: DataFrame) -> DataFrame:
        """Words by number as an array per prefix; those that are missing are 0."""
        none = words.select("prefix").distinct().select("prefix", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.bits // 64 - 1).cast("long"))).alias("word"), F.lit(0).cast("long").alias("bits"))
        full = words.unionByName(none).groupBy("prefix", "word").agg(F.bit_or("bits").alias("bits"))
        return full.groupBy("prefix").agg(F.array_sort(F.collect_list(F.struct("word", "bits")))["bits"].alias("words"))

    def runs(self, but: str | None = None) -> list[str]:
        """The runs that count."""
        if not exists(self.spark, f"{self.path}/filters"):
            return []
        names = self.spark.read.schema("prefix string, words array<long>, run_id string").parquet(f"{self.path}/filters").select("run_id").distinct()
        return sorted(r["run_id"] for r in names.collect() if r["run_id"] != but)

    def filters(self, runs: list[str]) -> DataFrame:
        """prefix and words of the filters of these runs together."""
        rows = self.spark.read.schema("prefix string, words array<long>, run_id string").parquet(f"{self.path}/filters").where(F.col("run_id").isin(runs))
        if len(runs) == 1:
            return rows.select("prefix", "words")
        words = rows.select("prefix", F.posexplode("words").alias("word", "bits")).where("bits <> 0")
        return self._dense(words.select("prefix", F.col("word").cast("long").alias("word"), "bits"))

    def hits(self, hashes: DataFrame, runs: list[str]) -> DataFrame:
        """dedup_hash and prefix of the distinct hashes that the filters of these runs let through."""
        own = hashes.select(HASH).where(F.col(HASH).isNotNull()).distinct().withColumn("prefix", self.prefix(F.col(HASH)))
        found = own.join(self.filters(runs), "prefix")
        test = lambda p: F.get("words", F.floor(p / 64).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (p % 64).cast("int"))) != 0
        return found.where(reduce(lambda x, y: x & y, map(test, self._places(F.col(HASH))))).select(HASH, "prefix")

    def seen(self, hashes: DataFrame, run_id: str | None = None) -> DataFrame:
        """Those of the distinct hashes that runs other than run_id have: only the prefixes of hits are read."""
        runs = self.runs(run_id)
        if not runs:
            return hashes.select(HASH).limit(0)
        hits = written(self.hits(hashes, runs), "hits")
        prefixes = [r["prefix"] for r in hits.select("prefix").distinct().collect()]  # 16^digits at most
        known = self.spark.read.schema(f"{HASH} string, prefix string, run_id string").parquet(f"{self.path}/hashes")
        return known.where(F.col("prefix").isin(prefixes) & F.col("run_id").isin(runs)).join(hits, ["prefix", HASH], "left_semi").select(HASH).distinct()

    def unseen(self, df: DataFrame, run_id: str | None = None) -> DataFrame:
        """Rows of df whose dedup_hash no run other than run_id has. Rows without one stay."""
        return df.join(self.seen(df, run_id), HASH, "left_anti").select(*df.columns)
