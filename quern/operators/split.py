"""Deterministic train, validation and test splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written
from .order import rank


def half_even(x: float) -> int:
    return round(x)


def by_document(df: DataFrame, document: str, seed: int = 42, validation: float = 0.01, test: float = 0.01) -> DataFrame:
    """df with split_name, the same for all rows of a document.

    Documents in seeded order: first train, then validation, then test, the last two rounded half to
    even with at least one document each. A single document is test.
    """
    ids = df.select(document).distinct()
    n = ids.count()
    n_val, n_test = max(1, half_even(n * validation)), max(1, half_even(n * test))
    named = rank(ids, seed, document).select(
        document, F.when(F.col("rank") <= n - n_val - n_test, "train").when(F.col("rank") <= n - n_test, "validation").otherwise("test").alias("split_name")
    )
    same = F.col(f"x.{document}").eqNullSafe(F.col(f"y.{document}"))
    kept = [F.col(f"x.{c}") for c in df.columns if c != "split_name"]
    return df.alias("x").join(named.alias("y"), same).select(*kept, F.col("y.split_name"))


def by_stratum(df: DataFrame, document: str, stratum: str, seed: int = 42, validation: float = 0.01, test: float = 0.01) -> DataFrame:
    """df with split_name, the same for all rows of a document, split within each stratum (the least one of a document) by the rule of by_document."""
    ids = df.groupBy(F.col(document).alias("_document")).agg(F.min(stratum).alias("_stratum"))
    sizes = ids.groupBy(F.col("_stratum").alias("_s")).agg(F.count("*").alias("_n"))
    ranked = rank(ids, seed, "_document", "_rank", by=("_stratum",)).join(sizes, F.col("_stratum").eqNullSafe(F.col("_s")))
    part = lambda share: F.greatest(F.lit(1), F.bround(F.col("_n") * share))
    name = F.when(F.col("_rank") <= F.col("_n") - part(validation) - part(test), "train").when(F.col("_rank") <= F.col("_n") - part(test), "validation").otherwise("test")
    named = ranked.select("_document", name.alias("_split"))
    kept = [c for c in df.columns if c != "split_name"]
    return df.join(named, F.col(document).eqNullSafe(F.col("_document"))).select(*kept, F.col("_split").alias("split_name"))


def by_file(df: DataFrame, file: str, sequence: str, seed: int = 42, share: float = 0.02, least: int = 4) -> DataFrame:
    """df of packed sequences with split_name: per file a pool of max(least, share), half of it validation, half test.

    A file with fewer sequences than the pool gives all of them to it.
    """
    df = written(df, "sequences")  # read for sizes, buckets and places
    sizes = df.groupBy(file).agg(F.count("*").alias("_n"))
    pool = F.least(F.greatest(F.lit(least), F.floor(F.col("_n") * share)), F.col("_n"))
    ranked = rank(df, seed, sequence, "_rank", by=(file,)).join(sizes, file)
    test_from = F.col("_n") - pool + F.floor(pool / 2)
    name = F.when(F.col("_rank") <= F.col("_n") - pool, "train").when(F.col("_rank") <= test_from, "validation").otherwise("test")
    return ranked.select(*df.columns, name.alias("split_name"))
