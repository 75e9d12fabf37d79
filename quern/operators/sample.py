"""Byte budgets and the tokenizer sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import chars, text
from ..sources.shared import held, written
from . import quality
from .order import running


#: Rows whose places are sent to every executor.
FEW = 4_000_000


def budget(df: DataFrame, key: str, column: str, target: int, seed: int = 42, overshoot: bool = True, per_row: int = 1) -> DataFrame:
    """Rows in seeded order until their bytes (and per_row more each) fill the target.

    With overshoot the row that crosses the target is kept, so a table with rows gives one at least;
    without, the prefix ends before it. Rows are written once; their order is found on keys and sizes alone.
    """
    size = (F.octet_length(F.coalesce(F.col(column), F.lit(""))) + per_row).cast("long")
    rows = written(df.select("*", size.alias("_size"), F.monotonically_increasing_id().alias("_row")), "budget")
    before = running(rows.select(key, "_size", "_row"), seed, key, F.col("_size"), "_before")
    taken = before.where(F.col("_before") < target if overshoot else F.col("_before") + F.col("_size") <= target).select("_row")
    # a small budget has few rows, so that the others need not be shuffled to be left out
    return rows.join(F.broadcast(taken) if target <= FEW * per_row else taken, "_row").select(*df.columns)


def tokenizer_sample(df: DataFrame, key: str, column: str, script: chars.Script, target: int, seed: int = 42) -> DataFrame:
    """key and value: normalised texts of the script, in seeded order up to the target."""
    # held, as the filter would go below the Unicode forms otherwise and have them made again
    clean = held(df.where(F.col(column).isNotNull()).select(F.col(key), F.col(column).alias("_text")), "value", text.nfkc_words(F.col("_text"))).select(key, "value")
    return budget(clean.where(quality.sampled_text(F.col("value"), script)), key, "value", target, seed)
