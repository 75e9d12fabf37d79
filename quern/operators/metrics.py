"""Corpus profiles, tokenizer and evaluation metrics, choices among variants, and model arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import chars

SPLITS = ("train", "validation", "test")


def profile(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Records, characters, words and estimated tokens of each split; splits without rows have zeros."""
    names = spark.createDataFrame([(s,) for s in SPLITS], "split_name string")
    sums = df.groupBy("split_name").agg(F.count("*").alias("records"), *[F.sum(c).alias(c) for c in ("char_count", "word_count", "estimated_token_count")])
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return names.join(sums, "split_name", "left").select("split_name", *[zero(c) for c in ("records", "char_count", "word_count", "estimated_token_count")])


def stage_counts(df: DataFrame, passed: Column, *by: str) -> DataFrame:
    """Rows in, out and rejected."""
    return df.groupBy(*by).agg(F.count("*").alias("records_in"), F.count_if(passed).alias("records_out"), F.count_if(~passed).alias("records_rejected"))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.sum(a) / F.nullif(F.sum(b), F.lit(0)), F.lit(0.0))


def token_metrics(df: DataFrame, text: Column, ids: Column, unknown: int, back: Column) -> DataFrame:
    """One row: unk_rate, chars_per_token, tokens_per_word and roundtrip_success_rate over all texts."""
    n = F.size(ids)
    unknowns = F.size(F.filter(ids, lambda i: i == unknown))
    return df.agg(
        _ratio(unknowns, n).alias("unk_rate"), _ratio(F.length(text), n).alias("chars_per_token"), _ratio(n, chars.word_count(text)).alias("tokens_per_word"),
        F.coalesce(F.avg((back == text).cast("double")), F.lit(0.0)).alias("roundtrip_success_rate"),
    )


def distinct_chars(df: DataFrame, text: str, script: chars.Script) -> DataFrame:
    """The distinct characters of a script with the texts that have each. Texts are reduced to their own distinct characters first."""
    own = F.array_distinct(F.split(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), f"[^{script.inside}]+", ""), ""))
    return df.select(F.explode(own).alias("char")).where("char <> ''").groupBy("char").agg(F.count("*").alias("texts"))


def coverage(found: DataFrame, known: Column) -> DataFrame:
    """Share of the distinct characters that a tokenizer knows; 1 without any."""
    return found.agg(F.coalesce(F.avg(known.cast("double")), F.lit(1.0)).alias("char_coverage"), F.count("*").alias("distinct_chars"))


def split_failures(specials: DataFrame, ids: str) -> DataFrame:
    """How many special tokens do not stay one id."""
    return specials.agg(F.count_if(F.size(ids) != 1).alias("special_token_split_failures"))


# A tokenizer's acceptance bounds.
GATE = {"unk_rate": 0.001, "chars_per_token": 3.0, "tokens_per_word": 2.5, "roundtrip_success_rate": 0.99, "devanagari_char_coverage": 0.995, "special_token_split_failures": 0}


def passes(gate: dict[str, float] = GATE) -> Column:
    return (
        (F.col("unk_rate") < gate["unk_rate"]) & (F.col("chars_per_token") > gate["chars_per_token"]) & (F.col("tokens_per_word") < gate["tokens_per_word"])
        & (F.col("roundtrip_success_rate") >= gate["roundtrip_success_rate"]) & (F.col("devanagari_char_coverage") >= gate["devanagari_char_coverage"])
        & (F.col("special_token_split_failures") <= gate["special_token_split_failures"])
    )


def recommended(reports: DataFrame, preferred: int = 32_000, gate: dict[str, float] = GATE) -> DataFrame:
    """The passing variant with the least unk_rate, then the preferred size, then the least size; raises if none passes."""
    best = reports.where(passes(gate)).orderBy("unk_rate", (F.col("vocab_size") != preferred).cast("int"), "vocab_size", "variant_name").limit(1)
    if best.isEmpty():
        raise ValueError("no variant passes")
    return best


def perplexity(losses: DataFrame, loss: str, *by: str, order: str | None = None, first: int | None = None) -> DataFrame:
    """exp of the mean loss; 1 without losses. With `first`, of that many batches by `order`."""
    if first is not None:
        losses = losses.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(order))).where(F.col("_n") <= first)
    return losses.groupBy(*by).agg(F.exp(F.coalesce(F.avg(loss), F.lit(0.0))).alias("perplexity"), F.count(loss).alias("batches"))


def sample_averages(samples: DataFrame, text: Column, script: chars.Script, ids: Column, unknown: int) -> DataFrame:
    """One row over generated samples: mean share of the script (each to three places) and mean number of unknown ids; 0 without any."""
    ratio, unknowns = F.round(chars.script_ratio(text, script), 3), F.size(F.filter(ids, lambda i: i == unknown))
    zero = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    return samples.agg(zero(ratio).alias("script_ratio"), zero(unknowns).alias("unknowns"), F.count("*").alias("samples"))


def reported(variants: DataFrame, reports: DataFrame) -> DataFrame:
    """The variants (vocab_size) that have a report of their size."""
    return variants.join(reports.select("vocab_size").distinct(), "vocab_size", "left_semi")


def score_band(perplexity: Column) -> Column:
    return F.when(perplexity < 50, "excellent").when(perplexity < 100, "good").when(perplexity < 200, "fair").otherwise("poor")


def log_windows(steps: DataFrame, step: str, loss: str, tokens: str, seconds: str, every: int) -> DataFrame:
    """Mean loss and tokens a second of every window of steps (numbered from 1)."""
    window = F.floor((F.col(step) - 1) / every)
    return steps.groupBy(window.alias("window")).agg(
        F.max(step).alias("last_step"), F.avg(loss).alias("mean_loss"), (F.sum(tokens) / F.nullif(F.sum(seconds), F.lit(0))).alias("tokens_per_second")
    )


def latest(paths: DataFrame, path: str) -> DataFrame:
    """The checkpoint with the largest number after step_."""
    n = F.regexp_extract(path, r"step_(\d+)/?$", 1).try_cast("long")
    return paths.where(n.isNotNull()).agg(F.max_by(path, n).alias(path), F.max(n).alias("step"))


def best(rows: DataFrame, name: str, loss: str) -> DataFrame:
    """The checkpoint with the least loss (then name)."""
    return rows.agg(F.min_by(name, F.struct(loss, name)).alias(name), F.min(loss).alias(loss))


def nucleus(df: DataFrame, by: str, token: str, probability: str, p: float) -> DataFrame:
    """Tokens that top-p sampling keeps: those whose more probable ones sum to p at most."""
    ahead = Window.partitionBy(by).orderBy(F.desc(probability), token).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("_before", F.coalesce(F.sum(probability).over(ahead), F.lit(0.0))).where(F.col("_before") <= p).drop("_before")


# Model tiers (hidden size, layers, attention heads, key-value heads, head size, feed-forward size, context, vocabulary).
TIERS = {
    "CPU_ONLY": (256, 6, 4, 2, 64, 768, 256, 32_000),
    "MICRO": (384, 8, 6, 2, 64, 1024, 512, 32_000),
    "SMALL": (512, 10, 8, 2, 64, 1536, 512, 32_000),
    "MEDIUM": (768, 12, 12, 4, 64, 2048, 1024, 32_000),
    "LARGE": (1024, 16, 16, 4, 64, 2752, 2048, 32_000),
}
TIER_SCHEMA = "tier string, hidden long, layers long, heads long, kv_heads long, head_dim long, ffn long, context long, vocab long"


def tiers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in TIERS.items()], TIER_SCHEMA)


def parameters(tied: bool = True) -> Column:
    """Parameters of a tier: embedding, per layer attention, gated feed-forward and two norms, final norm, head if not tied."""
    h, kv = F.col("hidden"), F.col("kv_heads") * F.col("head_dim")
    layer = 2 * h * h + 2 * h * kv + 3 * h * F.col("ffn") + 2 * h
    return F.col("vocab") * h * (1 if tied else 2) + F.col("layers") * layer + h


def training_gb(batch: int = 2, width: int = 2) -> Column:
    """Estimated memory for training: weights, gradients, two moments in 32 bits, activations."""
    per_token = F.col("hidden") * 4 + F.col("heads") * F.col("context") * 4 + F.col("ffn") * 4
    return parameters() * (2 * width + 8) / 1e9 + F.col("layers") * batch * F.col("context") * per_token / 1e9


def kv_cache_gb(width: int = 2) -> Column:
    return 2 * F.col("layers") * F.col("context") * F.col("kv_heads") * F.col("head_dim") * width / 1e9


def quantised_gb(bits: float = 4.5) -> Column:
    return parameters() * bits / 8 / 1e9


def fits(memory_gb: float = 8.0, share: float = 0.75) -> Column:
    """Whether quantised weights and the cache leave the rest of a small machine free."""
    return quantised_gb() + kv_cache_gb() < memory_gb * share


def tier_of(vram_gb: Column) -> Column:
    return F.when(vram_gb <= 0, "CPU_ONLY").when(vram_gb < 4, "MICRO").when(vram_gb < 10, "SMALL").when(vram_gb < 20, "MEDIUM").otherwise("LARGE")


def cosine_rate(step: Column, warmup: int, total: int, rate: float) -> Column:
    progress = (step - warmup) / max(total - warmup, 1)
    return F.when(step < warmup, rate * step / max(warmup, 1)).otherwise(rate * 0.5 * (1 + F.cos(F.lit(math.pi) * progress)))
