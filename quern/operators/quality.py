"""Quality annotation, filtering and validation of cleaned texts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import chars, text


@dataclass(frozen=True)
class QualityRules:
    """Bounds are inclusive."""

    script: chars.Script = chars.DEVANAGARI
    min_ratio: float = 0.60
    min_chars: int = 30
    max_chars: int = 1_000_000
    max_digits: float = 0.30
    max_symbols: float = 0.25
    reject_tables: bool = True
    script_weight: float = 0.7
    length_weight: float = 0.3


def annotate(df: DataFrame, column: str, rules: QualityRules) -> DataFrame:
    """df with counts, ratios, quality_score and reject_reason (null: passes)."""
    t = F.col(column)
    out = df.withColumns(chars.counts(t) | chars.char_ratios(t, rules.script))
    reason = F.when(F.col("script_ratio") < rules.min_ratio, "script_ratio").when(F.col("char_count") < rules.min_chars, "too_short").when(F.col("char_count") > rules.max_chars, "too_long")
    if rules.reject_tables:
        reason = reason.when(F.col("digit_ratio") > rules.max_digits, "digits").when(F.col("symbol_ratio") > rules.max_symbols, "symbols")
    return out.withColumns({"quality_score": chars.quality_score(F.col("script_ratio"), F.col("char_count"), rules.script_weight, rules.length_weight), "reject_reason": reason})


def split_passed(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that pass and rows that do not."""
    return annotated.where("reject_reason IS NULL"), annotated.where("reject_reason IS NOT NULL")


@dataclass(frozen=True)
class CleaningRules:
    script: chars.Script = chars.DEVANAGARI
    min_chars: int = 30
    min_length_ratio: float = 0.50
    max_length_ratio: float = 1.20
    min_ratio: float = 0.60
    echo: str = "cleaned hindi text:"
    max_latin: float = 0.70


def rejection(raw: Column, cleaned: Column, rules: CleaningRules) -> Column:
    """The first check that a cleaned text fails, or null."""
    c, r = F.coalesce(cleaned, F.lit("")), F.coalesce(raw, F.lit(""))
    ratio = F.length(c) / F.nullif(F.length(r), F.lit(0))
    return (
        F.when(chars.strip(c) == "", "empty_output").when(F.length(c) < rules.min_chars, "output_too_short").when(ratio < rules.min_length_ratio, "output_compressed")
        .when(ratio > rules.max_length_ratio, "output_expanded").when(chars.script_ratio(c, rules.script) < rules.min_ratio, "script_ratio_low")
        .when(F.contains(F.lower(c), F.lit(rules.echo)), "prompt_echo_detected").when(text.has_repeated_lines(c), "repeated_lines").when(chars.mostly_latin(c, rules.max_latin), "output_is_english")
    )


def validate(df: DataFrame, raw: str, cleaned: str, rules: CleaningRules) -> DataFrame:
    """df with rejection_reason and cleaning_status (clean or quarantined)."""
    out = df.withColumn("rejection_reason", rejection(F.col(raw), F.col(cleaned), rules))
    return out.withColumn("cleaning_status", F.when(F.col("rejection_reason").isNull(), "clean").otherwise("quarantined"))


def training_text(column: Column, script: chars.Script, shortest: int = 50, longest: int = 50_000, ratio: float = 0.60) -> Column:
    """Whether a text after NFKC is fit for training: length and share of the script in all characters."""
    return F.length(column).between(shortest, longest) & (chars.script_ratio(column, script) >= ratio)


def sampled_text(column: Column, script: chars.Script, shortest: int = 30, longest: int = 5_000, ratio: float = 0.60) -> Column:
    """Whether a text is fit for a tokenizer sample: stripped length and share of the script in visible characters."""
    t = chars.strip(column)
    return F.length(t).between(shortest, longest) & (chars.script_ratio(t, script, of_visible=True) >= ratio)


def filter_links(title: Column, namespaces: list[str], exclude: str | None = None, include: str | None = None, seed_exclude: str | None = None) -> Column:
    """Whether a linked title is followed: namespace prefixes and patterns (searched anywhere)."""
    keep = F.lit(True)
    for ns in namespaces:
        keep &= ~title.startswith(f"{ns}:")
    if exclude:
        keep &= ~title.rlike(exclude)
    if include:
        keep &= title.rlike(include)
    if seed_exclude:
        keep &= ~title.rlike(seed_exclude)
    return keep


# The record's columns that hold shares, and its enumerations.
RATIOS = ("devanagari_ratio", "latin_ratio", "digit_ratio", "symbol_ratio", "quality_score")
ENUMS = {
    "source_type": ("huggingface_dataset", "pdf", "wiki"),
    "cleaning_method": ("deterministic_normalization", "ollama_model_assisted", "none"),
    "cleaning_status": ("pending", "clean", "quarantined", "skipped"),
    "split_name": ("train", "validation", "test"),
}


def violations(df: DataFrame) -> DataFrame:
    """Rows that break the record's schema, with the names of the columns that do (`violations`)."""
    has = set(df.columns)
    tests = [(c, F.col(c).isNull()) for c in ("record_id", "document_id", "source_type", "source_name") if c in has]
    tests += [(c, F.col(c) < 0) for c in ("char_count", "word_count", "estimated_token_count") if c in has]
    tests += [(c, ~F.col(c).between(0, 1)) for c in RATIOS if c in has]
    tests += [(c, ~F.col(c).isin(*v)) for c, v in ENUMS.items() if c in has]
    names = F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(c)) for c, t in tests])) if tests else F.array().cast("array<string>")
    return df.withColumn("violations", names).where(F.size("violations") > 0)
