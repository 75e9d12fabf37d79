"""The three batch pipelines: corpus ingestion, tokenizer evaluation, tokenising and packing."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields, is_dataclass, replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import chars, text
from ..operators import dedup, metrics, quality, sample, shards, split
from ..operators.quality import CleaningRules, QualityRules
from ..sources import records, sinks
from ..sources.run_log import Phase, RunLog
from ..sources.shared import held

SCRIPTS = {s.name: s for s in (chars.DEVANAGARI, chars.LATIN_SCRIPT)}


@dataclass(frozen=True)
class Settings:
    """What all three pipelines can be told. `load` reads it from JSON or YAML; quality, cleaning and calls are sections of their own."""

    version: str = "v1"
    run_id: str = "run"
    source_name: str = "corpus"
    sources: tuple[str, ...] = ("dataset", "documents")  # those that are on
    language: str = "hi"
    script: str = "Devanagari"
    remove_urls: bool = True
    near_duplicates: bool = True
    near_threshold: float = dedup.THRESHOLD
    validation: float = 0.01
    test: float = 0.01
    seed: int = 42
    shard_mb: float = 256.0
    formats: tuple[str, ...] = ("parquet", "jsonl", "txt")
    metadata: bool = True
    separator: str = "\n\n"
    sample_gb: float = 5.0
    sequence_length: int = 512
    specials: tuple[str, ...] = ("<pad>", "<unk>", "<s>", "</s>")
    quality: QualityRules = field(default_factory=QualityRules)
    cleaning: CleaningRules = field(default_factory=CleaningRules)
    calls: records.CallPolicy = field(default_factory=records.CallPolicy)

    @property
    def profile(self) -> chars.Script:
        return SCRIPTS[self.script]

    @property
    def rules(self) -> QualityRules:
        return replace(self.quality, script=self.profile)


#: The version may come from the environment.
VERSION_VARIABLE = "QUERN_VERSION"


def _read(path: Path) -> dict:
    raw = path.read_text(encoding="utf-8")
    if path.suffix in (".yaml", ".yml"):
        import yaml

        return yaml.safe_load(raw) or {}
    return json.loads(raw)


def _with(old, values: dict):
    """A dataclass with values set, sections within it likewise; names that it lacks are refused."""
    known = {f.name for f in fields(old)}
    if odd := sorted(set(values) - known):
        raise ValueError(f"unknown settings: {', '.join(odd)}")
    made = {k: _with(getattr(old, k), v) if is_dataclass(getattr(old, k)) and isinstance(v, dict) else tuple(v) if isinstance(v, list) else v for k, v in values.items()}
    return replace(old, **made)


def load(path: str | Path) -> Settings:
    """Settings of a file; names that it lacks keep their defaults, names that are none are refused.

    A section that the file lacks may have a file of its own beside it (quality.json for quality).
    """
    path = Path(path)
    values = _read(path)
    for section in ("quality", "cleaning", "calls"):
        beside = path.with_name(section + path.suffix)
        if section not in values and beside.exists() and beside != path:
            values[section] = _read(beside)
    if version := os.environ.get(VERSION_VARIABLE):
        values["version"] = version
    return _with(Settings(), values)


def normalised(rows: DataFrame, settings: Settings) -> DataFrame:
    """Records with final_text and its counts."""
    t = text.normalise(F.coalesce(text.source_text(F.col("cleaned_text"), F.col("raw_text")), F.lit("")), settings.remove_urls)
    out = held(rows.withColumn("_final", t).drop("final_text"), "final_text", F.col("_final")).drop("_final")  # made once, whatever is counted of it
    return out.withColumns(chars.counts(F.col("final_text")) | {"cleaning_method": F.coalesce("cleaning_method", F.lit("deterministic_normalization"))})


def filtered(rows: DataFrame, settings: Settings, phase: Phase | None = None) -> tuple[DataFrame, DataFrame]:
    """Records that pass the quality rules, and those that do not (with reject_reason)."""
    found = quality.annotate(rows, "final_text", settings.rules).withColumn("devanagari_ratio", F.col("script_ratio"))
    # both parts are read from what is annotated once, and counted by the job that writes it
    passed, rejected = quality.split_passed((phase or Phase()).written(found, "annotated", F.col("reject_reason").isNull()))
    return records.conform(passed), rejected


def ingest(spark: SparkSession, settings: Settings, out: str, dataset: DataFrame | None = None, documents: DataFrame | None = None, log: RunLog | None = None) -> DataFrame:
    """Records of all sources that are on, split and exported below `out`; the split profile is returned.

    `dataset` (id, text) is taken as it is; `documents` (records of pages or paragraphs) are normalised,
    filtered and deduplicated first. What the filter rejects goes to quarantine. Every exported file is
    named by version, split and shard, listed in the manifest and registered with its rows and checksum. Every
    phase is logged with the rows that it took in, passed on and rejected. A run that is tried again replaces its own output.
    """
    log = log or RunLog(spark, None, settings.run_id)
    parts, read = [], 0
    if dataset is not None and "dataset" in settings.sources:
        with log.phase("load", "dataset", source_id=settings.source_name) as phase:
            parts.append(phase.written(records.dataset_records(dataset, settings.source_name, settings.language, settings.script, settings.run_id), "dataset"))
        read += log.out()
    if documents is not None and "documents" in settings.sources:
        with log.phase("filter", "documents") as phase:
            passed, rejected = filtered(normalised(documents, settings), settings, phase)
            sinks.quarantine(rejected, f"{out}/quarantine", settings.run_id)
        with log.phase("exact_duplicates", "documents", log.out()) as phase:
            parts.append(phase.written(dedup.exact(passed.drop("dedup_hash"), "final_text", "record_id"), "exact"))
        if settings.near_duplicates:
            with log.phase("near_duplicates", "documents", log.out()) as phase:
                near = dedup.near(parts.pop(), "record_id", "final_text", "record_id", settings.near_threshold).withColumn("near_dedup_cluster_id", F.col("canonical_id"))
                parts.append(phase.written(near, "near"))
        parts.append(records.conform(parts.pop()))
        read += log.out()
    if not parts:
        raise ValueError("no source")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    staged_at = f"{out}/staged/{settings.version}"
    with log.phase("split", "records", read) as phase:
        # computed once, for sizes, shards and all formats
        by_name = {name: F.col("split_name") == name for name in ("train", "validation", "test")}
        named = phase.written(split.by_document(rows, "document_id", settings.seed, settings.validation, settings.test), "split", kinds=by_name)
        sinks.with_shards(named, settings.shard_mb).write.mode("overwrite").option("compression", "zstd").parquet(staged_at)
    staged = spark.read.parquet(staged_at)
    writers = {
        "parquet": sinks.export_parquet, "jsonl": lambda rows, path, seen: sinks.export_json_lines(rows, path, settings.metadata, seen), "txt": lambda rows, path, seen: sinks.export_text(rows, path, settings.separator, seen),
    }
    for kind in settings.formats:
        with log.phase("export", kind, read) as phase:
            writers[kind](staged, f"{out}/final/{kind}", phase.seen)
            sinks.name_files(spark, f"{out}/final/{kind}", settings.version, kind)
    ratios = {"train": 1 - settings.validation - settings.test, "validation": settings.validation, "test": settings.test}
    with log.phase("manifest", "files") as phase:
        files = phase.written(sinks.manifest(spark, f"{out}/final"), "manifest")
        files.write.mode("overwrite").json(f"{out}/reports/manifest")
        sinks.manifest_head(staged, settings.version, settings.language, settings.script, ratios).write.mode("overwrite").json(f"{out}/reports/manifest_head")
        counts = staged.groupBy("split_name", "shard").agg(F.count("*").alias("row_count"))
        registry = sinks.file_registry(files, counts, settings.run_id).drop("run_id")
        sinks.replace_run(registry, f"{out}/logs/file_registry", settings.run_id, "csv", header=True)
        profile = metrics.profile(staged, spark)
        profile.write.mode("overwrite").json(f"{out}/reports/profile")
    return profile


def sample_texts(spark: SparkSession, settings: Settings, source: str, out: str, column: str = "final_text") -> DataFrame:
    """The tokenizer sample of a folder of Parquet files, written as one document a line; one row of facts is returned."""
    rows = records.texts(spark, source, column).withColumn("id", F.sha2(F.col(column).cast("binary"), 256))
    drawn = sample.tokenizer_sample(rows, "id", column, settings.profile, int(settings.sample_gb * 1024**3), settings.seed)
    sinks.sample_file(drawn, f"{out}/sample")
    facts = spark.read.text(f"{out}/sample").agg(F.count("*").alias("documents"), F.sum(F.octet_length("value") + 1).alias("bytes"))
    facts.write.mode("overwrite").json(f"{out}/sample_manifest")
    return facts


def validate(spark: SparkSession, settings: Settings, tokenizer: str, name: str, sentences: DataFrame, unknown: int = -1) -> dict:
    """The report of a tokenizers file over validation sentences (`value`)."""
    ids = shards.decode(shards.encode(sentences.select("value"), "value", tokenizer), "ids", tokenizer, "back")
    back = F.trim(F.regexp_replace("back", f"[{chars.SPACE}]+", " "))
    row = metrics.token_metrics(ids, F.trim(F.regexp_replace("value", f"[{chars.SPACE}]+", " ")), F.col("ids"), unknown, back).first().asDict()
    alone = shards.encode(metrics.distinct_chars(sentences, "value", settings.profile), "char", tokenizer)
    row["devanagari_char_coverage"] = metrics.coverage(alone, (F.size("ids") > 0) & (F.col("ids")[0] != unknown)).first()["char_coverage"]
    special = shards.encode(spark.createDataFrame([(s,) for s in settings.specials], "token string"), "token", tokenizer)
    row["special_token_split_failures"] = metrics.split_failures(special, "ids").first()["special_token_split_failures"]
    row |= {"variant_name": name, "vocab_size": int("".join(c for c in name if c.isdigit()) or 0) * 1000}
    row["passes_thresholds"] = spark.createDataFrame([row]).select(metrics.passes()).first()[0]
    return row


def compare(spark: SparkSession, reports: list[dict], preferred: int = 32_000) -> tuple[str, str]:
    """The recommended variant, and a report of all as Markdown."""
    best = metrics.recommended(spark.createDataFrame(reports), preferred).first()["variant_name"]
    names = ("variant_name", "vocab_size", "unk_rate", "chars_per_token", "tokens_per_word", "roundtrip_success_rate", "passes_thresholds")
    return best, sinks.markdown_table([{n: r[n] for n in names} for r in reports], "Tokenizer comparison", f"Recommended: {best}")


def tokenize(spark: SparkSession, settings: Settings, source: str, tokenizer: str, out: str, end_id: int) -> DataFrame:
    """JSON lines of a folder as packed sequences by split and file; the number of each is returned. Files that are there already are skipped."""
    raw = spark.read.schema("text string, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(source)
    name = lambda path: F.regexp_extract(path, r"([^/]+?)(?:\.jsonl)?(?:\.gz)?$", 1).alias("file")
    rows = raw.where(F.col("_corrupt").isNull()).select(
        name("_metadata.file_path"), F.monotonically_increasing_id().alias("line"), text.nfkc_words(F.coalesce("text", F.lit(""))).alias("t")
    )
    fit = rows.where(quality.training_text(F.col("t"), settings.profile))
    done = sinks.finished(spark, f"{out}/parts")
    if done is not None:
        fit = fit.join(done, "file", "left_anti")
    packed = shards.windows(shards.encode(fit, "t", tokenizer, "ids", end_id), "file", "line", "ids", settings.sequence_length)
    sinks.packed(split.by_file(packed, "file", "sequence", settings.seed), f"{out}/sequences", f"{out}/parts", spark.read.format("binaryFile").load(source).select(name("path")))
    sizes = spark.read.parquet(f"{out}/sequences").groupBy("split_name").agg(F.count("*").alias("sequences"))
    sizes.write.mode("overwrite").json(f"{out}/manifest")
    return sizes
