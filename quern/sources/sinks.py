"""Sinks: sharded exports, quarantine, manifests, logs and reports."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import order, shards
from .shared import delete, exists, filesystem

#: What looks at rows right before they are written (run_log.Phase.seen).
Seen = Callable[[DataFrame], DataFrame]


def with_shards(records: DataFrame, megabytes: float = 256, seed: int = 42) -> DataFrame:
    """Records with `shard` by next-fit on the bytes of final_text, in the seeded order of record_id (unique).

    Places and shards are found on ids and sizes; texts move once, to their shards. Each split is filled
    in ranges of shards.RANGE_IDS records, so that no task fills a whole split; shards do not depend on them.
    """
    sizes = records.select("split_name", "record_id", F.octet_length(F.coalesce("final_text", F.lit(""))).cast("long").alias("_size"))
    ranked = order.rank(sizes, seed, "record_id", "_order", by=("split_name",))
    placed = shards.next_fit(ranked, "split_name", "_order", "_size", int(megabytes * 1024 * 1024))
    named = ranked.join(placed, ["split_name", "_order"]).select("record_id", "shard")
    return records.join(named, "record_id").select(*records.columns, "shard")


def replace(rows: DataFrame, path: str, by: list[str], kind: str = "parquet", **options) -> None:
    """Write rows in folders by the columns `by`; folders that are there and get rows are replaced as the job commits, others stay.

    Run again, a job leaves what one run would. Spark removes and moves the folders in one commit.
    """
    options = {"compression": "zstd"} | options if kind == "parquet" else options
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options).partitionBy(*by).format(kind).save(path)


def replace_run(rows: DataFrame, path: str, run_id: str, kind: str = "parquet", **options) -> None:
    """The rows of a run at path, instead of those that an earlier try of the run left there (also if there are none now)."""
    own = f"{path}/run_id={run_id}"
    if rows.isEmpty():
        if exists(rows.sparkSession, own):
            delete(rows.sparkSession, own)
    else:
        replace(rows.withColumn("run_id", F.lit(run_id)), path, ["run_id"], kind, **options)


def export_parquet(sharded: DataFrame, path: str, seen: Seen = lambda rows: rows) -> None:
    seen(sharded.repartition("split_name", "shard")).write.mode("overwrite").option("compression", "zstd").partitionBy("split_name", "shard").parquet(path)


def export_json_lines(sharded: DataFrame, path: str, metadata: bool = True, seen: Seen = lambda rows: rows) -> None:
    """gzip JSON lines with `text` and, if asked for, where it comes from."""
    fields = [F.col("final_text").alias("text"), *(["source_type", "document_id", "record_id"] if metadata else [])]
    lines = sharded.select("split_name", "shard", F.to_json(F.struct(*fields)).alias("value"))
    seen(lines.repartition("split_name", "shard")).write.mode("overwrite").option("compression", "gzip").partitionBy("split_name", "shard").text(path)


def export_text(sharded: DataFrame, path: str, separator: str = "\n\n", seen: Seen = lambda rows: rows) -> None:
    """gzip texts with a separator after each."""
    lines = sharded.select("split_name", "shard", F.col("final_text").alias("value"))
    seen(lines.repartition("split_name", "shard")).write.mode("overwrite").option("compression", "gzip").option("lineSep", separator).partitionBy("split_name", "shard").text(path)


# The ends of exported files' names.
ENDINGS = {"parquet": ".parquet", "jsonl": ".jsonl.gz", "txt": ".txt.gz"}


def name_files(spark: SparkSession, folder: str, version: str, kind: str) -> list[tuple[str, str, int]]:
    """Give the files of an export by split_name and shard the names split/version_split_00000.kind; split, path and shard of each.

    Renames only, a call per file.
    """
    fs, root = filesystem(spark, folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    out = []
    for split in [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("split_name=")]:
        name = split.getName().split("=", 1)[1]
        fs.mkdirs(path(root, name))
        for shard in (s.getPath() for s in fs.listStatus(split)):
            n = int(shard.getName().split("=", 1)[1])
            for part in (s.getPath() for s in fs.listStatus(shard) if not s.getPath().getName().startswith(("_", "."))):
                target = path(path(root, name), f"{version}_{name}_{n:05d}{ENDINGS[kind]}")
                if not fs.rename(part, target):
                    raise OSError(f"{target} is in the way")
                out.append((name, target.toString(), n))
        fs.delete(split, True)
    return sorted(out)


def manifest_head(records: DataFrame, version: str, language: str, script: str, ratios: dict[str, float]) -> DataFrame:
    """One row: version, time, language, script, the sources that the records name, and the ratios of the splits."""
    sources = records.select("source_name", "source_type").distinct()
    return sources.agg(F.array_sort(F.collect_list(F.struct("source_name", "source_type"))).alias("sources")).select(
        F.lit(version).alias("corpus_version"), F.lit(_now()).alias("created_at"), F.lit(language).alias("language"), F.lit(script).alias("script"), "sources",
        F.struct(*[F.lit(float(v)).alias(k) for k, v in ratios.items()]).alias("splits"),
    )


def file_registry(files: DataFrame, counts: DataFrame, run_id: str, role: str = "output", stage: str = "export") -> DataFrame:
    """A row of REGISTRY for each file of a manifest; `counts` (split_name, shard, row_count) has what an export's shards hold."""
    shard = F.regexp_extract("path", r"_(\d{5})\.[^/]*$", 1).try_cast("int")
    rows = files.withColumn("shard", shard).join(counts, ["split_name", "shard"], "left")
    made = {
        "run_id": F.lit(run_id), "timestamp": F.lit(_now()), "role": F.lit(role), "stage": F.lit(stage), "source_id": F.lit(""), "file_path": F.col("path"),
        "file_name": F.element_at(F.split("path", "/"), -1), "format": F.col("format"), "size_bytes": F.col("size_bytes"), "row_count": F.col("row_count"), "sha256": F.col("sha256"),
        "compression": F.col("compression"), "notes": F.concat(F.lit("split="), "split_name", F.lit(",shard_index="), F.col("shard").cast("string")),
    }
    return rows.select(*[made[c].alias(c) for c in REGISTRY])


def evaluation_report(step: int, validation: float, test: float, averages: dict, samples: list[dict]) -> str:
    """The report of an evaluation: perplexities, averages over samples, and the samples."""
    facts = {
        "Validation Perplexity": f"{validation:.2f}", "Test Perplexity": f"{test:.2f}", "Avg script ratio (generated)": f"{averages['script_ratio']:.3f}", "Avg UNK tokens per sample": f"{averages['unknowns']:.1f}",
    }
    table = markdown_table([{"Metric": k, "Value": v} for k, v in facts.items()], "Evaluation Report", f"Checkpoint step: {step}")
    shown = [f"## Sample {i}\n\nPrompt: {s['prompt']}\n\nGenerated: {s['generated']}\n" for i, s in enumerate(samples, 1)]
    return "\n".join([table, *shown])


def quarantine(rows: DataFrame, path: str, run_id: str) -> None:
    """The rejected rows of a run; a run that is tried again replaces its own. Nothing is written without any."""
    replace_run(rows, path, run_id)


def sample_file(sample: DataFrame, path: str) -> None:
    sample.select("value").write.mode("overwrite").text(path)


def packed(sequences: DataFrame, path: str, parts: str, files: DataFrame | None = None) -> None:
    """Packed sequences by split and file, then a row (file, sequences) per file below `parts`: only with that row is a file done.

    Files that are done are skipped. What a job left that ended before it wrote the rows is replaced by the next.
    `files` (file) are those that were read: one without a full sequence is done too.
    """
    spark, done = sequences.sparkSession, finished(sequences.sparkSession, parts)
    rows = sequences if done is None else sequences.join(done, "file", "left_anti")
    replace(rows, path, ["split_name", "file"])
    read = sequences.select("file").distinct() if files is None else files.select("file").distinct()
    new = read if done is None else read.join(done, "file", "left_anti")
    made = spark.read.schema(sequences.schema).parquet(path).groupBy("file").agg(F.count("*").alias("sequences")) if exists(spark, path) else spark.createDataFrame([], "file string, sequences long")
    counted = new.join(made, "file", "left").select("file", F.coalesce("sequences", F.lit(0)).cast("long").alias("sequences"))
    counted.coalesce(1).write.mode("append").parquet(parts)


def finished(spark: SparkSession, parts: str) -> DataFrame | None:
    """The files (file) that `packed` has done; None before its first."""
    return spark.read.schema("file string, sequences long").parquet(parts).select("file").distinct() if exists(spark, parts) else None


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return shards.file_manifest(files)


def checksum_map(spark: SparkSession, folder: str) -> dict[str, str]:
    """Checksums by path, of an artefact's few files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return dict(sorted((path, digest) for row in shards.checksums(files).collect() for path, digest in row["checksums"].items()))


# The columns of the registry of files.
REGISTRY = ["run_id", "timestamp", "role", "stage", "source_id", "file_path", "file_name", "format", "size_bytes", "row_count", "sha256", "compression", "notes"]


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def json_report(row: dict, path: str | Path) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(row, ensure_ascii=False, indent=2), encoding="utf-8")


def markdown_table(rows: list[dict], title: str, note: str = "") -> str:
    """A report: a title, a table of the rows and a note."""
    if not rows:
        return f"# {title}\n\n{note}\n"
    names = list(rows[0])
    cell = lambda v: f"{v:.4f}" if isinstance(v, float) else str(v)
    lines = ["| " + " | ".join(names) + " |", "|" + "---|" * len(names), *("| " + " | ".join(cell(r[n]) for n in names) + " |" for r in rows)]
    return f"# {title}\n\n" + "\n".join(lines) + f"\n\n{note}\n"
