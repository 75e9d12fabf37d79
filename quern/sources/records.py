"""Sources of corpus records."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import chars, text
from .shared import exists, held, ship

# The record table; times and hashes are texts.
_TEXT, _LONG, _DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
RECORD = T.StructType(
    [
        *[T.StructField(n, _TEXT) for n in ("record_id", "document_id", "paragraph_id", "source_type", "source_name", "source_dataset", "source_file_name", "source_url_or_path")],
        T.StructField("page_number", T.IntegerType()),
        *[T.StructField(n, _TEXT) for n in ("raw_text", "cleaned_text", "final_text", "language", "script")],
        *[T.StructField(n, _LONG) for n in ("char_count", "word_count", "estimated_token_count")],
        *[T.StructField(n, _DOUBLE) for n in ("devanagari_ratio", "latin_ratio", "digit_ratio", "symbol_ratio", "quality_score")],
        *[T.StructField(n, _TEXT) for n in ("cleaning_method", "cleaning_model", "cleaning_model_version", "cleaning_status", "dedup_hash", "near_dedup_cluster_id", "split_name", "created_at", "ingestion_run_id")],
    ]
)


def conform(df: DataFrame) -> DataFrame:
    """df with the columns of RECORD in order; what is missing is null."""
    has = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in has else F.lit(None)).cast(f.dataType).alias(f.name) for f in RECORD])


def dataset_records(rows: DataFrame, source_name: str, language: str = "hi", script: str = "Devanagari", run_id: str = "", limit: int | None = None, order: str = "id") -> DataFrame:
    """Records of a text dataset (id, text): taken as clean, final text as it is, hashed. A missing text is empty."""
    if "id" not in rows.columns:
        rows = rows.withColumn("id", F.format_string("%s_%08d", F.lit(source_name), F.monotonically_increasing_id()))
    if limit is not None:
        rows = rows.orderBy(order).limit(limit)
    t = F.coalesce(F.col("text"), F.lit("")) if "text" in rows.columns else F.lit("")
    ident = F.col("id").cast("string")
    made = rows.select(
        F.concat(ident, F.lit("_p0000")).alias("record_id"), ident.alias("document_id"), F.lit("p0000").alias("paragraph_id"), F.lit("huggingface_dataset").alias("source_type"),
        F.lit(source_name).alias("source_name"), t.alias("raw_text"), t.alias("final_text"), F.lit(language).alias("language"), F.lit(script).alias("script"),
        *[c.alias(n) for n, c in chars.counts(t).items()], F.lit("none").alias("cleaning_method"), F.lit("clean").alias("cleaning_status"),
        F.sha2(t.cast("binary"), 256).alias("dedup_hash"), F.lit(run_id).alias("ingestion_run_id"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("created_at"),
    )
    return conform(made)


def page_records(pages: DataFrame, source_name: str, shortest: int = 30, longest: int = 50_000, run_id: str = "") -> DataFrame:
    """Records of extracted pages (document_id, page_number, text): short ones skipped, long ones cut."""
    t = F.substring(chars.strip(F.col("text")), 1, longest)
    kept = pages.where(F.length(chars.strip(F.col("text"))) >= shortest)
    made = kept.select(
        F.format_string("%s_p%04d", "document_id", "page_number").alias("record_id"), "document_id", F.format_string("p%04d", "page_number").alias("paragraph_id"), F.lit("pdf").alias("source_type"),
        F.lit(source_name).alias("source_name"), F.col("page_number").cast("int").alias("page_number"), t.alias("raw_text"), F.lit("").alias("final_text"),
        *[c.alias(n) for n, c in chars.counts(t).items()], F.lit("pending").alias("cleaning_status"), F.lit(run_id).alias("ingestion_run_id"),
    )
    return conform(made)


def paragraph_records(pages: DataFrame, excluded: list[str], source_name: str, shortest: int = 50, run_id: str = "") -> DataFrame:
    """Records of the paragraphs of fetched pages (title, url, extract); numbers count kept paragraphs."""
    split = F.posexplode(text.paragraphs(text.clean_extract(F.col("extract"), excluded), shortest)).alias("_n", "_p")
    rows = pages.select(F.translate("title", " ", "_").alias("document_id"), "url", split)
    made = rows.select(
        F.format_string("%s_p%04d", "document_id", "_n").alias("record_id"), "document_id", F.format_string("p%04d", "_n").alias("paragraph_id"), F.lit("wiki").alias("source_type"),
        F.lit(source_name).alias("source_name"), F.col("url").alias("source_url_or_path"), F.col("_p").alias("raw_text"), F.lit("").alias("final_text"),
        *[c.alias(n) for n, c in chars.counts(F.col("_p")).items()], F.lit("pending").alias("cleaning_status"), F.lit(run_id).alias("ingestion_run_id"),
    )
    return conform(made)


# A fixed value: the shape of saved API answers.
EXTRACTS = "query struct<pages: map<string, struct<pageid: long, ns: int, title: string, extract: string, links: array<struct<ns: int, title: string>>>>>"


def pages_of(answers: DataFrame, column: str) -> DataFrame:
    """title and extract of API answers held in a column."""
    return answers.select(F.explode(F.map_values(F.from_json(column, EXTRACTS)["query"]["pages"])).alias("p")).select("p.title", "p.extract")


def links_of(answers: DataFrame, column: str) -> DataFrame:
    """source and target of link answers; the answers that continue one another give their pages' links once."""
    pages = answers.select(F.explode(F.map_values(F.from_json(column, EXTRACTS)["query"]["pages"])).alias("p"))
    return pages.select(F.col("p.title").alias("source"), F.explode("p.links.title").alias("target")).distinct()


def fetched_pages(spark: SparkSession, path: str) -> DataFrame:
    """title and extract of saved API answers, one a file."""
    return pages_of(spark.read.text(path, wholetext=True), "value")


def fetched_links(spark: SparkSession, path: str) -> DataFrame:
    """source and target of saved link answers, one a file."""
    return links_of(spark.read.text(path, wholetext=True), "value")


def fetched(titles: DataFrame, column: str, fetch: Callable[[str], str], policy: CallPolicy | None = None) -> DataFrame:
    """title and answer (null where it stays out) of an injected function that fetches one title, under a call policy. A title that fails counts as visited."""
    ship(titles.sparkSession)
    call = (policy or CallPolicy()).guard(fetch)

    @F.pandas_udf("string")
    def answer(batch: pd.Series) -> pd.Series:
        def one(title):
            try:
                return call(title)
            except CallError:
                return None

        return batch.map(one, na_action="ignore")

    return titles.select(F.col(column).alias("title"), answer(F.col(column)).alias("answer"))


def texts(spark: SparkSession, path: str, column: str = "final_text") -> DataFrame:
    """The text column of Parquet files without nulls; raises if there is no such column."""
    rows = spark.read.parquet(path)
    if column not in rows.columns:
        raise ValueError(f"no column {column}")
    return rows.select(F.col(column).cast("string").alias(column)).where(F.col(column).isNotNull())


def json_lines(spark: SparkSession, path: str, column: str = "text", partitions: int | None = None) -> DataFrame:
    """The texts of JSON lines; blank and malformed lines and empty texts are skipped. gzip files cannot be split, so `partitions` deals rows out."""
    rows = spark.read.schema(f"{column} string, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").option("mode", "PERMISSIVE").json(path)
    kept = rows.where(F.col("_corrupt").isNull() & (F.coalesce(F.col(column), F.lit("")) != "")).select(column)
    return kept.repartition(partitions) if partitions else kept


def sentences(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are not blank."""
    return spark.read.text(path).where(chars.strip(F.col("value")) != "")


def checkpoint(spark: SparkSession, path: str, load, force: bool = False) -> DataFrame:
    """The Parquet table at path if it is there (and not forced), else what load() gives, written there."""
    if force or not exists(spark, path):
        load().write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


# A fixed value: the fields beside a document.
METADATA = "source_id string, source_name string, file_name string, source_category string, provided_by string, license_or_usage_note string, language string, script string, notes string"


def pdf_sources(spark: SparkSession, root: str, require_metadata: bool = True) -> DataFrame:
    """The folders below root with original.pdf (content) and the fields of metadata.json beside it; raises where the latter is missing but required."""
    folder = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    pdf = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "original.pdf").load(root).select(folder.alias("folder"), "path", "content")
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "metadata.json").load(root)
    meta = raw.select(folder.alias("folder"), F.from_json(F.decode("content", "UTF-8"), METADATA).alias("m")).select("folder", "m.*")
    if require_metadata:
        missing = [r["folder"] for r in pdf.join(meta, "folder", "left_anti").select("folder").orderBy("folder").limit(20).collect()]
        if missing:
            raise FileNotFoundError(f"no metadata.json in {', '.join(missing)}")
    return pdf.join(meta, "folder", "left")


def extract_pages(sources: DataFrame, extractors: list) -> DataFrame:
    """document_id, page_number, text, engine and error of binary files. Each extractor is (name, function from bytes to page texts);
    if one fails on a file the next takes the whole file; a file that defeats all gives one row with the last `error` and no page."""
    ship(sources.sparkSession)

    def run(batches):
        for batch in batches:
            rows = []
            for source, content in zip(batch["source_id"], batch["content"]):
                error = "no engine"
                for name, extract in extractors:
                    try:
                        rows += [(source, i + 1, t, name, None) for i, t in enumerate(extract(bytes(content)))]
                        break
                    except Exception as e:  # noqa: BLE001 - the next engine takes it
                        error = f"{name}: {e}"
                else:
                    rows.append((source, None, None, None, error))
            found = pd.DataFrame(rows, columns=["document_id", "page_number", "text", "engine", "error"])
            yield found.astype({"page_number": "Int32"})

    return sources.select("source_id", "content").mapInPandas(run, "document_id string, page_number int, text string, engine string, error string")


class CallError(RuntimeError):
    """A call that failed for good."""


@dataclass(frozen=True)
class CallPolicy:
    """How an outside service is called: at most `attempts` times where `transient` errors occur, with waits of base, 2 base, 4 base ... seconds; any other error is final at once."""

    enabled: bool = True
    attempts: int = 3
    base_seconds: float = 2.0
    transient: tuple[type[Exception], ...] = (TimeoutError, ConnectionError)

    def guard(self, call: Callable[[str], str]) -> Callable[[str], str]:
        def tried(value: str) -> str:
            for n in range(self.attempts):
                try:
                    return call(value)
                except self.transient as e:
                    last = e
                    if n + 1 < self.attempts:
                        time.sleep(self.base_seconds * 2**n)
                except Exception as e:
                    raise CallError(str(e)) from e
            raise CallError(f"no answer in {self.attempts} attempts") from last

        return tried


def cleaned_by(df: DataFrame, column: str, clean: Callable[[str], str], size: int = 6000, overlap: int = 200, out: str = "cleaned_text", policy: CallPolicy | None = None) -> DataFrame:
    """df with `column` cleaned by an injected function of one text, window by window (paragraph-aware), joined by blank lines.

    A policy that is not enabled takes the column as it is. Calls that fail for good fail the job.
    """
    policy = policy or CallPolicy()
    if not policy.enabled:
        return df.withColumn(out, F.col(column))
    ship(df.sparkSession)
    call = policy.guard(clean)

    @F.pandas_udf("string")
    def cleaned(batch: pd.Series) -> pd.Series:
        return batch.map(lambda windows: "\n\n".join(call(w) for w in windows).strip())

    return held(df, "_windows", text.chunks_at_paragraphs(F.col(column), size, overlap)).withColumn(out, cleaned(F.col("_windows"))).drop("_windows")


def reports(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Validation reports; missing thresholds get the usual ones."""
    from ..operators.metrics import GATE

    bounds = {"unk_rate": "max_unk_rate", "chars_per_token": "min_chars_per_token", "tokens_per_word": "max_tokens_per_word", "roundtrip_success_rate": "min_roundtrip_success_rate"}
    schema = (
        "variant_name string, vocab_size int, tokenizer_version string, unk_rate double, chars_per_token double, tokens_per_word double, roundtrip_success_rate double, "
        "devanagari_char_coverage double, special_token_split_failures int, passes_thresholds boolean, thresholds struct<" + ", ".join(f"{v}: double" for v in bounds.values()) + ">"
    )
    rows = spark.read.schema(schema).option("multiLine", True).json(paths)
    filled = F.struct(*[F.coalesce(F.col(f"thresholds.{v}"), F.lit(float(GATE[k]))).alias(v) for k, v in bounds.items()])
    return rows.withColumn("thresholds", filled)


def synthetic(spark: SparkSession, lines: list[str] | DataFrame, rows: int = 500) -> DataFrame:
    """id and text: given paragraphs over and over; those of a table (_n from 0, text) are joined to the ids, not collected."""
    base = lines if isinstance(lines, DataFrame) else spark.createDataFrame(list(enumerate(lines)), "_n long, text string")
    ids = spark.range(rows).crossJoin(base.agg(F.count("*").alias("_of"))).withColumn("_n", F.col("id") % F.col("_of"))
    return ids.join(base, "_n").select("id", "text")

