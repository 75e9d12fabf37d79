"""Registered queries of sources, sinks, samples and reports, with their SQL. Files go to the shared folder and are read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import chars, text
from ..operators import links, metrics, order, quality, sample, shards, split
from ..sources import records, sinks
from ..sources.shared import held, scratch, written
from ..streaming import ingest
from .registry import (
    _CONV_SPLIT, _CONVERSATION, _EDGES, _TOKENS, NORMALISED, ORACLE_SQL, QUERIES, REASON, RULES, SCRIPT, SEED, SR, WORDS, N, S, T, _conversations, _edges, _sequences, _strip, digest, query, streamed, table,
)

__all__ = ["ORACLE_SQL", "QUERIES"]

# Sources


def _docs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")


_RECORD_SQL = f"""SELECT doc_id || '_p0000' AS record_id, doc_id::VARCHAR AS document_id, 'p0000' AS paragraph_id, 'corpus' AS source_name, md5({T}) AS final, {N}::BIGINT AS char_count,
  {WORDS}::BIGINT AS word_count, sha256({T}) AS dedup_hash, 'none' AS cleaning_method, 'clean' AS cleaning_status FROM documents"""


def _record_columns(rows: DataFrame) -> DataFrame:
    return rows.select("record_id", "document_id", "paragraph_id", "source_name", digest(F.col("final_text")).alias("final"), "char_count", "word_count", "dedup_hash", "cleaning_method", "cleaning_status")


@query(_RECORD_SQL)
def dataset_records(spark, sf_dir):
    return _record_columns(records.dataset_records(_docs(spark, sf_dir), "corpus"))


@query(f"{_RECORD_SQL} ORDER BY doc_id LIMIT 100")
def dataset_records_first(spark, sf_dir):
    return _record_columns(records.dataset_records(_docs(spark, sf_dir), "corpus", limit=100))


@query(f"SELECT doc_id AS id, md5({T}) AS digest FROM documents")
def checkpoint_scan(spark, sf_dir):
    path = scratch(spark, "checkpoint")
    records.checkpoint(spark, path, lambda: _docs(spark, sf_dir).withColumn("text", F.coalesce("text", F.lit(""))))
    return records.checkpoint(spark, path, lambda: spark.range(0)).select("id", digest(F.col("text")).alias("digest"))


@query(f"""SELECT conv_id || '_p' || lpad(turn::VARCHAR, 4, '0') AS record_id, turn::INT AS page_number, md5(substr({_strip("text")}, 1, 80)) AS digest, 'pending' AS cleaning_status
FROM conversations WHERE length({_strip("text")}) >= 40""")
def page_records(spark, sf_dir):
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("document_id"), F.col("turn").alias("page_number"), "text")
    return records.page_records(pages, "pages", 40, 80).select("record_id", "page_number", digest(F.col("raw_text")).alias("digest"), "cleaning_status")


def _by_halves(content: bytes) -> list[str]:
    t = content.decode()
    if len(t) % 3 == 0:
        raise ValueError("not for this engine")
    return [t[: len(t) // 2], t[len(t) // 2 :]]


def _whole(content: bytes) -> list[str]:
    t = content.decode()
    if len(t) % 2 == 0:
        raise ValueError("not for this engine either")
    return [t]


@query("""SELECT page_id::VARCHAR AS document_id, 1 AS page_number, md5(substr(html, 1, length(html) // 2)) AS digest, 'halves' AS engine, NULL::VARCHAR AS error FROM pages WHERE length(html) % 3 <> 0
UNION ALL SELECT page_id::VARCHAR, 2, md5(substr(html, length(html) // 2 + 1)), 'halves', NULL FROM pages WHERE length(html) % 3 <> 0
UNION ALL SELECT page_id::VARCHAR, 1, md5(html), 'whole', NULL FROM pages WHERE length(html) % 6 = 3
UNION ALL SELECT page_id::VARCHAR, NULL, NULL, NULL, 'whole: not for this engine either' FROM pages WHERE length(html) % 6 = 0""")
def extraction_fallback(spark, sf_dir):
    files = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("source_id"), F.encode("html", "UTF-8").alias("content"))
    found = records.extract_pages(files, [("halves", _by_halves), ("whole", _whole)])
    return found.select("document_id", "page_number", digest(F.col("text")).alias("digest"), "engine", "error")


def _answers(spark, sf_dir) -> DataFrame:
    """Answers of a page API, one a page, made of the pages' titles and links."""
    pages = table(spark, sf_dir, "pages")
    found = F.transform(F.regexp_extract_all("html", F.lit(r'<a href="/([^"#]+)"'), F.lit(1)), lambda t: F.struct(F.lit(0).alias("ns"), t.alias("title")))
    page = F.struct("page_id", F.lit(0).alias("ns"), F.regexp_extract("html", "<h1>([^ <]+)", 1).alias("title"), F.col("html").alias("extract"), found.alias("links"))
    return pages.select(F.to_json(F.struct(F.struct(F.create_map(F.col("page_id").cast("string"), page).alias("pages")).alias("query"))).alias("answer"))


@query("SELECT regexp_extract(html, '<h1>([^ <]+)', 1) AS title, md5(html) AS digest FROM pages")
def fetched_pages(spark, sf_dir):
    return records.pages_of(_answers(spark, sf_dir), "answer").select("title", digest(F.col("extract")).alias("digest"))


@query(f"WITH {_EDGES} SELECT source, target FROM e")
def fetched_links(spark, sf_dir):
    return records.links_of(_answers(spark, sf_dir), "answer")


@query(f"SELECT md5(text) AS digest, count(*) AS n FROM documents WHERE text IS NOT NULL AND doc_id % 5 <> 0 GROUP BY md5(text)")
def text_column_scan(spark, sf_dir):
    path = scratch(spark, "texts")
    table(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 5 != 0, F.col("text")).alias("final_text")).write.parquet(path)
    return records.texts(spark, path).groupBy(digest(F.col("final_text")).alias("digest")).agg(F.count("*").alias("n"))


@query("SELECT md5(text) AS digest, count(*) AS n FROM documents WHERE text <> '' AND doc_id % 4 <> 1 GROUP BY md5(text)")
def json_lines_scan(spark, sf_dir):
    """Every fourth line is malformed."""
    path = scratch(spark, "lines")
    line = F.to_json(F.struct("text"))
    table(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 4 == 1, F.concat(F.lit('{"text": '), F.col("doc_id"), F.lit(","))).otherwise(line).alias("value")).write.option("compression", "gzip").text(path)
    return records.json_lines(spark, path, partitions=8).groupBy(digest(F.col("text")).alias("digest")).agg(F.count("*").alias("n"))


@query(f"SELECT md5(x) AS digest, count(*) AS n FROM (SELECT unnest(string_split(text, E'\\n')) AS x FROM conversations) WHERE {_strip('x')} <> '' GROUP BY md5(x)")
def validation_sentences(spark, sf_dir):
    path = scratch(spark, "sentences")
    table(spark, sf_dir, "conversations").select(F.col("text").alias("value")).where("value IS NOT NULL").write.text(path)
    return records.sentences(spark, path).groupBy(digest(F.col("value")).alias("digest")).agg(F.count("*").alias("n"))


@query("SELECT i AS id, r_name AS text FROM range(500) q(i) JOIN region ON r_regionkey = i % 5")
def synthetic_rows(spark, sf_dir):
    names = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("_n"), F.col("r_name").alias("text"))
    return records.synthetic(spark, names, 500)


_STREAM_RANK = "row_number() OVER (ORDER BY doc_id) - 1"


@query(f"""WITH r AS (SELECT doc_id, ({_STREAM_RANK}) // 64 AS run FROM documents)
SELECT doc_id, run * 64 + row_number() OVER (PARTITION BY run ORDER BY md5('{SEED}:' || doc_id), doc_id) - 1 AS place FROM r""")
def shuffle_buffer(spark, sf_dir):
    return order.buffer_shuffle(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 64, SEED)


@query(f"""WITH {_TOKENS}, g AS (SELECT row_number() OVER (ORDER BY lang, sequence) - 1 AS k, input_ids FROM q),
d AS (SELECT k // 2 AS k, flatten(list(input_ids ORDER BY k)) AS input_ids FROM g GROUP BY k // 2 HAVING count(*) = 2), m AS (SELECT (coalesce(max(k), -1) + 1) // 4 AS n FROM d)
SELECT k // 4 AS batch, (k % 4)::INT AS place, md5(array_to_string(input_ids, ',')) AS digest FROM d, m WHERE k // 4 < n""")
def loader_batches(spark, sf_dir):
    found = shards.batches(written(_sequences(spark, sf_dir), "sequences"), "lang", "sequence", "input_ids", 4, factor=2)
    return found.select("batch", "place", digest(F.array_join(F.transform("input_ids", lambda i: i.cast("string")), ",")).alias("digest"))


_VARIANT = "p_name || ' ' || (8 * (1 + p_size % 6)) || 'k' AS variant_name, 8000 * (1 + p_size % 6) AS vocab_size, p_size / 25000 AS unk_rate, 2.5 + p_size / 20 AS chars_per_token, 1 + p_size / 25 AS tokens_per_word"
_PASSES = "unk_rate < 0.001 AND chars_per_token > 3.0 AND tokens_per_word < 2.5"


def _variants(spark, sf_dir) -> DataFrame:
    """Made-up reports, one a part."""
    size = F.col("p_size")
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat("p_name", F.lit(" "), (8 * (1 + size % 6)).cast("string"), F.lit("k")).alias("variant_name"), (size / 25_000).alias("unk_rate"), (2.5 + size / 20).alias("chars_per_token"),
        (1 + size / 25).alias("tokens_per_word"), F.lit(1.0).alias("roundtrip_success_rate"), F.lit(1.0).alias("devanagari_char_coverage"), F.lit(0).alias("special_token_split_failures"),
    )
    return rows.withColumn("vocab_size", text.vocab_size(F.col("variant_name")))


@query(f"SELECT p_partkey, vocab_size::INT AS vocab_size, {_PASSES} AS passes FROM (SELECT p_partkey, {_VARIANT} FROM part)")
def gate(spark, sf_dir):
    return _variants(spark, sf_dir).select("p_partkey", "vocab_size", metrics.passes().alias("passes"))


@query(f"SELECT variant_name, vocab_size::INT AS vocab_size FROM (SELECT {_VARIANT} FROM part) WHERE {_PASSES} ORDER BY unk_rate, (vocab_size <> 32000)::INT, vocab_size, variant_name LIMIT 1")
def recommended_report(spark, sf_dir):
    return metrics.recommended(_variants(spark, sf_dir)).select("variant_name", "vocab_size")


@query(f"SELECT count(*) AS variants, vocab_size::INT AS vocab_size FROM (SELECT p_partkey, p_size, {_VARIANT} FROM part) WHERE vocab_size IN (SELECT 8000 * (1 + r_regionkey) FROM region WHERE r_regionkey < 3) GROUP BY vocab_size")
def variants_with_reports(spark, sf_dir):
    reports = table(spark, sf_dir, "region").where("r_regionkey < 3").select((8000 * (1 + F.col("r_regionkey"))).alias("vocab_size"))
    return metrics.reported(_variants(spark, sf_dir), reports).groupBy("vocab_size").agg(F.count("*").alias("variants"))


@query("SELECT r_name AS variant_name, 8000 * (1 + r_regionkey) AS vocab_size, r_regionkey / 100 AS unk_rate, CASE WHEN r_regionkey % 2 = 0 THEN 0.5 ELSE 0.001 END::DOUBLE AS max_unk_rate, 3.0::DOUBLE AS min_chars_per_token FROM region")
def validation_reports(spark, sf_dir):
    path, k = scratch(spark, "reports"), F.col("r_regionkey")
    bounds = F.when(k % 2 == 0, F.struct(F.lit(0.5).alias("max_unk_rate")))
    row = F.struct(F.col("r_name").alias("variant_name"), (8000 * (1 + k)).alias("vocab_size"), (k / 100).alias("unk_rate"), bounds.alias("thresholds"), F.lit(1).alias("unknown_field"))
    table(spark, sf_dir, "region").repartitionByRange(8, "r_regionkey").select(F.to_json(row).alias("value"), F.col("r_regionkey").alias("n")).write.partitionBy("n").text(path)  # a file each
    found = records.reports(spark, [f"{path}/n={i}" for i in range(5)])
    return found.select("variant_name", "vocab_size", "unk_rate", "thresholds.max_unk_rate", "thresholds.min_chars_per_token")


@query("SELECT s_suppkey, s_suppkey * 1000 AS vocab_size FROM supplier")
def vocab_sizes(spark, sf_dir):
    named = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("unigram_"), F.col("s_suppkey").cast("string"), F.lit("k_v1")).alias("name"))
    return named.select("s_suppkey", text.vocab_size(F.col("name")).cast("long").alias("vocab_size"))


# Texts


@query("SELECT page_id, md5(coalesce(nullif(CASE WHEN page_id % 3 = 0 THEN '' WHEN page_id % 3 = 1 THEN url END, ''), html)) AS digest FROM pages")
def source_pick(spark, sf_dir):
    part = F.col("page_id") % 3
    cleaned = F.when(part == 0, "").when(part == 1, F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", digest(text.source_text(cleaned, F.col("html"))).alias("digest"))


@query(r"SELECT page_id, replace(regexp_replace(regexp_replace(url, '^[a-z]+://[^/]*/', ''), '[?#].*$', ''), '_', ' ') || '+x' AS title FROM pages")
def wiki_titles(spark, sf_dir):
    tail = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://[^/]*/", ""), "[?#].*$", "")
    return table(spark, sf_dir, "pages").select("page_id", text.page_title(F.concat(F.lit("https://w.example.org/a/wiki/"), tail, F.lit("+x?q=1"))).alias("title"))


_BODY = "translate(text, E'=\\n', '')"


_SECTIONS = rf"""(SELECT conv_id, 'Lead' || string_agg(CASE WHEN role = 'user' THEN '' ELSE E'\n' || role || E'\n' || {_BODY} END, '' ORDER BY turn, role, text) AS t FROM conversations WHERE text IS NOT NULL GROUP BY conv_id)"""


@query(rf"""SELECT conv_id, md5({_strip(r"regexp_replace(t, '\n{3,}', E'\n\n', 'g')")}) AS digest FROM {_SECTIONS}""")
def clean_extracts(spark, sf_dir):
    """Pages of one section a turn, without those of the user."""
    section = F.concat(F.lit("\n== "), "role", F.lit(" ==\n"), F.translate("text", "=\n", ""))
    pages = table(spark, sf_dir, "conversations").where("text IS NOT NULL").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", section.alias("t")))).alias("all"))
    extract = F.concat(F.lit("Lead"), F.array_join(F.transform("all", lambda x: x["t"]), ""))
    return pages.select("conv_id", digest(text.clean_extract(extract, ["user"])).alias("digest"))


@query(f"""WITH RECURSIVE t AS (SELECT conv_id, t, length(t) AS n FROM {_CONVERSATION}),
w AS (SELECT conv_id, 0 AS chunk, 0 AS pos FROM t UNION ALL SELECT conv_id, chunk + 1, greatest(pos + 1, stop - 100) FROM (SELECT w.*, n,
    CASE WHEN list_max(list_filter(range(pos + 1, pos + 399), lambda i: substr(t, i + 1, 2) = E'\\n\\n')) IS NOT NULL THEN list_max(list_filter(range(pos + 1, pos + 399), lambda i: substr(t, i + 1, 2) = E'\\n\\n')) ELSE pos + 400 END AS stop
  FROM w JOIN t USING (conv_id)) WHERE pos + 400 < n),
e AS (SELECT w.*, t, n, lead(pos) OVER (PARTITION BY conv_id ORDER BY chunk) AS nxt,
  list_max(list_filter(range(pos + 1, pos + 399), lambda i: substr(t, i + 1, 2) = E'\\n\\n')) AS cut FROM w JOIN t USING (conv_id)),
p AS (SELECT conv_id, chunk, CASE WHEN nxt IS NULL THEN substr(t, pos + 1) ELSE substr(t, pos + 1, coalesce(cut, pos + 400) - pos) END AS c FROM e)
SELECT conv_id, chunk::INT AS chunk, length(c)::INT AS chars, md5(c) AS digest FROM p""")
def paragraph_aware_chunks(spark, sf_dir):
    rows = _conversations(spark, sf_dir).select("conv_id", F.posexplode(text.chunks_at_paragraphs(F.col("t"), 400, 100)).alias("chunk", "t"))
    return rows.select("conv_id", "chunk", F.length("t").alias("chars"), digest(F.col("t")).alias("digest"))


# DuckDB has NFC but no NFKC; the two differ in compatibility characters alone, of which the driver's tables hold none.
_NFKC = f"trim(regexp_replace(nfc_normalize({T}), '[{S}]+', ' ', 'g'))"
_FIT = f"length(t) BETWEEN 30 AND 5000 AND length(regexp_replace(t, '[^{SCRIPT}]+', '', 'g')) >= 0.6 * length(regexp_replace(t, '[{S}]+', '', 'g'))"


@query(f"""SELECT doc_id, md5(t) AS digest, {_FIT} AS fit_for_sample, length(t) BETWEEN 50 AND 50000 AND length(regexp_replace(t, '[^{SCRIPT}]+', '', 'g')) / nullif(length(t), 0) >= 0.6 AS fit_for_training
FROM (SELECT doc_id, {_NFKC} AS t FROM documents)""")
def nfkc_words(spark, sf_dir):
    rows = held(table(spark, sf_dir, "documents").select("doc_id", "text"), "t", text.nfkc_words(F.coalesce("text", F.lit(""))))
    fit = quality.sampled_text(F.col("t"), chars.LATIN_SCRIPT)
    return rows.select("doc_id", digest(F.col("t")).alias("digest"), fit.alias("fit_for_sample"), quality.training_text(F.col("t"), chars.LATIN_SCRIPT).alias("fit_for_training"))


_SAMPLE = f"""WITH n AS (SELECT doc_id, {_NFKC} AS t FROM documents WHERE text IS NOT NULL), f AS (SELECT doc_id, t FROM n WHERE {_FIT}),
b AS (SELECT doc_id, t, sum(strlen(t) + 1) OVER (ORDER BY md5('{SEED}:' || doc_id), doc_id) - strlen(t) - 1 AS before FROM f)"""


@query(f"{_SAMPLE} SELECT doc_id, md5(t) AS digest FROM b WHERE before < 500000")
def tokenizer_sample(spark, sf_dir):
    rows = sample.tokenizer_sample(table(spark, sf_dir, "documents"), "doc_id", "text", chars.LATIN_SCRIPT, 500_000, SEED)
    return rows.select("doc_id", digest(F.col("value")).alias("digest"))


@query(f"{_SAMPLE} SELECT md5(t) AS digest, count(*) AS n FROM b WHERE before < 500000 GROUP BY md5(t)")
def sample_file(spark, sf_dir):
    path = scratch(spark, "sample")
    sinks.sample_file(sample.tokenizer_sample(table(spark, sf_dir, "documents"), "doc_id", "text", chars.LATIN_SCRIPT, 500_000, SEED), path)
    return spark.read.text(path).groupBy(digest(F.col("value")).alias("digest")).agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, md5({T}) AS digest FROM documents")
def tokenizer_round_trip(spark, sf_dir):
    """Texts encoded and decoded by a byte-level tokenizer come back."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return shards.decode(shards.encode(docs, "text", path), "ids", path, "back").select("doc_id", digest(F.col("back")).alias("digest"))


# Sinks


@query(f"SELECT doc_id, {REASON} AS reject_reason, 'r1' AS run_id FROM documents WHERE ({REASON}) IS NOT NULL")
def quarantine_rows(spark, sf_dir):
    path = scratch(spark, "quarantine")
    rejected = written(quality.split_passed(quality.annotate(table(spark, sf_dir, "documents"), "text", RULES))[1].select("doc_id", "reject_reason"), "rejected")
    for _ in range(2):  # a run that is tried again replaces its own rows
        sinks.quarantine(rejected, path, "r1")
    sinks.quarantine(rejected.where("false"), path, "r2")
    return spark.read.parquet(path)


_EXPORT = f"""{_CONV_SPLIT}, x AS (SELECT conv_id, turn, conv_id || '_' || turn AS record_id, {T} AS t, split_name FROM conversations JOIN named USING (conv_id)),
o AS (SELECT *, strlen(t) AS n, row_number() OVER (PARTITION BY split_name ORDER BY md5('{SEED}:' || record_id), record_id) AS k FROM x),
f AS (SELECT split_name, record_id, t, k, n AS held, 0 AS shard FROM o WHERE k = 1 UNION ALL
  SELECT o.split_name, o.record_id, o.t, o.k, CASE WHEN f.held > 0 AND f.held + o.n > 20971 THEN o.n ELSE f.held + o.n END, f.shard + CASE WHEN f.held > 0 AND f.held + o.n > 20971 THEN 1 ELSE 0 END
  FROM f JOIN o ON o.split_name = f.split_name AND o.k = f.k + 1)"""


def _sharded(spark, sf_dir) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    named = split.by_document(turns, "conv_id", SEED, 0.05, 0.05)
    rows = named.select(
        F.concat_ws("_", "conv_id", "turn").alias("record_id"), F.col("conv_id").cast("string").alias("document_id"), F.lit("wiki").alias("source_type"), F.lit("talk").alias("source_name"), F.col("text").alias("final_text"), "split_name",
    )
    return written(sinks.with_shards(rows, 0.02, SEED), "sharded")


@query(f"WITH RECURSIVE {_EXPORT} SELECT 'v7_' || split_name || '_' || lpad(shard::VARCHAR, 5, '0') || '.parquet' AS file_name, split_name, count(*) AS row_count, 'zstd' AS compression FROM f GROUP BY split_name, shard")
def exported_files(spark, sf_dir):
    """The registry of an export to Parquet: names, splits and rows of the files."""
    sharded, path = _sharded(spark, sf_dir), scratch(spark, "export")
    sinks.export_parquet(sharded, path)
    sinks.name_files(spark, path, "v7", "parquet")
    counts = sharded.groupBy("split_name", "shard").agg(F.count("*").alias("row_count"))
    found = sinks.file_registry(sinks.manifest(spark, path), counts, "run")
    return found.select("file_name", F.regexp_extract("notes", "split=([a-z]+)", 1).alias("split_name"), "row_count", "compression")


@query(f"WITH RECURSIVE {_EXPORT} SELECT record_id, split_name, shard, md5(t) AS digest FROM f")
def exported_json_lines(spark, sf_dir):
    path = scratch(spark, "export")
    sinks.export_json_lines(_sharded(spark, sf_dir), path)
    rows = spark.read.schema("text string, source_type string, document_id string, record_id string, split_name string, shard int").json(path)
    return rows.select("record_id", "split_name", "shard", digest(F.coalesce("text", F.lit(""))).alias("digest"))


@query(f"WITH RECURSIVE {_EXPORT} SELECT split_name, shard, sum(strlen(t) + 3)::BIGINT AS bytes FROM f GROUP BY split_name, shard")
def exported_texts(spark, sf_dir):
    """Bytes of each text file: those of its texts and of a separator after each."""
    path = scratch(spark, "export")
    sinks.export_text(_sharded(spark, sf_dir).withColumn("final_text", F.coalesce("final_text", F.lit(""))), path, separator="\n~\n")
    whole = spark.read.text(path, wholetext=True)
    return whole.groupBy("split_name", "shard").agg(F.sum(F.octet_length("value")).alias("bytes"))


@query("SELECT 'v7' AS corpus_version, 'de' AS language, lang AS source_name, source AS source_type, 0.9::DOUBLE AS train FROM (SELECT DISTINCT lang, source FROM documents)")
def manifest_sources(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("lang").alias("source_name"), F.col("source").alias("source_type"))
    head = sinks.manifest_head(rows, "v7", "de", "Latin", {"train": 0.9, "validation": 0.05, "test": 0.05})
    return head.select("corpus_version", "language", F.explode("sources").alias("s"), "splits.train").select("corpus_version", "language", "s.source_name", "s.source_type", "train")


def _as_files(spark, sf_dir) -> DataFrame:
    ending = F.element_at(F.array(*[F.lit(x) for x in (".parquet", ".jsonl.gz", ".json")]), (F.col("page_id") % 3 + 1).cast("int"))
    part = F.element_at(F.array(*[F.lit(x) for x in ("train", "test")]), (F.col("page_id") % 2 + 1).cast("int"))
    path = F.concat(F.lit("final/"), part, F.lit("/"), F.col("page_id").cast("string"), ending)
    return table(spark, sf_dir, "pages").select(path.alias("path"), F.octet_length("html").cast("long").alias("length"), F.encode("html", "UTF-8").alias("content"))


_FILES = "SELECT 'final/' || ['train', 'test'][1 + page_id % 2] || '/' || page_id || ['.parquet', '.jsonl.gz', '.json'][1 + page_id % 3] AS path, html, page_id FROM pages"


@query(f"""SELECT path, ['train', 'test'][1 + page_id % 2] AS split_name, ['parquet', 'jsonl.gz', 'json'][1 + page_id % 3] AS format, ['zstd', 'gzip', 'none'][1 + page_id % 3] AS compression,
  strlen(html)::BIGINT AS size_bytes, sha256(html) AS sha256 FROM ({_FILES})""")
def manifest_files(spark, sf_dir):
    return shards.file_manifest(_as_files(spark, sf_dir))


@query(f"SELECT path, sha256(html) AS sha256 FROM ({_FILES})")
def checksums(spark, sf_dir):
    return shards.checksums(_as_files(spark, sf_dir)).select(F.explode("checksums").alias("path", "sha256"))


_LINE = "strlen(to_json({'text': text})::VARCHAR) + 1"
_CHUNKS = f"""s AS (SELECT doc_id, {_LINE} AS n, row_number() OVER (ORDER BY doc_id) AS r FROM documents WHERE length(text) >= 20), b AS (SELECT *, sum(n) OVER (ORDER BY r) AS upto FROM s),
t AS (SELECT * FROM b WHERE upto <= 400000),
f AS (SELECT doc_id, r, n, n AS held, 0 AS chunk FROM t WHERE r = 1 UNION ALL SELECT t.doc_id, t.r, t.n, CASE WHEN held + t.n > 50000 THEN t.n ELSE held + t.n END, chunk + CASE WHEN held + t.n > 50000 THEN 1 ELSE 0 END FROM f JOIN t ON t.r = f.r + 1)"""


@query(f"WITH RECURSIVE {_CHUNKS} SELECT doc_id, n::BIGINT AS size, chunk FROM f")
def chunked_download(spark, sf_dir):
    return shards.chunked_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", 50_000, 400_000).select("doc_id", "size", "chunk")


@query(f"""WITH RECURSIVE {_CHUNKS} SELECT (SELECT count(*) FROM documents WHERE doc_id <= coalesce((SELECT min(doc_id) FROM b WHERE upto > 400000), 9e18)) AS rows_seen, count(*) AS rows_written,
  sum(n)::BIGINT AS text_bytes, (max(chunk) + 1)::INT AS chunks FROM f""")
def download_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = written(shards.chunked_lines(docs, "doc_id", "text", 50_000, 400_000).select("doc_id", "size", "chunk"), "lines")
    return shards.download_counts(docs, lines, "doc_id", "text")


@query(f"""WITH {_TOKENS}, r AS (SELECT lang, sequence, row_number() OVER (PARTITION BY lang ORDER BY md5('{SEED}:' || sequence), sequence) AS k, count(*) OVER (PARTITION BY lang) AS n FROM q),
z AS (SELECT *, least(greatest(4, floor(n * 0.02)), n) AS pool FROM r)
SELECT CASE WHEN k <= n - pool THEN 'train' WHEN k <= n - pool + pool // 2 THEN 'validation' ELSE 'test' END AS split_name, lang AS file, count(*) AS sequences FROM z GROUP BY 1, 2""")
def packed_parts(spark, sf_dir):
    """Sequences by split and file, written in three runs: the first does one file, the second ends between its two writes, the third does the rest."""
    path, parts = scratch(spark, "packed"), scratch(spark, "parts")
    rows = written(split.by_file(_sequences(spark, sf_dir).select(F.col("lang").alias("file"), "sequence"), "file", "sequence", SEED), "rows")
    sinks.packed(rows.where("file = 'en'"), path, parts)
    sinks.replace(rows.where("file > 'en'"), path, ["split_name", "file"])
    for _ in range(2):
        sinks.packed(rows, path, parts)
    found = spark.read.parquet(path).groupBy("split_name", "file").agg(F.count("*").alias("sequences"))
    return found.join(spark.read.parquet(parts).groupBy("file").agg(F.count("*").alias("n")).where("n = 1").select("file"), "file").select("split_name", "file", "sequences")


# Splits, metrics, links, streams


@query(f"""WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('{SEED}:' || doc_id), doc_id) AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents), z AS (SELECT *, greatest(1, round_even(n * 0.05, 0)) AS v FROM r)
SELECT doc_id, CASE WHEN k <= n - 2 * v THEN 'train' WHEN k <= n - v THEN 'validation' ELSE 'test' END AS split_name FROM z""")
def stratified_split(spark, sf_dir):
    return split.by_stratum(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", "lang", SEED, 0.05, 0.05).select("doc_id", "split_name")


@query("SELECT event_type, round(exp(avg(value / 100)), 6) AS perplexity, count(value) AS batches FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 200) GROUP BY event_type")
def perplexity_of_first_batches(spark, sf_dir):
    losses = table(spark, sf_dir, "events").withColumn("loss", F.col("value") / 100)
    return metrics.perplexity(losses, "loss", "event_type", order="event_id", first=200).withColumn("perplexity", F.round("perplexity", 6))


@query(f"""SELECT round(avg(round({SR}::DECIMAL(18, 12), 3)::DOUBLE), 6) AS script_ratio, round(avg(len(list_filter(regexp_extract_all({T}, '[^{S}]+'), lambda w: length(w) = 4))), 6) AS unknowns, count(*) AS samples FROM conversations""")
def sample_averages(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn("ids", F.transform(chars.words(F.col("text")), F.length))
    found = metrics.sample_averages(rows, F.col("text"), chars.LATIN_SCRIPT, F.col("ids"), 4)
    return found.withColumns({c: F.round(c, 6) for c in ("script_ratio", "unknowns")})


@query("SELECT count_if(length(p_name) > 12)::BIGINT AS special_token_split_failures FROM part")
def special_token_splits(spark, sf_dir):
    ids = F.when(F.length("p_name") > 12, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return metrics.split_failures(table(spark, sf_dir, "part").withColumn("ids", ids), "ids")


@query(rf"""WITH RECURSIVE {_EDGES}, r(seed, title, depth) AS (SELECT DISTINCT source, source, 0 FROM e WHERE starts_with(source, 'T') UNION SELECT r.seed, e.target, r.depth + 1 FROM r JOIN e ON e.source = r.title WHERE r.depth < 2)
SELECT seed, title, min(depth)::INT AS depth FROM r GROUP BY seed, title""")
def crawl_of_each_seed(spark, sf_dir):
    edges = _edges(spark, sf_dir)
    return links.crawl_seeds(edges, edges.where(F.col("source").startswith("T")).select(F.col("source").alias("title")), 2)


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS events, round(sum(value), 4) AS total FROM events
GROUP BY 1, 2 HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 2 HOUR <= (SELECT max(ts) FROM events)""")
def watermarked_event_windows(spark, sf_dir):
    """Windows of a stream that its watermark, an hour behind the latest event, has closed."""
    out = scratch(spark, "stream")
    stream = streamed(spark, sf_dir, "events")
    ingest.drain(ingest.event_windows(stream.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type", "value"), f"{out}/rows", f"{out}/state")
    return spark.read.parquet(f"{out}/rows").withColumns({"total": F.round("total", 4), "window_start": F.col("window_start").cast("timestamp_ntz")})


@query(f"{NORMALISED}, n AS (SELECT {_strip('t')} AS text FROM joined) SELECT md5(text) AS digest FROM n WHERE ({REASON}) IS NULL GROUP BY md5(text)")
def cleaned_stream(spark, sf_dir):
    """Texts of a stream, normalised, that pass the rules, each once."""
    out = scratch(spark, "stream")
    stream = streamed(spark, sf_dir, "documents")
    ingest.drain(ingest.clean_stream(stream, "text", RULES).select(digest(F.col("final_text")).alias("digest")), f"{out}/rows", f"{out}/state")
    return spark.read.parquet(f"{out}/rows")
