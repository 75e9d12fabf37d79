"""The registered queries over the driver's tables and, for each, the same in DuckDB's SQL.

The tables hold no Devanagari, so queries use the Latin script profile; Devanagari is covered by tests.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import chars, text
from ..operators import dedup, links, metrics, quality, sample, shards, split
from ..sources.shared import held, shared_root

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

RULES = quality.QualityRules(script=chars.LATIN_SCRIPT)
CLEANING = quality.CleaningRules(script=chars.LATIN_SCRIPT, max_latin=0.98)
SEED = 42


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def streamed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream: one file or a folder of files. A stream starts from folders only, unless a pattern names the file."""
    return spark.readStream.format("parquet").schema(table(spark, sf_dir, name).schema).load(f"{sf_dir}/{name}.parque[t]")


def digest(c: Column) -> Column:
    return F.md5(c.cast("binary"))


# Pieces of SQL.
S, D = chars.SPACE, chars.DIGIT
SCRIPT = chars.LATIN_SCRIPT.inside
T = "coalesce(text, '')"
N = f"length({T})"


def _n(inside: str, t: str = T) -> str:
    return f"length(regexp_replace({t}, '[^{inside}]+', '', 'g'))"


def _ratio(count: str, total: str = N) -> str:
    return f"coalesce({count} / nullif({total}, 0), 0.0)"


SR, LR, DR = _ratio(_n(SCRIPT)), _ratio(_n("A-Za-z")), _ratio(_n(D))
YR = _ratio(rf"length(regexp_replace({T}, '[\p{{L}}\p{{N}}{SCRIPT}{S}]+', '', 'g'))")
WORDS = f"len(regexp_extract_all({T}, '[^{S}]+'))"
REASON = f"""CASE WHEN {SR} < 0.6 THEN 'script_ratio' WHEN {N} < 30 THEN 'too_short' WHEN {N} > 1000000 THEN 'too_long'
  WHEN {DR} > 0.3 THEN 'digits' WHEN {YR} > 0.25 THEN 'symbols' END"""


def _strip(t: str) -> str:
    return f"regexp_replace({t}, '^[{S}]+|[{S}]+$', '', 'g')"


def _rank(key: str) -> str:
    return f"row_number() OVER (ORDER BY md5('{SEED}:' || {key}), {key})"


# Annotation and filters


@query(f"SELECT doc_id, {SR} AS script_ratio, {LR} AS latin_ratio, {DR} AS digit_ratio, {YR} AS symbol_ratio FROM documents")
def char_ratios(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", *[c.alias(n) for n, c in chars.char_ratios(F.col("text"), chars.LATIN_SCRIPT).items()])


@query(f"SELECT doc_id, coalesce({_n(SCRIPT)} / nullif(length(regexp_replace({T}, '[{S}]+', '', 'g')), 0), 0.0) AS visible_ratio FROM documents")
def visible_script_ratio(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", chars.script_ratio(F.col("text"), chars.LATIN_SCRIPT, of_visible=True).alias("visible_ratio"))


@query(f"SELECT doc_id, {N}::BIGINT AS char_count, {WORDS}::BIGINT AS word_count, greatest(1, floor({N} / 4.5))::BIGINT AS estimated_token_count FROM documents")
def word_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", *[c.alias(n) for n, c in chars.counts(F.col("text")).items()])


@query(f"SELECT doc_id, round(cast(0.7 * {SR} + 0.3 * least(1.0, {N} / 1000) AS decimal(20, 16)), 4)::DOUBLE AS quality_score FROM documents")
def quality_score(spark, sf_dir):
    return quality.annotate(table(spark, sf_dir, "documents"), "text", RULES).select("doc_id", "quality_score")


@query(f"SELECT doc_id FROM documents WHERE ({REASON}) IS NULL")
def quality_filter_pass(spark, sf_dir):
    return quality.split_passed(quality.annotate(table(spark, sf_dir, "documents"), "text", RULES))[0].select("doc_id")


@query(f"SELECT doc_id, {REASON} AS reject_reason FROM documents WHERE ({REASON}) IS NOT NULL")
def quality_reject_reason(spark, sf_dir):
    return quality.split_passed(quality.annotate(table(spark, sf_dir, "documents"), "text", RULES))[1].select("doc_id", "reject_reason")


@query(f"""SELECT source, count(*) AS records_in, count(*) FILTER (WHERE r IS NULL) AS records_out, count(*) FILTER (WHERE r IS NOT NULL) AS records_rejected,
  sum(n)::BIGINT AS char_count, round(avg(sr), 6) AS mean_script_ratio FROM (SELECT source, {REASON} AS r, {N} AS n, {SR} AS sr FROM documents) GROUP BY source""")
def source_quality_profile(spark, sf_dir):
    rows = quality.annotate(table(spark, sf_dir, "documents"), "text", RULES)
    passed = F.col("reject_reason").isNull()
    return rows.groupBy("source").agg(
        F.count("*").alias("records_in"), F.count_if(passed).alias("records_out"), F.count_if(~passed).alias("records_rejected"),
        F.sum("char_count").alias("char_count"), F.round(F.avg("script_ratio"), 6).alias("mean_script_ratio"),
    )


_RECORD = "source AS source_name, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE doc_id::VARCHAR END AS record_id, CASE WHEN lang = 'fr' THEN 'web' ELSE 'pdf' END AS source_type, n_chars - 20 AS char_count"


@query(f"""WITH r AS (SELECT doc_id, {_RECORD} FROM documents),
v AS (SELECT doc_id, list_filter([CASE WHEN record_id IS NULL THEN 'record_id' END, CASE WHEN char_count < 0 THEN 'char_count' END, CASE WHEN source_type = 'web' THEN 'source_type' END], lambda x: x IS NOT NULL) AS violations FROM r)
SELECT doc_id, array_to_string(violations, ',') AS violations FROM v WHERE len(violations) > 0""")
def schema_violations(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").selectExpr("doc_id", *[x.replace("::VARCHAR", "").replace("ELSE doc_id END", "ELSE CAST(doc_id AS STRING) END") for x in _RECORD.split(", ")])
    return quality.violations(rows).select("doc_id", F.array_join("violations", ",").alias("violations"))


# Text


@query(f"SELECT page_id, md5(regexp_replace(html, '(?i)https?://[^{S}]+|www\\.[^{S}]+', ' ', 'g')) AS digest FROM pages")
def url_removal(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", digest(text.remove_urls(F.col("html"))).alias("digest"))


@query(rf"""SELECT page_id, md5(regexp_replace(regexp_replace(translate(html, '{text.DECORATIVE}', ''), '[ \t]+', ' ', 'g'), '\n{{3,}}', E'\n\n', 'g')) AS digest FROM pages""")
def whitespace_collapse(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", digest(text.collapse_space(text.remove_decorative(F.col("html")))).alias("digest"))


@query(f"SELECT doc_id, md5(nfc_normalize({T})) AS digest FROM documents")
def nfc_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", digest(text.nfc(F.coalesce("text", F.lit("")))).alias("digest"))


_CLEAN = rf"regexp_replace(regexp_replace(translate(regexp_replace(nfc_normalize({T}), '(?i)https?://[^{S}]+|www\.[^{S}]+', ' ', 'g'), '{text.DECORATIVE}', ''), '[ \t]+', ' ', 'g'), '\n{{3,}}', E'\n\n', 'g')"


def _lines(t: str) -> str:
    return rf"string_split(regexp_replace({t}, '\r\n|[\x0b\f\r\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]', E'\n', 'g'), E'\n')"


NORMALISED = f"""WITH l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM (SELECT row_number() OVER () AS r, doc_id, {_lines(_CLEAN)} AS ls FROM documents)),
g AS (SELECT *, pos - row_number() OVER (PARTITION BY r, line ORDER BY pos) AS island FROM l),
c AS (SELECT *, count(*) OVER (PARTITION BY r, line, island) AS n, row_number() OVER (PARTITION BY r, line, island ORDER BY pos) AS k FROM g),
kept AS (SELECT * FROM c WHERE n < 3 OR k = 1 OR NOT regexp_matches(line, '[^{S}]')),
joined AS (SELECT r, doc_id, string_agg(regexp_replace(line, '[{S}]+$', ''), E'\\n' ORDER BY pos) AS t FROM kept GROUP BY r, doc_id)"""


@query(f"{NORMALISED} SELECT doc_id, md5({_strip('t')}) AS digest, length({_strip('t')})::BIGINT AS char_count FROM joined")
def normalised_text(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", text.normalise(F.coalesce("text", F.lit(""))).alias("t"))
    return rows.select("doc_id", digest(F.col("t")).alias("digest"), F.length("t").cast("long").alias("char_count"))


@query(f"""
WITH l AS (SELECT r, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM (SELECT row_number() OVER () AS r, {_lines(T)} AS ls FROM documents)),
s AS (SELECT r, pos, {_strip("line")} AS line FROM l), w AS (SELECT r, line, lag(line) OVER o AS a, lag(line, 2) OVER o AS b FROM s WHERE line <> '' WINDOW o AS (PARTITION BY r ORDER BY pos)),
f AS (SELECT r, bool_or(coalesce(line = a AND line = b, false)) AS x FROM w GROUP BY r)
SELECT doc_id, coalesce(x, false) AS repeated FROM (SELECT row_number() OVER () AS r, doc_id FROM documents) LEFT JOIN f USING (r)""")
def repeated_line_flag(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.has_repeated_lines(F.coalesce("text", F.lit(""))).alias("repeated"))


_CUT = "CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN substr(text, 1, length(text) // 3) WHEN 2 THEN text || text ELSE text END"


@query(f"""
WITH c AS (SELECT doc_id, text AS raw, {_CUT} AS text FROM documents),
l AS (SELECT r, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM (SELECT doc_id AS r, {_lines(T)} AS ls FROM c)),
w AS (SELECT r, line, lag(line) OVER o AS a, lag(line, 2) OVER o AS b FROM (SELECT r, pos, {_strip("line")} AS line FROM l) WHERE line <> '' WINDOW o AS (PARTITION BY r ORDER BY pos)),
f AS (SELECT r, bool_or(coalesce(line = a AND line = b, false)) AS x FROM w GROUP BY r)
SELECT doc_id, CASE WHEN {_strip(T)} = '' THEN 'empty_output' WHEN {N} < 30 THEN 'output_too_short' WHEN {N} / length(raw) < 0.5 THEN 'output_compressed'
  WHEN {N} / length(raw) > 1.2 THEN 'output_expanded' WHEN {SR} < 0.6 THEN 'script_ratio_low' WHEN contains(lower(text), 'cleaned hindi text:') THEN 'prompt_echo_detected'
  WHEN x THEN 'repeated_lines' WHEN {_n(chr(92) + "p{L}")} > 0 AND {_n("A-Za-z")} >= 0.98 * {_n(chr(92) + "p{L}")} THEN 'output_is_english' END AS rejection_reason
FROM c LEFT JOIN f ON f.r = doc_id""")
def cleaning_validator_reason(spark, sf_dir):
    t, part = F.col("text"), F.col("doc_id") % 5
    cut = F.when(part == 0, "").when(part == 1, F.substring(t, F.lit(1), F.floor(F.length(t) / 3).cast("int"))).when(part == 2, F.concat(t, t)).otherwise(t)
    return quality.validate(table(spark, sf_dir, "documents").withColumn("cleaned", cut), "text", "cleaned", CLEANING).select("doc_id", "rejection_reason")


@query("SELECT page_id, md5(CASE WHEN page_id % 3 = 0 THEN url WHEN trim(html) <> '' THEN html ELSE url END) AS digest FROM pages")
def text_column_coalesce(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumn("first", F.when(F.col("page_id") % 3 == 0, F.col("url")).otherwise(F.lit("  ")))
    return pages.select("page_id", digest(text.first_text(F.col("first"), F.col("html"), F.col("url"))).alias("digest"))


@query(r"""SELECT page_id, replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(url, '^[a-z]+://[^/]*', ''), '[?#].*$', ''), '^/+', ''), '+', '+'), '_', ' '), '%20', ' ') AS title FROM pages""")
def page_titles(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.page_title(F.col("url")).alias("title"))


_CONVERSATION = "(SELECT conv_id, string_agg(text, E'\\n\\n' ORDER BY turn, role, text) AS t FROM conversations GROUP BY conv_id)"


def _conversations(spark, sf_dir):
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return table(spark, sf_dir, "conversations").where("text IS NOT NULL").groupBy("conv_id").agg(F.array_join(turns["text"], "\n\n").alias("t"))


@query(f"""WITH p AS (SELECT conv_id, list_filter(list_transform(string_split(t, E'\\n\\n'), lambda x: {_strip("x")}), lambda x: length(x) >= 50) AS ps FROM {_CONVERSATION})
SELECT conv_id, 'p' || lpad((generate_subscripts(ps, 1) - 1)::VARCHAR, 4, '0') AS paragraph_id, md5(unnest(ps)) AS digest FROM p""")
def paragraph_explode(spark, sf_dir):
    rows = _conversations(spark, sf_dir).select("conv_id", F.posexplode(text.paragraphs(F.col("t"))).alias("n", "p"))
    return rows.select("conv_id", F.format_string("p%04d", "n").alias("paragraph_id"), digest(F.col("p")).alias("digest"))


@query(f"""SELECT doc_id, i::INT AS chunk, md5(substr(text, i * 1800 + 1, 2000)) AS digest
FROM documents, range(40000) q(i) WHERE i < CASE WHEN {N} <= 2000 THEN 1 ELSE ceil(({N} - 2000) / 1800) + 1 END""")
def fixed_chunks(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.chunks(F.coalesce("text", F.lit("")), 2000, 200)).alias("chunk", "t"))
    return rows.select("doc_id", "chunk", digest(F.col("t")).alias("digest"))


@query(f"SELECT conv_id, md5({_strip('t')}) AS digest FROM {_CONVERSATION}")
def chunk_merge(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").where("text IS NOT NULL")
    merged = rows.groupBy("conv_id").agg(text.merge_chunks(F.struct("turn", "role"), F.col("text")).alias("t"))
    return merged.select("conv_id", digest(F.col("t")).alias("digest"))


# Duplicates


@query(f"SELECT doc_id, sha256({T}) AS dedup_hash FROM documents QUALIFY row_number() OVER (PARTITION BY sha256({T}) ORDER BY doc_id) = 1")
def exact_dedup(spark, sf_dir):
    return dedup.exact(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "doc_id").select("doc_id", "dedup_hash")


@query(f"SELECT doc_id FROM documents WHERE lang <> 'en' AND sha256({T}) NOT IN (SELECT sha256({T}) FROM documents WHERE lang = 'en')")
def unseen_texts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", dedup.dedup_hash(F.col("text")).alias("dedup_hash"))
    return dedup.unseen(docs.where("lang <> 'en'"), docs.where("lang = 'en'")).select("doc_id")


_SHINGLES = f"""w AS (SELECT doc_id, regexp_extract_all({T}, '[^{S}]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) >= 3 THEN list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) ELSE [array_to_string(ws, ' ')] END AS sh FROM w)"""


@query(f"WITH {_SHINGLES} SELECT doc_id, len(sh)::INT AS n_shingles FROM s")
def shingles(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(dedup.shingles(F.col("text"))).alias("n_shingles"))


_P = dedup.PRIME
def _canonical(bands: int, rows: int) -> str:
    return f"""WITH {_SHINGLES},
h AS (SELECT doc_id, list_transform(sh, lambda x: ('0x' || substr(md5(x), 1, 8))::BIGINT % {_P}) AS hs FROM s),
p AS (SELECT i, (i * 1103515245 + 12345) % {_P - 1} + 1 AS a, (i * 69069 + 1) % {_P} AS b FROM range({bands * rows}) r(i)),
m AS (SELECT doc_id, i, list_min(list_transform(hs, lambda x: (a * x + b) % {_P})) AS v FROM h, p),
k AS (SELECT doc_id, (i // {rows}) || ':' || md5(string_agg(v::VARCHAR, ',' ORDER BY i)) AS band FROM m GROUP BY doc_id, i // {rows}),
l AS (SELECT band, min(doc_id::VARCHAR) AS least FROM k GROUP BY band),
c AS (SELECT doc_id, min(least) AS canonical_id FROM k JOIN l USING (band) GROUP BY doc_id)"""


_CANONICAL = _canonical(8, 16)


@query(_CANONICAL + " SELECT doc_id, canonical_id FROM c QUALIFY row_number() OVER (PARTITION BY canonical_id ORDER BY doc_id) = 1")
def lsh_near_dedup(spark, sf_dir):
    return dedup.near(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", "doc_id").select("doc_id", "canonical_id")


@query(_canonical(9, 13) + " SELECT doc_id, canonical_id FROM c QUALIFY row_number() OVER (PARTITION BY canonical_id ORDER BY doc_id) = 1")
def lsh_near_dedup_080(spark, sf_dir):
    """With bands and rows chosen for a similarity of 0.8."""
    return dedup.near(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", "doc_id", threshold=0.8).select("doc_id", "canonical_id")


@query(f"""{_CANONICAL.replace("FROM documents)", f"FROM (SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY sha256({T}) ORDER BY doc_id) = 1))", 1)}
SELECT doc_id, canonical_id FROM c QUALIFY row_number() OVER (PARTITION BY canonical_id ORDER BY doc_id) = 1""")
def full_dedup(spark, sf_dir):
    return dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", "doc_id").select("doc_id", "canonical_id")


@query("SELECT source, min(doc_id) AS doc_id FROM documents GROUP BY source")
def first_of_source(spark, sf_dir):
    return dedup.keep_first(table(spark, sf_dir, "documents").select("source", "doc_id"), ["source"], ["doc_id"])


# Splits, samples, shards, sequences


@query(f"""WITH r AS (SELECT doc_id, {_rank("doc_id")} AS k, count(*) OVER () AS n FROM (SELECT DISTINCT doc_id FROM documents)), z AS (SELECT *, greatest(1, round_even(n * 0.05, 0)) AS v FROM r)
SELECT doc_id, CASE WHEN k <= n - 2 * v THEN 'train' WHEN k <= n - v THEN 'validation' ELSE 'test' END AS split_name FROM z""")
def doc_split(spark, sf_dir):
    return split.by_document(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SEED, 0.05, 0.05)


_CONV_SPLIT = f"""r AS (SELECT conv_id, {_rank("conv_id")} AS k, count(*) OVER () AS n FROM (SELECT DISTINCT conv_id FROM conversations)), z AS (SELECT *, greatest(1, round_even(n * 0.05, 0)) AS v FROM r),
named AS (SELECT conv_id, CASE WHEN k <= n - 2 * v THEN 'train' WHEN k <= n - v THEN 'validation' ELSE 'test' END AS split_name FROM z)"""


@query(f"WITH {_CONV_SPLIT} SELECT conv_id, turn, split_name FROM conversations JOIN named USING (conv_id)")
def conversation_doc_split(spark, sf_dir):
    return split.by_document(table(spark, sf_dir, "conversations").select("conv_id", "turn"), "conv_id", SEED, 0.05, 0.05)


@query(f"""WITH {_CONV_SPLIT} SELECT s.split_name, count(c.conv_id) AS records, coalesce(sum({N}), 0)::BIGINT AS char_count, coalesce(sum({WORDS}), 0)::BIGINT AS word_count,
  coalesce(sum(greatest(1, floor({N} / 4.5))), 0)::BIGINT AS estimated_token_count
FROM (VALUES ('train'), ('validation'), ('test')) s(split_name) LEFT JOIN (SELECT * FROM conversations JOIN named USING (conv_id)) c USING (split_name) GROUP BY s.split_name""")
def split_profile(spark, sf_dir):
    rows = split.by_document(table(spark, sf_dir, "conversations").select("conv_id", "text"), "conv_id", SEED, 0.05, 0.05)
    return metrics.profile(rows.withColumns(chars.counts(F.col("text"))), spark)


def _budget_sql(condition: str) -> str:
    return f"""WITH b AS (SELECT doc_id, strlen({T}) + 1 AS n, sum(strlen({T}) + 1) OVER (ORDER BY md5('{SEED}:' || doc_id), doc_id) AS upto FROM documents)
SELECT doc_id FROM b WHERE {condition}"""


@query(_budget_sql("upto - n < 500000"))
def sample_budget_overshoot(spark, sf_dir):
    return sample.budget(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", 500_000, SEED).select("doc_id")


@query(_budget_sql("upto <= 500000"))
def prefix_budget_strict(spark, sf_dir):
    return sample.budget(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", 500_000, SEED, overshoot=False).select("doc_id")


@query(f"""WITH RECURSIVE d AS (SELECT lang, doc_id, strlen({T}) AS n, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS k FROM documents),
f AS (SELECT lang, doc_id, k, n AS held, 0 AS shard FROM d WHERE k = 1 UNION ALL
  SELECT d.lang, d.doc_id, d.k, CASE WHEN f.held > 0 AND f.held + d.n > 100000 THEN d.n ELSE f.held + d.n END, f.shard + CASE WHEN f.held > 0 AND f.held + d.n > 100000 THEN 1 ELSE 0 END
  FROM f JOIN d ON d.lang = f.lang AND d.k = f.k + 1)
SELECT lang, doc_id, shard FROM f""")
def next_fit_shards(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("lang", "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).alias("size"))
    return shards.next_fit(docs, "lang", "doc_id", "size", 100_000, blocks=64)


_TOKENS = f"""k AS (SELECT lang, doc_id, list_concat(list_transform(regexp_extract_all({T}, '[^{S}]+'), lambda x: ('0x' || substr(md5(x), 1, 4))::INT), [0]) AS ids FROM documents),
u AS (SELECT lang, doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS j FROM k), o AS (SELECT lang, id, row_number() OVER (PARTITION BY lang ORDER BY doc_id, j) - 1 AS p FROM u),
q AS (SELECT lang, p // 512 AS sequence, list(id ORDER BY p) AS input_ids FROM o GROUP BY lang, p // 512 HAVING count(*) = 512)"""


def _word_ids(docs: DataFrame) -> DataFrame:
    return docs.select("lang", "doc_id", text.word_ids(F.col("text")).alias("ids"))


def _sequences(spark, sf_dir):
    return shards.windows(_word_ids(table(spark, sf_dir, "documents")), "lang", "doc_id", "ids", 512)


def _ids_digest() -> Column:
    return digest(F.btrim(F.to_json("input_ids"), F.lit("[]"))).alias("digest")  # joined by commas: no string per id


@query(f"WITH {_TOKENS} SELECT lang, sequence, md5(array_to_string(input_ids, ',')) AS digest FROM q")
def pack_sequences(spark, sf_dir):
    return _sequences(spark, sf_dir).select("lang", "sequence", _ids_digest())


@query(f"""WITH {_TOKENS}, j AS (SELECT lang, sequence // 2 AS sequence, flatten(list(input_ids ORDER BY sequence)) AS input_ids FROM q GROUP BY lang, sequence // 2 HAVING count(*) = 2)
SELECT lang, sequence, md5(array_to_string(input_ids, ',')) AS digest FROM j""")
def double_pack(spark, sf_dir):
    return shards.joined_windows(_sequences(spark, sf_dir), "lang", 2).select("lang", "sequence", _ids_digest())


@query(f"""WITH {_TOKENS}, r AS (SELECT lang, sequence, row_number() OVER (PARTITION BY lang ORDER BY md5('{SEED}:' || sequence), sequence) AS k, count(*) OVER (PARTITION BY lang) AS n FROM q),
z AS (SELECT *, least(greatest(4, floor(n * 0.02)), n) AS pool FROM r)
SELECT lang, sequence, CASE WHEN k <= n - pool THEN 'train' WHEN k <= n - pool + pool // 2 THEN 'validation' ELSE 'test' END AS split_name FROM z""")
def packed_split(spark, sf_dir):
    return split.by_file(_sequences(spark, sf_dir).select("lang", "sequence"), "lang", "sequence", SEED)


@query("SELECT (row_number() OVER (ORDER BY conv_id, turn) - 1) // 8 AS batch, conv_id, turn FROM conversations QUALIFY row_number() OVER (ORDER BY conv_id, turn) <= (SELECT count(*) // 8 * 8 FROM conversations)")
def full_batches(spark, sf_dir):
    rows = shards.full_batches(table(spark, sf_dir, "conversations").select("conv_id", "turn"), "conv_id", ["turn"], 8)
    return rows.select("batch", "conv_id", "turn")


@query(f"""SELECT source, doc_id, 'bypass' AS path FROM documents WHERE lang = 'en' UNION ALL SELECT source, doc_id, 'filtered' AS path FROM documents WHERE lang <> 'en' AND ({REASON}) IS NULL""")
def source_union_bypass(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    passed = quality.split_passed(quality.annotate(docs.where("lang <> 'en'"), "text", RULES))[0]
    return docs.where("lang = 'en'").select("source", "doc_id", F.lit("bypass").alias("path")).unionByName(passed.select("source", "doc_id", F.lit("filtered").alias("path")))


# Metrics


@query(f"WITH c AS (SELECT unnest(list_distinct(string_split(regexp_replace({T}, '[^{SCRIPT}]+', '', 'g'), ''))) AS ch FROM documents) SELECT ch AS char, count(*) AS texts FROM c WHERE ch <> '' GROUP BY ch")
def distinct_chars(spark, sf_dir):
    return metrics.distinct_chars(table(spark, sf_dir, "documents"), "text", chars.LATIN_SCRIPT)


@query(f"WITH c AS (SELECT DISTINCT unnest(string_split(regexp_replace({T}, '[^{SCRIPT}]+', '', 'g'), '')) AS ch FROM documents) SELECT avg((ord(ch) < 128)::INT::DOUBLE) AS char_coverage, count(*) AS distinct_chars FROM c WHERE ch <> ''")
def char_coverage(spark, sf_dir):
    return metrics.coverage(metrics.distinct_chars(table(spark, sf_dir, "documents"), "text", chars.LATIN_SCRIPT), F.ascii("char") < 128)


@query(f"""WITH k AS (SELECT {T} AS t, list_transform(regexp_extract_all({T}, '[^{S}]+'), lambda x: ('0x' || substr(md5(x), 1, 2))::INT) AS ids, array_to_string(regexp_extract_all({T}, '[^{S}]+'), ' ') AS back FROM documents)
SELECT sum(len(list_filter(ids, lambda i: i = 0))) / sum(len(ids)) AS unk_rate, sum(length(t)) / sum(len(ids)) AS chars_per_token, sum(len(ids)) / sum(len(ids)) AS tokens_per_word,
  avg((back = t)::INT::DOUBLE) AS roundtrip_success_rate FROM k""")
def token_metrics(spark, sf_dir):
    words = chars.words(F.col("text"))
    docs = held(table(spark, sf_dir, "documents").select(F.coalesce("text", F.lit("")).alias("text")), "w", words)
    ids = F.transform("w", lambda x: F.conv(F.substring(digest(x), 1, 2), 16, 10).cast("int"))
    return metrics.token_metrics(held(docs, "ids", ids), F.col("text"), F.col("ids"), 0, F.array_join("w", " "))


@query("SELECT event_type, round(exp(avg(value / 100)), 6) AS perplexity, count(value) AS batches FROM events GROUP BY event_type")
def perplexity(spark, sf_dir):
    rows = metrics.perplexity(table(spark, sf_dir, "events").withColumn("loss", F.col("value") / 100), "loss", "event_type")
    return rows.withColumn("perplexity", F.round("perplexity", 6))


@query("SELECT (event_id // 100)::BIGINT AS window, max(event_id + 1) AS last_step, round(avg(value), 6) AS mean_loss, round(sum(user_id) / sum(value), 6) AS tokens_per_second FROM events GROUP BY event_id // 100")
def log_window_avg(spark, sf_dir):
    steps = table(spark, sf_dir, "events").withColumn("step", F.col("event_id") + 1)
    rows = metrics.log_windows(steps, "step", "value", "user_id", "value", 100)
    return rows.withColumns({c: F.round(c, 6) for c in ("mean_loss", "tokens_per_second")})


@query("SELECT 'step_' || user_id AS name, value AS loss FROM events QUALIFY row_number() OVER (ORDER BY value, 'step_' || user_id) = 1")
def best_checkpoint(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit("step_"), "user_id").alias("name"), F.col("value").alias("loss"))
    return metrics.best(rows, "name", "loss")


@query("SELECT 'step_' || max(user_id) AS path, max(user_id) AS step FROM events")
def latest_checkpoint(spark, sf_dir):
    return metrics.latest(table(spark, sf_dir, "events").select(F.concat(F.lit("step_"), "user_id").alias("path")), "path")


@query("""WITH p AS (SELECT l_orderkey, l_linenumber, (l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey))::DECIMAL(18, 9) AS p FROM lineitem),
c AS (SELECT l_orderkey, l_linenumber, coalesce(sum(p) OVER (PARTITION BY l_orderkey ORDER BY p DESC, l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM p)
SELECT l_orderkey, l_linenumber FROM c WHERE before <= 0.8""")
def nucleus_cut(spark, sf_dir):
    share = (F.col("l_quantity") / F.sum("l_quantity").over(Window.partitionBy("l_orderkey"))).cast("decimal(18,9)")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", share.alias("p"))
    return metrics.nucleus(rows, "l_orderkey", "l_linenumber", "p", 0.8).select("l_orderkey", "l_linenumber")


@query("""WITH t AS (SELECT p_partkey, 64 * p_size::BIGINT AS h, 1 + p_partkey % 24 AS l, p_size::BIGINT AS a, 1 + p_size::BIGINT % 4 AS kv, 64 AS d, 172 * p_size::BIGINT AS f, 512 AS c, 32000 AS v FROM part),
p AS (SELECT *, v * h + l * (2 * h * h + 2 * h * kv * d + 3 * h * f + 2 * h) + h AS n FROM t)
SELECT p_partkey, n::BIGINT AS parameters, round((n * 12 / 1e9 + l * 2 * c * (h * 4 + a * c * 4 + f * 4) / 1e9)::DECIMAL(20, 12), 3)::DOUBLE AS training_gb, round((2 * l * c * kv * d * 2 / 1e9)::DECIMAL(20, 12), 4)::DOUBLE AS kv_cache_gb,
  n * 4.5 / 8 / 1e9 + 2 * l * c * kv * d * 2 / 1e9 < 6 AS fits FROM p""")
def model_arithmetic(spark, sf_dir):
    """Sizes of models whose shapes are made of the parts' sizes and keys."""
    size, key = F.col("p_size").cast("long"), F.col("p_partkey")
    shape = {"hidden": 64 * size, "layers": 1 + key % 24, "heads": size, "kv_heads": 1 + size % 4, "head_dim": F.lit(64), "ffn": 172 * size, "context": F.lit(512), "vocab": F.lit(32_000)}
    rows = table(spark, sf_dir, "part").select("p_partkey", *[c.cast("long").alias(n) for n, c in shape.items()])
    return rows.select(
        "p_partkey", metrics.parameters().alias("parameters"), F.round(metrics.training_gb(), 3).alias("training_gb"), F.round(metrics.kv_cache_gb(), 4).alias("kv_cache_gb"), metrics.fits().alias("fits")
    )


@query("""SELECT i AS step, round(CASE WHEN i < 100 THEN 0.0003 * i / 100 ELSE 0.0003 * 0.5 * (1 + cos(pi() * (i - 100) / 900)) END, 12) AS rate FROM (SELECT event_id AS i FROM events)""")
def learning_rate(spark, sf_dir):
    step = F.col("event_id")
    return table(spark, sf_dir, "events").select(step.alias("step"), F.round(metrics.cosine_rate(step, 100, 1000, 3e-4), 12).alias("rate"))


@query("SELECT s_suppkey, CASE WHEN g <= 0 THEN 'CPU_ONLY' WHEN g < 4 THEN 'MICRO' WHEN g < 10 THEN 'SMALL' WHEN g < 20 THEN 'MEDIUM' ELSE 'LARGE' END AS tier, CASE WHEN g < 50 THEN 'excellent' WHEN g < 100 THEN 'good' WHEN g < 200 THEN 'fair' ELSE 'poor' END AS band FROM (SELECT s_suppkey, s_acctbal / 400 AS g FROM supplier)")
def tiers_and_bands(spark, sf_dir):
    g = F.col("s_acctbal") / 400
    return table(spark, sf_dir, "supplier").select("s_suppkey", metrics.tier_of(g).alias("tier"), metrics.score_band(g).alias("band"))


# Links, files, streams

_EDGES = r"""e AS (SELECT DISTINCT regexp_extract(html, '<h1>([^ <]+)', 1) AS source, unnest(regexp_extract_all(html, '<a href="/([^"#]+)"', 1)) AS target FROM pages)"""


def _edges(spark, sf_dir):
    return links.page_links(table(spark, sf_dir, "pages"), F.regexp_extract("html", "<h1>([^ <]+)", 1), F.col("html"))


@query(rf"""WITH RECURSIVE {_EDGES}, r(title, depth) AS (SELECT DISTINCT source, 0 FROM e WHERE starts_with(source, 'T') UNION SELECT e.target, r.depth + 1 FROM r JOIN e ON e.source = r.title WHERE r.depth < 3)
SELECT title, min(depth)::INT AS depth FROM r GROUP BY title""")
def link_bfs(spark, sf_dir):
    edges = _edges(spark, sf_dir)
    return links.crawl(edges, edges.where(F.col("source").startswith("T")).select(F.col("source").alias("title")), 3)


@query(f"WITH {_EDGES} SELECT substr(title, 1, 1) AS prefix, md5(array_to_string(list_sort(list(DISTINCT title)), '|')) AS titles, count(DISTINCT title) AS pages FROM (SELECT source AS title FROM e UNION ALL SELECT target FROM e) GROUP BY 1")
def crawl_index(spark, sf_dir):
    edges = _edges(spark, sf_dir)
    index = links.crawl_index(edges.select(F.col("source").alias("title")).union(edges.select("target")))
    return index.select("prefix", digest(F.array_join("titles", "|")).alias("titles"), "pages")


@query(f"WITH {_EDGES} SELECT DISTINCT target AS title FROM e WHERE NOT starts_with(target, 'Th') AND NOT regexp_matches(target, '[,.]$') AND regexp_matches(target, '^[A-Za-z]') AND NOT regexp_matches(target, 'ing')")
def link_filter(spark, sf_dir):
    titles = _edges(spark, sf_dir).select(F.col("target").alias("title")).distinct()
    return titles.where(~F.col("title").startswith("Th") & quality.filter_links(F.col("title"), ["Talk", "File"], r"[,.]$", "^[A-Za-z]", "ing"))


@query("""SELECT p AS path, coalesce(nullif(regexp_extract(p, '(?:^|/)(train|validation|test)/', 1), ''), 'unknown') AS split_name,
  CASE WHEN ends_with(p, '.parquet') THEN 'parquet' WHEN ends_with(p, '.jsonl.gz') THEN 'jsonl.gz' WHEN ends_with(p, '.txt.gz') THEN 'txt.gz' ELSE 'json' END AS format,
  CASE WHEN ends_with(p, '.parquet') THEN 'zstd' WHEN ends_with(p, '.gz') THEN 'gzip' ELSE 'none' END AS compression
FROM (SELECT 'final/' || ['train', 'validation', 'test', 'notes'][1 + n_nationkey % 4] || '/' || n_name || ['.parquet', '.jsonl.gz', '.txt.gz', '.json'][1 + n_nationkey % 3 + n_nationkey % 2] AS p FROM nation)""")
def path_facts(spark, sf_dir):
    k = F.col("n_nationkey")
    pick = lambda values, i: F.element_at(F.array(*[F.lit(v) for v in values]), (i + 1).cast("int"))
    path = F.concat(F.lit("final/"), pick(["train", "validation", "test", "notes"], k % 4), F.lit("/"), "n_name", pick([".parquet", ".jsonl.gz", ".txt.gz", ".json"], k % 3 + k % 2))
    rows = table(spark, sf_dir, "nation").select(path.alias("path"))
    return rows.select("path", *[c.alias(n) for n, c in text.path_facts(F.col("path")).items()])


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def streaming_event_windows(spark, sf_dir):
    """The same windows from a stream over the event file, drained to a Parquet sink."""
    out = f"{shared_root(spark)}/quern/stream-{uuid.uuid4().hex}"
    stream = streamed(spark, sf_dir, "events")
    windows = stream.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("total"))
    rows = windows.select(F.col("window.start").alias("window_start"), "event_type", "events", F.round("total", 4).alias("total"))

    def keep(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows")

    rows.writeStream.outputMode("complete").option("checkpointLocation", f"{out}/state").foreachBatch(keep).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/rows")
