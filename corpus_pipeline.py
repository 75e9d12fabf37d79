"""From raw documents to packed training sequences: quality, near-duplicates, private values, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return the columns of documents. `run` writes each stage as Parquet below the shared folder and rereads it; only the last output stays there.

Null and empty texts, null and repeated ids, repeated rows, texts of any length and empty tables pass through
every stage; columns of documents with any other names are kept as they are, of any types (maps, too), whatever the operators call theirs.

SQL can express neither the fitted classifier nor the tokens, so there is no SQL for the whole
(tests compare the stages with brute-force versions).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import near_duplicates, packing, pii, queries
from quern.llm import quality as quality_op
from quern.llm.shared import delete, fresh, scratch, ship, tidied, written
from quern.operators.dedup import row_hash

#: Keys of removed rows that may be broadcast (25 bytes each); beyond that the join is shuffled.
BROADCAST_IDS = 1_000_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rates as probably good; junk and toxic ones go."""
    ship(spark)
    model = queries.quality_model(spark, docs, sf_dir)
    (rated,) = fresh(docs, "rated")
    return quality_op.scored(docs, "text", model, queries.GRADES, queries.MIN_GRADE, queries.MIN_TAIL, rated).where(F.col(rated)["kept"]).select(*docs.columns)


def _row_key() -> Column:
    """What tells rows apart, in the order of ids (nulls last): null or not, id and the text's MD5, 25 bytes."""
    i = F.col("doc_id").cast("long").bitwiseXOR(F.lit(-(1 << 63)))  # the sign first, so that bytes sort as numbers
    ordered = F.coalesce(F.concat(F.lit("00"), F.lpad(F.hex(i), 16, "0")), F.lit("01" + "0" * 16))
    return F.unhex(F.concat(ordered, F.md5(F.coalesce("text", F.lit("")).cast("binary"))))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row (of the least id; null ids come last) of each group of near-duplicates, whatever other rows have its id.

    Rows without shingles are in no group and all stay.
    """
    ship(spark)
    (key,) = fresh(docs, "row_key")
    keyed = docs.withColumn(key, _row_key())
    found = near_duplicates.near_duplicates(keyed.select(key, "text"), key, "text", threshold=(85, 100), words=5)
    rows = found.groupBy(key).agg(F.bool_and("kept").alias("kept"), F.max("n_shingles").alias("n"), F.count("*").alias("rows"))
    touched = written(rows.where(~F.col("kept") | ((F.col("n") > 0) & (F.col("rows") > 1))).select(key, "kept"), "touched")
    n = touched.count()
    small = lambda t: F.broadcast(t) if n <= BROADCAST_IDS else t
    out = keyed.join(small(touched.select(key)), key, "left_anti").select(*docs.columns)
    again = touched.where("kept").select(key)
    if again.isEmpty():
        return out
    one = keyed.join(small(again), key, "left_semi").groupBy(key).agg(F.min_by(F.struct(*docs.columns), row_hash(docs)).alias("one"))
    return out.unionByName(one.select("one.*"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for private values; n_chars follows the text."""
    (kinds,) = fresh(docs, "kinds")
    mapped = pii.pseudonymise(docs, "text", pii.session_key(spark), kinds)
    return mapped.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens, with their ids."""
    ship(spark)
    return packing.pack(docs, "doc_id", "text", queries._vocabulary("byte_bpe_50k.json"), end_id=2, limit=1024)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("near_duplicates", one_of_each),
    ("pseudonyms", private),
    ("best_fit_packing", sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. A stage's own tables and its predecessor's go when its output is written."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch(spark, name)
        with tidied(spark):
            done = stage(spark, docs, sf_dir)
            done.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
        if last:
            delete(spark, last)
        last = path
    return docs
