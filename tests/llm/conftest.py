import pytest

#: Nulls, empty and very long texts, repeated rows, a repeated id, and columns named like those the operators make.
LONG = "word " * 40_000 + "end"
ROWS = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "x y z"), (4, LONG), (5, LONG), (6, " \n\t "), (7, "▁ é 日本 \x00 ﬁ"), (8, "nosp" * 30_000), (9, "one  two   three "), (10, "<|endoftext|> <s>")]
CLASHING = ["shard", "slot", "kept", "score", "ids", "digest", "keys", "bucket", "salt", "rank", "length", "id", "text_", "tail", "comp", "_pii", "_scored", "_hash", "query", "media", "loaded"]


def wide(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="session")
def edge(spark):
    return wide(spark, ROWS).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return wide(spark, [])


@pytest.fixture(scope="session")
def small(spark):
    """The documents of the smallest tables, as pandas."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").toPandas()


def path(name):
    import public_tokenizers

    return public_tokenizers.path(name)
