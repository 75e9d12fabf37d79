"""Documents may have columns of any types."""

from pyspark.sql import functions as F

import corpus_pipeline


def test_repeated_rows_with_maps(spark):
    text = "one two three four five six seven eight nine ten " * 3
    df = spark.createDataFrame([(1, text), (1, text), (2, text), (3, "another text that is not like it at all in any way")], "doc_id long, text string")
    df = df.withColumns({"m": F.create_map(F.lit("k"), F.col("doc_id")), "l": F.array("doc_id"), "s": F.struct(F.create_map(F.lit(1), F.lit("x")).alias("n"))})
    got = corpus_pipeline.one_of_each(spark, df, "").collect()
    assert sorted((r["doc_id"], r["m"]["k"], r["s"]["n"][1]) for r in got) == [(1, 1, "x"), (3, 3, "x")]
