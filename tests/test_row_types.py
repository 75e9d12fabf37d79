"""Rows with maps, arrays and structs are chosen as others."""

from pyspark.sql import functions as F

from quern.operators import dedup


def typed(spark):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (None, "b"), (4, "b")]
    df = spark.createDataFrame(rows, "id long, text string")
    return df.withColumns({"m": F.create_map(F.lit("k"), F.col("id")), "l": F.array("id"), "s": F.struct("id", F.create_map(F.lit(1), F.lit("x")).alias("n")), "n": F.lit(None).cast("map<string,int>")})


def test_exact_keeps_every_column(spark):
    got = {r["text"]: r for r in dedup.exact(typed(spark), "text", "id").collect()}
    assert {k: v["id"] for k, v in got.items()} == {"a": 1, None: 3, "b": 4} and got["a"]["m"] == {"k": 1} and got["b"]["s"]["n"] == {1: "x"} and got["a"]["n"] is None
    assert dedup.near(typed(spark), "id", "text", "id").count() == 3
