"""Pages and paragraphs one by one."""

import random

from pyspark.sql import functions as F

from quern.functions import text
from quern.sources import page_tables


def by_line(content):
    for page in content.decode().split("|"):
        if page == "bad":
            raise ValueError("bad page")
        yield page


def whole(content):
    if b"worse" in content:
        raise ValueError("worse")
    return [content.decode()]


ENGINES = [("lines", by_line), ("whole", whole)]


def test_extraction(spark):
    files = spark.createDataFrame([("a", bytearray(b"x|y|z")), ("b", bytearray(b"x|bad")), ("c", bytearray(b"worse|bad")), ("d", None)], "document_id string, content binary")
    want = [("a", 1, "x", "lines", None), ("a", 2, "y", "lines", None), ("a", 3, "z", "lines", None), ("b", 1, "x|bad", "whole", None), ("c", None, None, None, "whole: worse"), ("d", 1, "", "lines", None)]
    assert sorted(map(tuple, page_tables.extracted(files, ENGINES).collect()), key=repr) == sorted(want, key=repr)
    page_tables.register(spark, ENGINES)
    files.createOrReplaceTempView("some_files")
    assert sorted(map(tuple, spark.sql("SELECT * FROM extract_pages(TABLE(some_files))").collect()), key=repr) == sorted(want, key=repr)
    assert page_tables.extracted(files.where("false"), ENGINES).count() == 0


def test_one_page_at_a_time():
    """Pages are yielded as the engine makes them: none is made before the last was taken."""
    made = []

    def lazily(content):
        for n in range(1000):
            made.append(n)
            yield str(n)

    rows = page_tables._pages([("lazily", lazily)])().eval({"document_id": "a", "content": b""})
    next(rows)
    assert len(made) == 1001  # the pass that checks, and one page
    next(rows)
    assert len(made) == 1002


def test_paragraphs_over_parts(spark):
    r = random.Random(3)
    rows = [(d, n, "".join(r.choices(["ab ", "\n", "\n\n", "cdefgh", " \n \n", ""], k=r.randrange(0, 12)))) for d in ("x", "y", None) for n in range(15)] + [("z", 0, None)]
    df = spark.createDataFrame(rows, "document_id string, part int, text string")
    got = sorted(((str(x["document_id"]), x["n"], x["paragraph"]) for x in page_tables.split_paragraphs(df.repartition(4), 5).collect()))
    joined = df.groupBy("document_id").agg(F.array_join(F.array_sort(F.collect_list(F.struct("part", F.coalesce("text", F.lit("")).alias("text"))))["text"], "").alias("t"))
    want = joined.select("document_id", F.posexplode(text.paragraphs(F.col("t"), 5)).alias("n", "p")).collect()
    assert got == sorted((str(x["document_id"]), x["n"], x["p"]) for x in want) and len(got) > 20
    page_tables.register(spark, ENGINES, 5)
    df.createOrReplaceTempView("some_parts")
    assert spark.sql("SELECT * FROM split_paragraphs(TABLE(some_parts) PARTITION BY document_id ORDER BY part)").count() == len(got)
