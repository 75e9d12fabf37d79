"""Every stage on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"
MARKS = ["score", "tail", "kept", "expected_grade", "rated", "pii_kinds", "kinds", "row_key", "component_id", "n_shingles", "digest", "_scored", "_pii"]
STAGES = dict(corpus_pipeline.STAGES)


def table(spark, rows):
    good = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return good.withColumns({c: F.lit(f"own {c}") for c in MARKS})


@pytest.fixture(scope="module")
def rows(spark):
    real = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    return [*real, (None, None), (None, real[0][1]), (1, None), (2, ""), (3, ""), (3, ""), (5, real[1][1]), (5, real[1][1]), (10**15, "call me at a@b.de " * 9000), (-1, "x" * 200_000)]


@pytest.mark.parametrize("name", STAGES)
def test_stage(spark, rows, name):
    docs = table(spark, rows)
    out = STAGES[name](spark, docs, SF)
    if name == "best_fit_packing":
        got = out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()
        assert {r["doc_id"] for r in got} == {i for i, _ in rows} and out.where("length > 1024 OR offset + length > 1024").count() == 0
        assert out.where("piece = 0").count() == len(rows)
        return
    assert out.columns == docs.columns
    kept = out.collect()
    assert all(r[c] == f"own {c}" for r in kept for c in MARKS)
    if name == "pseudonyms":
        assert len(kept) == len(rows) and all((r["text"] is None) or r["n_chars"] == len(r["text"]) for r in kept)
        assert not any("a@b.de" in (r["text"] or "") for r in kept)
    if name == "near_duplicates":
        texts = [r["text"] for r in kept]
        assert sum(t is None for t in texts) == 2 and sum(t == "" for t in texts) == 3
        assert all(texts.count(t) == 1 for t in texts if t) and any(t and len(t) == 200_000 for t in texts)
    if name == "quality_classifier":
        assert {(r["doc_id"], r["text"]) for r in kept} <= set(rows)


@pytest.mark.parametrize("name", STAGES)
def test_empty_table(spark, name):
    assert STAGES[name](spark, table(spark, []), SF).count() == 0
