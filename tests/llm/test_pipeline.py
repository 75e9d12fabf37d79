from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quern.llm import packing, pii, queries
from quern.sources.shared import shared_root

from .conftest import path
from .test_near_duplicates import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        got[name] = docs
        if name != "best_fit_packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    first = got["quality_classifier"]
    kept = labels.join(first, "doc_id", "left_semi")
    assert kept.where("quality = 1 AND toxic = 0").count() >= 0.95 * labels.where("quality = 1 AND toxic = 0").count()
    assert kept.where("quality = 0").count() <= 0.3 * max(1, labels.where("quality = 0").count())
    rows = [(r["doc_id"], r["text"]) for r in first.collect()]
    want = {k for k, _, c in brute(rows) if k == c}
    assert {r["doc_id"] for r in got["near_duplicates"].collect()} == want
    masked = {r["doc_id"]: r for r in got["pseudonyms"].collect()}
    direct = {r["doc_id"]: r["text"] for r in pii.pseudonymise(got["near_duplicates"], "text", pii.session_key(spark)).collect()}
    assert {k: r["text"] for k, r in masked.items()} == direct and all(r["n_chars"] == len(r["text"]) for r in masked.values())
    pieces = got["best_fit_packing"]
    ids = packing.encoder(path("byte_bpe_50k.json")).encode([r["text"] for r in masked.values()])
    assert pieces.agg(F.sum("length")).first()[0] == sum(len(i) // 4 + 1 for i in ids)
    assert {r["doc_id"] for r in pieces.select("doc_id").collect()} == set(masked)


def test_run(spark):
    folder = Path(shared_root(spark).removeprefix("file://")) / "quern"
    before = set(folder.glob("*"))
    assert corpus_pipeline.run(spark, SF).count() > 0 and corpus_pipeline.ORACLE_SQL is None
    assert [p.name.split("-")[0] for p in set(folder.glob("*")) - before] == ["best_fit_packing"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.sql(queries.ORACLE_SQL[name])
    at = [want.columns.index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)
