"""The choice of bands and rows, and what it finds."""

import itertools
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quern.functions import chars
from quern.operators import dedup


def test_choice():
    assert dedup.band_choice() == dedup.band_choice(0.85) == (8, 16) and dedup.band_choice(0.80) == (9, 13)
    assert dedup.band_choice(0.5, 256)[0] * dedup.band_choice(0.5, 256)[1] <= 256
    fewer, more = dedup.band_choice(0.8, 128, missed=0.1), dedup.band_choice(0.8, 128, missed=0.9)
    meet = lambda c: 1 - (1 - 0.8 ** c[1]) ** c[0]
    assert meet(fewer) < meet((9, 13)) < meet(more)
    assert dedup.band_choice(0.3, 1) == (1, 1)
    for bad in ((0.0, 128), (1.0, 128), (0.5, 0)):
        with pytest.raises(ValueError):
            dedup.band_choice(*bad)


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="no test tables here")
@pytest.mark.parametrize("threshold", [0.8, 0.85])
def test_recall(spark, threshold):
    """Of all pairs of documents whose shingles have that similarity, nine in ten share a band."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").where("text IS NOT NULL")
    sets = {r["doc_id"]: set(r["s"]) for r in docs.select("doc_id", dedup.shingles(F.col("text")).alias("s")).collect()}
    keyed = docs.select("doc_id", dedup.shingle_hashes(chars.words(F.col("text"))).alias("h")).select("doc_id", dedup.band_keys(F.col("h"), *dedup.band_choice(threshold)).alias("k"))
    keys = {r["doc_id"]: set(r["k"]) for r in keyed.collect()}
    alike = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])]
    found = sum(bool(keys[a] & keys[b]) for a, b in alike)
    assert len(alike) > 20 and found >= 0.9 * len(alike)
