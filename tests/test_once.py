"""Dear steps run once, in small batches, and whatever form a table has."""

import hashlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.functions import chars, text
from quern.operators import dedup, sample, shards, split
from quern.plans.run_queries import QUERIES
from quern.streaming import ingest

DATA = Path("/root/testdata/sf0.001")
tables = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")
ODD = ["", " ", "a", " a  b ", "naïve 日本語x y z", "é", "x\u0085y　", "abc\x1cdef!~\x7fg \x00", "😀 a😀b", "\t\n"]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_words_counts_and_strip_of_odd_texts(spark):
    df = spark.createDataFrame([(t,) for t in ODD], "t string")
    t, some = F.col("t"), chars.LATIN_SCRIPT.inside
    got = df.select("t", chars.words(t), chars.word_count(t), chars.count_of(t, some), chars.count_of(t, some, rare=True), chars.strip(t)).collect()
    assert [r[1] for r in got] == [r[0].split() for r in got] and [r[2] for r in got] == [len(r[0].split()) for r in got]
    assert [r[3] for r in got] == [r[4] for r in got] == [sum(c.isascii() and c.isalpha() or "\xc0" <= c <= "ɏ" for c in r[0]) for r in got]
    assert [r[5] for r in got] == [r[0].strip() for r in got]


@tables
def test_sample_normalises_once_and_orders_sizes_alone(spark):
    docs = spark.read.parquet(str(DATA / "documents.parquet"))
    for drawn in (sample.tokenizer_sample(docs, "doc_id", "text", chars.LATIN_SCRIPT, 50_000), sample.budget(docs, "doc_id", "text", 50_000)):
        assert "ArrowEvalPython" not in plan(drawn)  # it is written
        ordered = next(x for x in plan(drawn).splitlines() if "Window" in x)
        assert "value" not in ordered and "text" not in ordered
    assert plan(QUERIES["nfkc_words"](spark, str(DATA))).count("ArrowEvalPython") == 1


def test_sample_of_repeated_ids(spark):
    rows = [(n // 2 if n % 7 else None, "x" * (n % 5)) for n in range(40)]
    found = sample.budget(spark.createDataFrame(rows, "id long, t string"), "id", "t", 50, 1)
    sizes = [len(r["t"]) + 1 for r in found.collect()]
    assert 50 <= sum(sizes) < 50 + 5


@tables
@pytest.mark.parametrize("name", ["cleaned_stream", "streaming_event_windows", "watermarked_event_windows"])
def test_streams_of_a_folder(spark, tmp_path, name):
    """Large tables are folders of files."""
    for t in ("documents", "events"):
        spark.read.parquet(str(DATA / f"{t}.parquet")).repartition(3).write.parquet(str(tmp_path / f"{t}.parquet"))
    want, got = (sorted(map(repr, QUERIES[name](spark, p).collect())) for p in (str(DATA), str(tmp_path)))
    assert got == want and got


def test_normalised_once_for_all_rules(spark, tmp_path):
    from quern.operators.quality import QualityRules

    rows = spark.createDataFrame([("é" * 40,)], "text string")
    assert plan(ingest.clean_stream(rows, "text", QualityRules())).count("ArrowEvalPython") == 1


def test_tokenizer_takes_slices(spark):
    assert list(shards.slices(["aa", "b", "cccc", "d", "e"], 3)) == [["aa", "b"], ["cccc"], ["d", "e"]] and list(shards.slices([], 3)) == []
    import public_tokenizers

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [(n, t) for n, t in enumerate([*ODD, "many words " * 40_000, None])]
    back = shards.decode(shards.encode(spark.createDataFrame(texts, "n int, t string"), "t", path, end_id=None), "ids", path, "back")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 512
    assert [r["back"] for r in back.orderBy("n").collect()] == [t or "" for _, t in texts]


def test_word_ids(spark, monkeypatch):
    texts = [*ODD, "many words many words", "w" * 100, None]
    want = [[*(int(hashlib.md5(w.encode()).hexdigest()[:4], 16) for w in (t or "").split()), 0] for t in texts]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    for most in (text.KEPT_WORDS, 2):
        monkeypatch.setattr(text, "KEPT_WORDS", most)
        made = rows.select("n", text.word_ids(F.col("t")).alias("ids"))
        assert [r["ids"] for r in made.orderBy("n").collect()] == want and "conv(" not in plan(made)


@tables
def test_words_of_sequences_are_hashed_in_batches(spark):
    from quern.plans.registry import _word_ids

    made = _word_ids(spark.read.parquet(str(DATA / "documents.parquet")))
    assert "ArrowEvalPython" in plan(made) and "conv(" not in plan(made)


def test_runs_and_signatures():
    words = [f"w{i % 90}".encode() for i in range(500)]
    want = [int(hashlib.md5(b" ".join(words[i : i + 3])).hexdigest()[:8], 16) % dedup.PRIME for i in range(498)]
    assert dedup.run_hashes(words, 3).tolist() == want
    a, b = (x.astype(object) for x in dedup.permutations())
    for hashes in (want, [0], [dedup.PRIME - 1, 5]):
        assert dedup.signature(np.array(hashes)).tolist() == [min((x * p + q) % dedup.PRIME for x in hashes) for p, q in zip(a, b)]


@tables
def test_sequences_are_made_once(spark):
    from quern.plans.registry import _sequences

    made = _sequences(spark, str(DATA))
    assert "collect_list" not in plan(split.by_file(made.select("lang", "sequence"), "lang", "sequence"))
    rows, n = shards.numbered(made, "lang", "sequence", "input_ids", 2)
    assert n == rows.count() == made.count() // 2
    assert plan(QUERIES["token_metrics"](spark, str(DATA))).count("md5(") == 1


@tables
def test_synthetic_rows_join_the_table(spark):
    assert "parquet" in plan(QUERIES["synthetic_rows"](spark, str(DATA))) and "LocalRelation" not in plan(QUERIES["synthetic_rows"](spark, str(DATA)))
