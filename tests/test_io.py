"""Sources, sinks and streams through a temporary folder."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from quern.functions import chars
from quern.operators import quality, split
from quern.sources import records, shared, sinks
from quern.streaming import ingest


def test_json_lines(spark, tmp_path):
    with gzip.open(tmp_path / "a.jsonl.gz", "wt") as f:
        f.write('{"text": "one"}\n\n{"text": \n{"text": ""}\n{"other": 1}\n{"text": "two"}\n')
    assert sorted(r["text"] for r in records.json_lines(spark, str(tmp_path)).collect()) == ["one", "two"]


def test_dataset_records(spark):
    rows = spark.createDataFrame([("a", "नमस्ते"), ("b", None)], "id string, text string")
    got = {r["document_id"]: r for r in records.dataset_records(rows, "s").collect()}
    assert got["a"]["record_id"] == "a_p0000" and got["a"]["char_count"] == 6 and got["b"]["final_text"] == "" and len(got["b"]["dedup_hash"]) == 64
    assert records.dataset_records(rows, "s", limit=1).count() == 1
    assert records.dataset_records(rows, "s").columns == [f.name for f in records.RECORD]


def test_page_and_paragraph_records(spark):
    pages = spark.createDataFrame([("d", 1, "x" * 60), ("d", 2, "short"), ("d", 3, "y" * 60_000)], "document_id string, page_number int, text string")
    assert [(r["record_id"], r["char_count"]) for r in records.page_records(pages, "s").orderBy("record_id").collect()] == [("d_p0001", 60), ("d_p0003", 50_000)]
    wiki = spark.createDataFrame([("A b", "u", "p" * 60 + "\n\nshort\n\n" + "q" * 50)], "title string, url string, extract string")
    assert [r["paragraph_id"] for r in records.paragraph_records(wiki, [], "s").orderBy("record_id").collect()] == ["p0000", "p0001"]


def test_fetched(spark, tmp_path):
    answer = {"query": {"pages": {"1": {"pageid": 1, "ns": 0, "title": "A", "extract": "text", "links": [{"ns": 0, "title": "B"}]}}}}
    (tmp_path / "a.json").write_text(json.dumps(answer))
    assert records.fetched_pages(spark, str(tmp_path)).first().asDict() == {"title": "A", "extract": "text"}
    assert records.fetched_links(spark, str(tmp_path)).first().asDict() == {"source": "A", "target": "B"}


def test_pdf_sources(spark, tmp_path):
    for name in ("one", "two"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "original.pdf").write_bytes(b"%PDF page1\fpage2")
    (tmp_path / "one" / "metadata.json").write_text(json.dumps({"source_id": "one", "source_name": "n"}))
    with pytest.raises(FileNotFoundError):
        records.pdf_sources(spark, str(tmp_path))
    (tmp_path / "two" / "metadata.json").write_text(json.dumps({"source_id": "two"}))
    found = records.pdf_sources(spark, str(tmp_path))

    def fails(_):
        raise RuntimeError

    pages = records.extract_pages(found, [("first", fails), ("second", lambda b: b.decode().split("\f"))])
    assert sorted((r["document_id"], r["page_number"], r["engine"]) for r in pages.collect()) == [("one", 1, "second"), ("one", 2, "second"), ("two", 1, "second"), ("two", 2, "second")]


def test_checkpoint(spark, tmp_path):
    calls = []

    def load():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "c")
    assert [records.checkpoint(spark, path, load).count(), records.checkpoint(spark, path, load).count(), len(calls)] == [3, 3, 1]
    records.checkpoint(spark, path, load, force=True)
    assert len(calls) == 2


def test_texts_and_sentences(spark, tmp_path):
    spark.createDataFrame([("a",), (None,)], "final_text string").write.parquet(str(tmp_path / "p"))
    assert records.texts(spark, str(tmp_path / "p")).count() == 1
    with pytest.raises(ValueError):
        records.texts(spark, str(tmp_path / "p"), "none")
    (tmp_path / "s.txt").write_text("a\n \nb\n")
    assert records.sentences(spark, str(tmp_path / "s.txt")).count() == 2


def test_cleaned_by(spark):
    df = spark.createDataFrame([("ab",), (None,)], "t string")
    assert [r["c"] for r in records.cleaned_by(df, "t", str.upper, out="c").collect()] == ["AB", ""]


def test_call_policy(spark):
    calls = []

    def flaky(t):
        calls.append(t)
        if len(calls) < 3:
            raise TimeoutError("late")
        return t.upper()

    assert records.CallPolicy(base_seconds=0).guard(flaky)("a") == "A" and len(calls) == 3

    def never(_):
        calls.append(1)
        raise TimeoutError("late")

    calls.clear()
    with pytest.raises(records.CallError):
        records.CallPolicy(attempts=2, base_seconds=0).guard(never)("a")
    assert len(calls) == 2
    calls.clear()

    def refuses(_):
        calls.append(1)
        raise ValueError("no")

    with pytest.raises(records.CallError):
        records.CallPolicy(base_seconds=0).guard(refuses)("a")
    assert len(calls) == 1
    df = spark.createDataFrame([("ab",), (None,)], "t string")
    off = records.cleaned_by(df, "t", never, out="c", policy=records.CallPolicy(enabled=False))
    assert [r["c"] for r in off.collect()] == ["ab", None]
    with pytest.raises(Exception, match="no answer in 1 attempts"):
        records.cleaned_by(df, "t", never, out="c", policy=records.CallPolicy(attempts=1)).collect()

    def some(t):
        if t == "b":
            raise ValueError
        return t + "!"

    got = records.fetched(spark.createDataFrame([("a",), ("b",)], "title string"), "title", some)
    assert {r["title"]: r["answer"] for r in got.collect()} == {"a": "a!", "b": None}


def test_extraction_that_fails(spark):
    def fails(_):
        raise RuntimeError("broken")

    row = records.extract_pages(spark.createDataFrame([("d", bytearray(b"x"))], "source_id string, content binary"), [("one", fails)]).first()
    assert row["error"] == "one: broken" and row["text"] is None


def test_evaluation_report():
    text = sinks.evaluation_report(5, 12.345, 13.0, {"script_ratio": 0.5, "unknowns": 1.25}, [{"prompt": "p", "generated": "g"}])
    assert "12.35" in text or "12.34" in text
    assert "| Avg UNK tokens per sample | 1.2 |" in text and "Sample 1" in text and "step: 5" in text


def test_exports(spark, tmp_path):
    rows = records.dataset_records(spark.createDataFrame([(f"d{i}", f"text {i} " * 20) for i in range(40)], "id string, text string"), "s")
    named = split.by_document(rows, "document_id", 1, 0.1, 0.1)
    sharded = sinks.with_shards(named, megabytes=0.001).cache()
    assert sharded.count() == 40
    sinks.export_parquet(sharded, str(tmp_path / "final/parquet"))
    sinks.export_json_lines(sharded, str(tmp_path / "final/jsonl"))
    sinks.export_text(sharded, str(tmp_path / "final/txt"))
    assert spark.read.parquet(str(tmp_path / "final/parquet")).count() == 40
    lines = spark.read.json(str(tmp_path / "final/jsonl"))
    assert lines.count() == 40 and {"text", "record_id"} <= set(lines.columns)
    parts = b"".join(gzip.open(p).read() for p in (tmp_path / "final/txt").rglob("*.gz"))
    assert parts.count(b"\n\n") == 40
    named = sinks.name_files(spark, str(tmp_path / "final/parquet"), "v1", "parquet")
    assert all(p.endswith(f"{split_name}/v1_{split_name}_{n:05d}.parquet") for split_name, p, n in named) and len(named) == len({p for _, p, _ in named})
    assert spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "final/parquet")).count() == 40
    files = sinks.manifest(spark, str(tmp_path / "final"))
    counts = sharded.groupBy("split_name", "shard").agg(F.count("*").alias("row_count"))
    registry = sinks.file_registry(files.where("format = 'parquet'"), counts, "r")
    assert registry.columns == sinks.REGISTRY and registry.agg(F.sum("row_count")).first()[0] == 40 and registry.count() == len(named)
    head = sinks.manifest_head(sharded, "v1", "hi", "Devanagari", {"train": 0.8, "validation": 0.1, "test": 0.1}).first()
    assert [tuple(x) for x in head["sources"]] == [("s", "huggingface_dataset")] and head["splits"]["test"] == 0.1
    assert files.count() > 3 and all(len(r["sha256"]) == 64 for r in files.collect())
    assert list(sums := sinks.checksum_map(spark, str(tmp_path / "final"))) == sorted(sums)


def test_quarantine_of_runs(spark, tmp_path):
    path = str(tmp_path / "q")
    sinks.quarantine(spark.range(0), path, "r")
    assert not (tmp_path / "q").exists()
    sinks.quarantine(spark.range(2), path, "r1")
    sinks.quarantine(spark.range(3), path, "r2")
    sinks.quarantine(spark.range(5, 6), path, "r1")  # tried again
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(0, "r2"), (1, "r2"), (2, "r2"), (5, "r1")]
    sinks.quarantine(spark.range(0), path, "r1")
    assert {r["run_id"] for r in spark.read.parquet(path).collect()} == {"r2"}


def test_packed_files_are_done_once(spark, tmp_path, monkeypatch):
    path, parts = str(tmp_path / "s"), str(tmp_path / "p")
    rows = lambda *files: spark.createDataFrame([(n, [n], "train", f) for f in files for n in range(3)], "sequence long, input_ids array<int>, split_name string, file string")
    sizes = lambda: {r["file"]: r["count"] for r in spark.read.parquet(path).groupBy("file").count().collect()}
    sinks.packed(rows("a"), path, parts)
    # a job that ends between its two writes
    replace = sinks.replace

    def broken(*args, **more):
        replace(*args, **more)
        raise RuntimeError("lost")

    monkeypatch.setattr(sinks, "replace", broken)
    with pytest.raises(RuntimeError):
        sinks.packed(rows("a", "b"), path, parts)
    monkeypatch.setattr(sinks, "replace", replace)
    assert {r["file"] for r in sinks.finished(spark, parts).collect()} == {"a"} and sizes() == {"a": 3, "b": 3}
    sinks.packed(rows("a", "b", "c"), path, parts, spark.createDataFrame([("d",), ("c",), ("b",), ("a",)], "file string"))
    assert sizes() == {"a": 3, "b": 3, "c": 3}
    assert {r["file"]: r["sequences"] for r in spark.read.parquet(parts).collect()} == {"a": 3, "b": 3, "c": 3, "d": 0} and spark.read.parquet(parts).count() == 4


def test_reports(spark, tmp_path):
    sinks.json_report({"variant_name": "32k", "vocab_size": 32000, "unk_rate": 0.0, "extra": 1}, tmp_path / "v.json")
    row = records.reports(spark, [str(tmp_path / "v.json")]).first()
    assert row["variant_name"] == "32k" and row["thresholds"]["max_unk_rate"] == 0.001
    assert "| 32k |" in sinks.markdown_table([{"name": "32k", "rate": 0.5}], "Report")
    assert records.synthetic(spark, ["a", "b", "c"], 7).groupBy("text").count().count() == 3


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    text = "This is a clean and long enough text for the filter."
    (tmp_path / "in" / "a.json").write_text("\n".join(json.dumps({"text": t}) for t in (text, text, "x", text + " More of it.")))
    stream = ingest.clean_stream(ingest.arriving(spark, str(tmp_path / "in"), "text string"), "text", quality.QualityRules(script=chars.LATIN_SCRIPT))
    ingest.drain(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    rows = [(f"2024-01-01 0{h}:10:00", "a", 1.0) for h in (0, 0, 1, 5)]
    spark.createDataFrame(rows, "ts string, k string, v double").select(F.to_timestamp("ts").alias("ts"), "k", "v").write.parquet(str(tmp_path / "ev"))
    events = ingest.arriving(spark, str(tmp_path / "ev"), "ts timestamp, k string, v double", "parquet")
    ingest.drain(ingest.event_windows(events, "ts", "k", "v"), str(tmp_path / "w"), str(tmp_path / "wk"))
    assert {(str(r["window_start"])[11:13], r["events"]) for r in spark.read.parquet(str(tmp_path / "w")).collect()} >= {("00", 2), ("01", 1)}


def test_tidied(spark):
    outer = shared.scratch(spark, "outer")
    with pytest.raises(ZeroDivisionError), shared.tidied(spark):
        inner = shared.scratch(spark, "inner")
        spark.range(3).write.parquet(inner)
        with shared.tidied(spark):
            innermost = shared.scratch(spark, "innermost")
            spark.range(3).write.parquet(innermost)
        assert shared.exists(spark, inner) and not shared.exists(spark, innermost)
        spark.range(3).write.parquet(outer)
        raise ZeroDivisionError
    assert shared.exists(spark, outer) and not shared.exists(spark, inner)
