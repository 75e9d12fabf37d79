"""The batch pipelines end to end on small folders."""

import gzip
import json

import pytest

from quern.__main__ import main
from quern.plans import pipelines
from quern.sources import records, run_log

HINDI = "यह एक अच्छा और लंबा वाक्य है जो जाँच के लिए लिखा गया है"


def test_ingest(spark, tmp_path):
    dataset = spark.createDataFrame([(f"d{i}", f"{HINDI} {i}") for i in range(30)], "id string, text string")
    pages = spark.createDataFrame([(f"t {i}", None, f"{HINDI} " * 3 + f"\n\n{'english only text ' * 9}\n\n{HINDI} {i} {HINDI}") for i in range(6)], "title string, url string, extract string")
    settings = pipelines.Settings(shard_mb=0.01, validation=0.1, test=0.1)
    log = run_log.RunLog(spark, str(tmp_path / "log"), "run")
    rows = pipelines.ingest(spark, settings, str(tmp_path), dataset, records.paragraph_records(pages, [], "w"), log).collect()
    # the first paragraph is the same on all pages, the English one is rejected
    assert sum(r["records"] for r in rows) == 30 + 1 + 6 and all(r["records"] for r in rows)
    assert spark.read.parquet(str(tmp_path / "quarantine")).count() == 6
    assert spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "final/parquet")).count() == 37
    assert (tmp_path / "final/txt/train/v1_train_00000.txt.gz").exists()
    events = {(e["phase"], e["component"]): (e["records_in"], e["records_out"], e["records_rejected"]) for e in run_log.read(spark, str(tmp_path / "log")).where("status = 'completed'").collect()}
    # 30 rows of the dataset; three paragraphs of each of six pages: six English, six the same, six of their own
    want = {("load", "dataset"): (30, 30, 0), ("filter", "documents"): (18, 12, 6), ("exact_duplicates", "documents"): (12, 7, 5), ("near_duplicates", "documents"): (7, 7, 0), ("split", "records"): (37, 37, 0)}
    assert {k: events[k] for k in want} == want and all(events["export", kind] == (37, 37, 0) for kind in settings.formats) and len(events) == 9
    head = spark.read.json(str(tmp_path / "reports/manifest_head")).first()
    assert head["corpus_version"] == "v1" and {s["source_type"] for s in head["sources"]} == {"huggingface_dataset", "wiki"}
    registry = spark.read.option("header", True).csv(str(tmp_path / "logs/file_registry"))
    assert registry.where("format = 'parquet'").agg({"row_count": "sum"}).first()[0] == 37 and registry.where("sha256 IS NULL").count() == 0
    assert spark.read.json(str(tmp_path / "reports/manifest")).where("split_name = 'train'").count() > 0
    again = pipelines.ingest(spark, settings, str(tmp_path), dataset, records.paragraph_records(pages, [], "w")).collect()
    assert sorted(again) == sorted(rows) and spark.read.parquet(str(tmp_path / "quarantine")).count() == 6
    assert spark.read.option("header", True).csv(str(tmp_path / "logs/file_registry")).where("format = 'parquet'").agg({"row_count": "sum"}).first()[0] == 37
    with pytest.raises(ValueError):
        pipelines.ingest(spark, settings, str(tmp_path))
    with pytest.raises(ValueError):
        pipelines.ingest(spark, pipelines.Settings(sources=("documents",)), str(tmp_path), dataset)


def test_tokenizer_steps(spark, tmp_path):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    spark.createDataFrame([(f"{HINDI} {i}",) for i in range(20)] + [("english",)], "final_text string").write.parquet(str(tmp_path / "in"))
    assert pipelines.sample_texts(spark, pipelines.Settings(), str(tmp_path / "in"), str(tmp_path)).first()["documents"] == 20
    sentences = spark.createDataFrame([(HINDI,), ("दूसरा वाक्य",)], "value string")
    settings = pipelines.Settings(specials=("<|endoftext|>",))
    report = pipelines.validate(spark, settings, path, "32k", sentences)
    assert report["roundtrip_success_rate"] == 1.0 and report["special_token_split_failures"] == 0 and report["vocab_size"] == 32_000
    good = report | {"chars_per_token": 4.0, "tokens_per_word": 1.2}
    best, shown = pipelines.compare(spark, [good | {"variant_name": "24k", "vocab_size": 24_000}, good])
    assert best == "32k" and "24k" in shown


def test_tokenize(spark, tmp_path):
    import public_tokenizers

    (tmp_path / "in").mkdir()
    for name in ("a", "b"):
        with gzip.open(tmp_path / "in" / f"{name}.jsonl.gz", "wt", encoding="utf-8") as f:
            f.write("".join(json.dumps({"text": f"{HINDI} {i}"}) + "\n" for i in range(60)) + "broken\n" + json.dumps({"text": "short"}) + "\n")
    settings = pipelines.Settings(sequence_length=64)
    sizes = {r["split_name"]: r["sequences"] for r in pipelines.tokenize(spark, settings, str(tmp_path / "in"), public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "out"), 0).collect()}
    assert sizes["validation"] == sizes["test"] == 4 and sizes["train"] > 10
    again = pipelines.tokenize(spark, settings, str(tmp_path / "in"), public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "out"), 0)
    assert {r["split_name"]: r["sequences"] for r in again.collect()} == sizes  # files that are there are skipped


def test_settings_and_dry_run(tmp_path, capsys):
    (tmp_path / "s.json").write_text('{"seed": 7, "formats": ["jsonl"]}')
    assert pipelines.load(tmp_path / "s.json") == pipelines.Settings(seed=7, formats=("jsonl",))
    (tmp_path / "quality.json").write_text('{"min_chars": 5, "script_weight": 0.5}')
    loaded = pipelines.load(tmp_path / "s.json")
    assert loaded.rules.min_chars == 5 and loaded.rules.script_weight == 0.5 and loaded.rules.script.name == "Devanagari"
    (tmp_path / "quality.json").unlink()
    (tmp_path / "n.json").write_text('{"quality": {"max_digits": 0.5}, "calls": {"attempts": 1}}')
    assert pipelines.load(tmp_path / "n.json").quality.max_digits == 0.5 and pipelines.load(tmp_path / "n.json").calls.attempts == 1
    (tmp_path / "odd.json").write_text('{"quality": {"none": 1}}')
    with pytest.raises(ValueError):
        pipelines.load(tmp_path / "odd.json")
    (tmp_path / "bad.json").write_text('{"sead": 7}')
    with pytest.raises(ValueError):
        pipelines.load(tmp_path / "bad.json")
    assert main(["--settings", str(tmp_path / "s.json"), "ingest", "--out", "x", "--dry-run"]) == 0
    assert "seed=7" in capsys.readouterr().out
