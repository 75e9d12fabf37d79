"""Saved answers that continue one another, and texts of objects of any layout."""

import json

from pyspark.sql import functions as F

from quern.functions import text
from quern.sources import answers
from quern.streaming import ingest


def line(title, asked, links, more=None, **other):
    answer = {"query": {"pages": {"1": {"links": [{"title": x} for x in links]}}}} | ({"continue": more} if more else {}) | other
    return json.dumps({"title": title, "asked": asked, "answer": json.dumps(answer)})


def test_chains():
    lines = [
        line("A", {"c": "2"}, ["d"]), line("A", {}, ["a", "b"], {"c": "1"}), line("A", {"c": "1"}, ["c"], {"c": "2"}), line("B", None, ["x", None, ""]), line("C", {}, ["y"], {"b": 1, "a": 2}), line("D", {"c": 1}, ["lost"]),
        line("E", {}, ["e"], {"c": "1"}), line("E", {"c": "1"}, ["f"], {"c": "1"}), "", "no json", "[1]", json.dumps({"title": "F", "answer": "{"}), json.dumps({"title": "G", "answer": "[]"}), json.dumps({"title": "H", "answer": "{}"}),
    ]
    got = list(answers.chains(iter(lines)))
    links = [(t, s, x) for t, s, x, e in got if e is None]
    assert links == [("A", 0, "a"), ("A", 0, "b"), ("A", 1, "c"), ("A", 2, "d"), ("B", 0, "x"), ("C", 0, "y"), ("E", 0, "e"), ("E", 1, "f")]
    errors = {t: (s, e) for t, s, x, e in got if e is not None}
    assert errors == {
        None: (None, "no saved answer"), "C": (1, 'no answer to {"a": 2, "b": 1}'), "D": (0, "no answer to {}"), "E": (2, 'leads back to {"c": "1"}'), "F": (0, "no links in the answer to {}"), "G": (0, "no links in the answer to {}"),
    }
    assert sum(e == "no saved answer" for *_, e in got) == 2


def test_batch_and_stream(spark, tmp_path):
    folder = tmp_path / "in"
    assert answers.saved_links(spark, str(folder)).count() == 0
    folder.mkdir()
    (folder / "001.jsonl").write_text("\n".join([line("A", {"c": "1"}, ["b"]), line("A", {}, ["a"], {"c": "1"})]))
    (folder / "002.jsonl").write_text(line("B", {}, ["c"], {"c": "1"}))
    (folder / "_draft").write_text("x")
    rows = answers.saved_links(spark, f"file://{folder}")
    assert rows.where("error IS NULL").count() == 3 and rows.where("error IS NOT NULL").count() == 1 and rows.columns == ["title", "step", "link", "error"]
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    ingest.drain(answers.saved_links(spark, str(folder), stream=True), out, state)
    assert spark.read.parquet(out).count() == 4
    (folder / "003.jsonl").write_text(line("C", {}, ["d", "e"]))
    ingest.drain(answers.saved_links(spark, str(folder), stream=True), out, state)  # goes on behind the second file
    assert sorted(r["link"] for r in spark.read.parquet(out).where("link IS NOT NULL").collect()) == ["a", "b", "c", "d", "e"]


def test_texts_of_objects(spark):
    lines = {
        '{"n": 1, "b": "x", "a": "y", "o": {"text": "q"}}': "x\ny", '{"data": "d", "text": "  ", "content": " c "}': " c ", '{"text": 5, "s": "t"}': "t", "{}": "", "[1]": None, "bad{": None, '{"a": null, "b": [1], "c": true}': "",
        '{"text": "é\\n日本"}': "é\n日本", '{"x": "a \\"b\\"", "y": ""}': 'a "b"\n', '"text"': None,
    }
    df = spark.createDataFrame([(x,) for x in lines] + [(None,)], "line string")
    got = {r["line"]: r["t"] for r in df.select("line", text.text_of_json(F.col("line")).alias("t")).collect()}
    assert got == lines | {None: None}
    named = df.where("line LIKE '%\"b\": \"x\"%'").select(text.text_of_json(F.col("line"), ("a", "b"))).first()[0]
    assert named == "y"
