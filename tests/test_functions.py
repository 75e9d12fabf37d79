"""Column functions against plain Python models, Devanagari included."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from quern.functions import chars, text

TEXTS = [
    "", " ", "\n\t", "नमस्ते दुनिया", "भारत एक देश है। १२३", "abc नमस्ते 123", "क्षि", "x" * 29, "x" * 30, "a²³¹ ①", "१२३४५६७८९०", "नमस्ते! @#", "a b c d", "é é", "日本 語",
    "line\nline\nline\nend", "line\nline\nend", "a\n\na\n\na", "  lead\ntrail  \n\n\n\n\nx", "see https://a.b/c?d=e now WWW.x.y z", "★ star → arrow\t\ttabs", "x\r\ny\r\nz", "l \nl \nl \nm",
]


def values(spark, column):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    return [r["v"] for r in df.select("i", column.alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize("script", [chars.DEVANAGARI, chars.LATIN_SCRIPT])
def test_ratios(spark, script):
    inside = re.compile("[ऀ-ॿ]" if script is chars.DEVANAGARI else "[A-Za-zÀ-ɏ]")
    got = {k: values(spark, c) for k, c in chars.char_ratios(F.col("text"), script).items()}
    for i, t in enumerate(TEXTS):
        n = len(t) or 1
        assert got["script_ratio"][i] == pytest.approx(len(inside.findall(t)) / n)
        assert got["latin_ratio"][i] == pytest.approx(sum(c.isascii() and c.isalpha() for c in t) / n)
        assert got["digit_ratio"][i] == pytest.approx(sum(c.isdigit() for c in t) / n)
        symbols = sum(not (c.isalnum() or c.isspace() or inside.match(c)) for c in t) if script is chars.DEVANAGARI else None
        if symbols is not None:
            assert got["symbol_ratio"][i] == pytest.approx(symbols / n)


def test_visible_ratio_and_counts(spark):
    ratio = values(spark, chars.script_ratio(F.col("text"), chars.DEVANAGARI, of_visible=True))
    counts = {k: values(spark, c) for k, c in chars.counts(F.col("text")).items()}
    for i, t in enumerate(TEXTS):
        shown = [c for c in t if not c.isspace()]
        assert ratio[i] == pytest.approx(sum("ऀ" <= c <= "ॿ" for c in shown) / (len(shown) or 1))
        assert (counts["char_count"][i], counts["word_count"][i], counts["estimated_token_count"][i]) == (len(t), len(t.split()), max(1, int(len(t) / 4.5)))


def normalised(t):
    t = unicodedata.normalize("NFC", t)
    t = re.sub(r"https?://\S+|www\.\S+", " ", t, flags=re.I)
    t = re.sub(f"[{text.DECORATIVE}]", "", t)
    t = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", t))
    out, lines = [], t.splitlines()
    while lines:
        n = next((k for k, x in enumerate(lines) if x != lines[0]), len(lines))
        out += lines[:1] if n >= 3 and lines[0].strip() else lines[:n]
        lines = lines[n:]
    return "\n".join(x.rstrip() for x in out).strip()


def test_normalise(spark):
    got = values(spark, text.normalise(F.col("text")))
    assert got == [normalised(t) for t in TEXTS]
    again = spark.createDataFrame([(t,) for t in got], "text string").select(text.normalise(F.col("text")).alias("v")).collect()
    assert [r["v"] for r in again] == got


def test_long_line_stays_linear(spark):
    df = spark.createDataFrame([("ab " * 60_000,)], "text string")
    assert df.select(F.length(text.normalise(F.col("text")))).first()[0] == 180_000 - 1


def test_forms(spark):
    assert values(spark, text.nfkc_words(F.col("text"))) == [" ".join(unicodedata.normalize("NFKC", t).split()) for t in TEXTS]


def test_repeated_lines(spark):
    def model(t):
        lines = [x.strip() for x in t.splitlines() if x.strip()]
        return any(lines[i] == lines[i + 1] == lines[i + 2] for i in range(len(lines) - 2))

    assert values(spark, text.has_repeated_lines(F.col("text"))) == [model(t) for t in TEXTS]


def test_titles(spark):
    rows = [("https://hi.x.org/wiki/A_b%20c", "A b c"), ("https://x.org/wiki/C%2B%2B", "C++"), ("https://x.org/wiki/a+b", "a+b"), ("https://x.org/plain_page", "plain page"), ("https://x.org", "")]
    df = spark.createDataFrame(rows, "url string, title string")
    assert all(r["a"] == r["title"] for r in df.select("title", text.page_title(F.col("url")).alias("a")).collect())


def test_extract(spark):
    page = "intro\n\n== Keep ==\nbody\n\n== References ==\nold\nold\n== Next ==\nmore\n\n\n\n=== See ===\nend\n==  references  ==\nlast"
    df = spark.createDataFrame([(page,), (None,)], "t string")
    got = [r[0] for r in df.select(text.clean_extract(F.col("t"), ["References"])).collect()]
    assert got == ["intro\n\nKeep\nbody\n\nNext\nmore\n\nSee\nend", ""]


def windows_of(t, size, overlap):
    """The windows by their definition."""
    out, at = [], 0
    while at + size < len(t):
        breaks = [i for i in range(at + 1, at + size - 1) if t[i : i + 2] == "\n\n"]
        end = breaks[-1] if breaks else at + size
        out.append(t[at:end])
        at = max(at + 1, end - overlap)
    return [*out, t[at:]]


def test_chunks_at_paragraphs(spark):
    r = random.Random(2)
    cases = ["a" * 50 + "\n\n" + "b" * 50, "ab\n\n" + "c" * 100, "short", "", None, "\n" * 200, "é" * 61, "x" * 60] + ["".join(r.choice("ab\n\n\n") for _ in range(r.randint(1, 400))) for _ in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    for size, overlap in ((60, 10), (20, 15), (7, 0)):
        got = [x["c"] for x in df.select("i", text.chunks_at_paragraphs(F.col("t"), size, overlap).alias("c")).orderBy("i").collect()]
        assert got == [windows_of(t or "", size, overlap) for t in cases]


def test_chunks_and_merge(spark):
    df = spark.createDataFrame([("x" * 5000,)], "t string")
    parts = df.select(text.chunks(F.col("t"), 2000, 200).alias("c")).first()["c"]
    assert [len(p) for p in parts] == [2000, 2000, 1400]
    rows = spark.createDataFrame([(1, "b"), (0, "a")], "i int, t string").agg(text.merge_chunks(F.col("i"), F.col("t")).alias("m")).first()["m"]
    assert rows == "a\n\nb"


def test_first_and_source(spark):
    df = spark.createDataFrame([(" ", None, "c"), (None, None, None), ("", " ", None)], "a string, b string, c string")
    assert [r[0] for r in df.select(text.first_text(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["c", "", "\n "]
    df = spark.createDataFrame([("x", "r"), ("", "r"), (None, "r")], "c string, r string")
    assert [r[0] for r in df.select(text.source_text(F.col("c"), F.col("r"))).collect()] == ["x", "r", "r"]


def test_mostly_latin(spark):
    def model(t):
        letters = sum(c.isalpha() for c in t)
        return bool(letters) and sum(c.isascii() and c.isalpha() for c in t) / letters >= 0.7

    assert values(spark, chars.mostly_latin(F.col("text"))) == [model(t) for t in TEXTS]
