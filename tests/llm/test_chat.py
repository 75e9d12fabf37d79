import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quern.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string"
TOKENS = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "\\", "<", "[", "]", ">", "/", "a", " ", "\n", "é", "😀", "7:", "s>", "INST]"]


def made(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"formatted": F.lit(1), "loss": F.lit(2), "a": F.lit(3), "body": F.lit(4)})
    return chat.format_chats(df, "conv_id", "turn", "role", "text", **more).collect()


def source(rows):
    """Turns by conversation; those without an id stand alone."""
    out = {}
    for n, (c, t, r, x) in enumerate(rows):
        out.setdefault((c, n if c is None else None), []).append((-1 if t is None else t, r or "", x or ""))
    return {k: [(r, x) for _, r, x in sorted(v, key=lambda y: (y[0], y[1].encode(), y[2].encode()))] for k, v in out.items()}


def parse(text):
    """The turns of a formatted text by a reader that goes character by character."""
    marks = {"<<SYS>>": ("system", "<</SYS>>"), "[INST]": ("user", "[/INST]"), "<s>": ("assistant", "</s>"), "[ROLE]": (None, "[/ROLE]")}
    at, out = 0, []
    while at < len(text):
        opens = next(m for m in marks if text.startswith(m, at))
        role, closes = marks[opens]
        at += len(opens)
        body, begin = "", at
        while not text.startswith(closes, at):
            body += text[at]
            at += 2 if text[at] in "<[\\" and text[at + 1] == "\\" else 1
        span = (len(text[:begin].encode()), len(text[:at].encode()))
        at += len(closes)
        if role is None:
            n, _, body = body.partition(":")
            role, body = body[: int(n)], body[int(n) :]
        out.append((role, body, span))
    return out


def check(rows, got):
    want = sorted(source(rows).values())
    read = [parse(r["formatted"]) for r in got]
    assert sorted([(a, b) for a, b, _ in turns] for turns in read) == want
    for r, turns in zip(got, read):
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(a, b) for a, b, _ in turns]
        assert [tuple(s) for s in r["loss"]] == [s for a, _, s in turns if a == "assistant"]
        assert r["learned"] == "".join(b for a, b, _ in turns if a == "assistant")


def test_hostile_texts(spark):
    r = random.Random(5)
    role = lambda: r.choice(["user", "assistant", "system", "critic", "[ROLE]", "9:x", "", None, "a\\"])
    rows = [(c, t, role(), "".join(r.choices(TOKENS, k=r.randrange(9)))) for c in range(150) for t in range(r.randrange(1, 6))]
    check(rows, made(spark, rows))


def test_plain_texts_stay_as_they_are(spark):
    (got,) = made(spark, [(1, 0, "user", "a < b [c] \\ d"), (1, 1, "assistant", "x"), (1, 2, "critic", "y")])
    assert got["formatted"] == "[INST]a < b [c] \\ d[/INST]<s>x</s>[ROLE]6:criticy[/ROLE]"


def test_control_strings_are_escaped(spark):
    (got,) = made(spark, [(1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "fine")])
    assert got["formatted"] == "[INST]<\\/s>[\\INST] ok [\\/INST][/INST]<s>fine</s>" and got["learned"] == "fine"


def test_edges(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "x"), (None, 0, "user", "p"), (None, 0, "user", "p"), (2, 5, "assistant", ""), (3, 1, "assistant", "b" * 300_000 + "</s>"), (3, 0, "system", "")]
    got = made(spark, rows)
    check(rows, got)
    assert len(got) == 5
    assert made(spark, []) == []


def test_bodies_that_run_into_their_closing_mark(spark):
    """`aa` closes: a body that ends in `a` would end one character early."""
    odd = chat.Template({"user": ("<u>", "aa"), "assistant": ("<s>", "</s>")}, ("<r>", "</r>"))
    rows = [(1, 0, "user", "ba"), (1, 1, "assistant", "aa a"), (1, 2, "user", "aaa"), (1, 3, "critic", "a\\a")]
    (got,) = made(spark, rows, template=odd)
    assert [(t["role"], t["text"]) for t in got["turns"]] == [(r, x) for _, _, r, x in rows] and got["learned"] == "aa a"
    raw = got["formatted"].encode()
    assert [raw[s["start"] : s["end"]] for s in got["loss"]] == [b"a\\a\\ a\\"] and got["formatted"].startswith("<u>ba\\aa<s>")


def test_what_is_no_format(spark):
    texts = ["", "x", "<s>a", "<s>a</s>x", "<s>a[/INST]", "[ROLE]x[/ROLE]", "</s>a<s>", "<s></s>"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(chat.parse(F.col("t"), chat.Template())).collect()]
    assert got[0] == [] and got[1:7] == [None] * 6 and [tuple(t) for t in got[7]] == [("assistant", "")]


def test_templates_are_checked():
    for marks in ({"user": ("<u>", "<u>")}, {"user": ("a", "<b>")}, {"user": ("<u>", "<u>x")}, {"user": ("<\\u>", "<b>")}, {"user": ("<u>", "<b>"), "x": ("<u>", "<c>")}):
        with pytest.raises(ValueError):
            chat.Template(marks)


def test_a_long_conversation(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t} <s>" * 3) for t in range(3000)]
    check(rows, made(spark, rows))


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r["conv_id"]: r for r in queries.op12_chat_format(spark, "/root/testdata/sf0.001").collect()}
    want = source(rows)
    assert len(got) == len(want)
    for (c, _), turns in want.items():
        learned = "".join(x for r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["turns_sha256"] == sha("".join(f"{r}\n{x}\n" for r, x in turns))
        assert got[c]["loss_chars"] == len(learned) and got[c]["loss_sha256"] == sha(learned)


def test_no_python_worker(spark):
    plan = queries.op12_chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "RDD"))
