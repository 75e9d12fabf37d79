r"""Chat formatting with a grammar round trip, by SQL functions alone.

A conversation is the concatenation of its turns, and a turn is a mark, a body and a mark. The parser is
deterministic: marks cut the text into marks and bodies in turn, so that any mark inside a body shows. The marks
are those of `Template`; a role without marks of its own is written into the body with its length (`6:critic...`).

Escape sign is the backslash, put after each backslash and opening bracket of a body. In an escaped body no
mark can begin, and reading drops the sign after such a character, so the way back is one replacement for every body,
escaped or not. Most bodies need none. Which do is found by the round trip:

1. Every turn is rendered as it stands, reparsed and compared with its source; where role or text differ (the body
   holds a mark, runs into one, or holds what would be read as an escape), the body is escaped. Turns are single rows here:
   no grouping.
2. Turns are put together by conversation, and the whole is reparsed and compared with the source turns. Marks are
   read from left to right without memory, so turns that come back alone come back together.
3. What is still not identical ends the job: no text leaves that does not come back.

The loss mask is a list of spans of the formatted text's UTF-8 bytes, the bodies of the learned roles in order.

Null texts and roles count as empty. Turns of one number are ordered by role and text, a null turn comes first; repeated
rows are turns of their own. A row without a conversation id is a conversation of its own. Texts of any length are
formatted whole; a conversation is one value and so ends at 2 GB, as any of Spark's. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """The marks before and after a body by role, those of other roles, and the roles whose bodies are learned."""

    marks: dict[str, tuple[str, str]] = field(default_factory=lambda: {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")})
    other: tuple[str, str] = ("[ROLE]", "[/ROLE]")
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        marks = self.all()
        if len(set(marks)) < len(marks) or any(len(m) < 2 or ESCAPE in m or any(o != m and o in m for o in marks) for m in marks):
            raise ValueError("marks must differ, have two characters or more, no backslash, and not hold one another")
        if len({self.marks[r][0] for r in self.marks} | {self.other[0]}) < len(self.marks) + 1:
            raise ValueError("every role needs an opening mark of its own")

    def all(self) -> list[str]:
        return [m for pair in (*self.marks.values(), self.other) for m in pair]

    @property
    def control(self) -> str:
        """A pattern of every mark."""
        return "|".join(re.escape(m) for m in self.all())

    @property
    def openers(self) -> str:
        """The class of characters that begin marks, and of the escape sign."""
        return "[" + "".join(re.escape(c) for c in sorted({m[0] for m in self.all()} | {ESCAPE})) + "]"


def _bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is made once."""
    return F.transform(F.array(value), f)[0]


def _escaped(body: Column, template: Template) -> Column:
    return F.regexp_replace(body, f"({template.openers})", r"$1\\")


def _unescaped(body: Column, template: Template) -> Column:
    return F.regexp_replace(body, rf"({template.openers})\\", "$1")


def _body(role: Column, text: Column, template: Template) -> Column:
    return F.when(role.isin(*template.marks), text).otherwise(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))


def _rendered(role: Column, body: Column, template: Template) -> Column:
    def mark(i: int) -> Column:
        out = F.lit(template.other[i])
        for name, pair in template.marks.items():
            out = F.when(role == name, F.lit(pair[i])).otherwise(out)
        return out

    return F.concat(mark(0), body, mark(1))


def parse(formatted: Column, template: Template) -> Column:
    """The turns (role, text) of a formatted text as an array; null if it does not follow the grammar.

    Marks must come in pairs of one role, with nothing between a closing and the next opening mark.
    """
    marks = F.regexp_extract_all(formatted, F.lit(f"({template.control})"), F.lit(1))
    pieces = F.split(formatted, template.control, -1)
    pairs = {opens: (role, closes) for role, (opens, closes) in template.marks.items()}

    def turn(i: Column, m: Column, p: Column) -> Column:
        opens, closes, body = F.get(m, 2 * i), F.get(m, 2 * i + 1), _unescaped(F.get(p, 2 * i + 1), template)
        digits = F.regexp_extract(body, r"^(\d{1,9}):", 1)
        n, skip = digits.cast("int"), F.char_length(digits) + 2
        named = F.struct(F.substring(body, skip, n).alias("role"), F.substring(body, skip + n, F.char_length(body)).alias("text"))
        out = F.when((opens == template.other[0]) & (closes == template.other[1]) & (digits != ""), named)
        for begin, (role, end) in pairs.items():
            out = out.when((opens == begin) & (closes == end), F.struct(F.lit(role).alias("role"), body.alias("text")))
        return F.when(F.get(p, 2 * i) == "", out)

    def turns(both: Column) -> Column:
        m, p = both["marks"], both["pieces"]
        last = F.floor(F.size(m) / 2).cast("int") - 1
        each = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: turn(i, m, p))).otherwise(F.array())
        whole = (F.size(m) % 2 == 0) & (F.element_at(p, -1) == "")
        return F.when(whole & ~F.exists(each, lambda t: t.isNull()), each)

    return _bound(F.struct(marks.alias("marks"), pieces.alias("pieces")), turns)


def masked(formatted: Column, spans: Column, template: Template) -> Column:
    """The text under a mask: bodies of the spans of UTF-8 bytes, unescaped, joined."""
    piece = lambda raw: F.transform(spans, lambda s: _unescaped(F.decode(F.substring(raw, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")), "UTF-8"), template))
    return F.array_join(_bound(formatted.cast("binary"), piece), "")


def format_chats(df: DataFrame, conversation: str, turn: str, role: str, text: str, template: Template = Template()) -> DataFrame:
    """conversation, formatted, loss (array of byte spans), turns (role, text; as reparsed) and learned (the text under the mask)."""
    said = df.select(
        F.col(conversation).alias("conv"), F.when(F.col(conversation).isNull(), F.monotonically_increasing_id()).alias("apart"),
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    own = F.array(F.struct("role", "text"))
    bodies = said.withColumn("body", _body(F.col("role"), F.col("text"), template)).withColumn("alone", _rendered(F.col("role"), F.col("body"), template))
    kept = F.coalesce(parse(F.col("alone"), template) == own, F.lit(False))
    bodies = bodies.select("conv", "apart", "turn", "role", "text", F.when(kept, F.col("body")).otherwise(_escaped(F.col("body"), template)).alias("body"))
    # places in bytes: running sums of the rendered turns
    order = Window.partitionBy("conv", "apart").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    piece = bodies.withColumn("piece", _rendered(F.col("role"), F.col("body"), template))
    size = lambda c: F.octet_length(c).cast("long")
    opening = size(F.regexp_extract("piece", f"^({template.control})", 1))
    placed = piece.withColumn("start", F.sum(size(F.col("piece"))).over(order) - size(F.col("piece")) + opening).withColumn("end", F.col("start") + size(F.col("body")))
    grouped = placed.groupBy("conv", "apart").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "piece", "start", "end"))).alias("rows"))
    spans = F.transform(F.filter("rows", lambda r: r["role"].isin(*template.learned)), lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end")))
    source = F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text")))
    formatted = F.array_join(F.transform("rows", lambda r: r["piece"]), "")
    made = grouped.select("conv", source.alias("source"), _bound(formatted, lambda f: F.struct(f.alias("formatted"), spans.alias("loss"), parse(f, template).alias("turns"))).alias("made"))
    lost = F.raise_error(F.lit("a conversation does not come back from its format"))
    done = made.select("conv", F.when(F.col("made")["turns"] == F.col("source"), F.col("made")).otherwise(lost).alias("made"))
    out = done.select(F.col("conv").alias(conversation), "made.*")
    return out.withColumn("learned", masked(F.col("formatted"), F.col("loss"), template))
