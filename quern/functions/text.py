"""Text clean-up as column expressions; Unicode forms by Arrow batches (Spark has no function for them)."""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.shared import ship
from .chars import LINE_END, SPACE, SPACE_IN_LINE, strip

# A fixed value: symbols that carry no text.
DECORATIVE = "★☆✓✗✔✘•◦▪▫►◄→←↑↓"
_EXTRACT_HEADING = r"==+[ \t\n\x0b\f\r]*([^\n]*?)[ \t\n\x0b\f\r]*==+"


#: Words whose ids a worker keeps, and their longest length: most words of a text were met before.
KEPT_WORDS, KEPT_LENGTH = 200_000, 64


class _WordIds(dict):
    def __missing__(self, word: str) -> int:
        found = int.from_bytes(hashlib.md5(word.encode()).digest()[:2])
        if len(word) <= KEPT_LENGTH and len(self) < KEPT_WORDS:
            self[word] = found
        return found


def word_ids(text: Column) -> Column:
    """The leading 16 bits of each word's MD5, then 0 for the end of the text (`str.split` cuts at SPACE); a null text is empty.

    In Arrow batches: Spark has these functions, but not within generated code where they run over the words of an array.
    """
    ship()

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = _WordIds()
        for batch in batches:
            yield pd.Series([np.array([*map(known.__getitem__, (t or "").split()), 0], np.int32) for t in batch], dtype=object)

    return ids(text)


def _form(name: str):
    ship()

    @F.pandas_udf("string")
    def normalised(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: unicodedata.normalize(name, t), na_action="ignore")

    return normalised


def _unicode(text: Column, name: str) -> Column:
    """ASCII texts are in every form, so only others go to Python."""
    return F.when(text.rlike(r"[^\x00-\x7f]"), _form(name)(text)).otherwise(text)


def nfc(text: Column) -> Column:
    return _unicode(text, "NFC")


def nfkc_words(text: Column) -> Column:
    """NFKC with runs of white space as one space, and none at the ends, in one pass (`str.split` cuts at SPACE)."""
    ship()

    @F.pandas_udf("string")
    def spaced(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: " ".join(unicodedata.normalize("NFKC", t).split()), na_action="ignore")

    return spaced(text)


def remove_urls(text: Column) -> Column:
    return F.regexp_replace(text, f"(?i)https?://[^{SPACE}]+|www\\.[^{SPACE}]+", " ")


def remove_decorative(text: Column) -> Column:
    return F.translate(text, DECORATIVE, "")


def collapse_space(text: Column) -> Column:
    """Blanks and tabs to one blank, three or more line feeds to two."""
    return F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), r"\n{3,}", "\n\n")


def drop_repeated_lines(text: Column) -> Column:
    """Runs of three or more equal lines that are not blank, to one. Lines end at line feeds.

    The possessive group keeps it linear on long lines.
    """
    return F.regexp_replace(text, rf"(?md)^(?=[{SPACE_IN_LINE}]*+[^{SPACE}])([^\n]*+)(?:\n\1$){{2,}}", "$1")


def trim_lines(text: Column) -> Column:
    """Without white space at line ends and at both ends of the text."""
    return strip(F.regexp_replace(text, rf"[{SPACE_IN_LINE}]++(?=\n)", ""))


def normalise(text: Column, urls: bool = True) -> Column:
    """Unicode NFC, URLs, decorative symbols, white space, repeated lines, trimmed lines, in this order."""
    t = nfc(text)
    t = remove_urls(t) if urls else t
    t = collapse_space(remove_decorative(t))
    return trim_lines(drop_repeated_lines(F.regexp_replace(t, LINE_END, "\n")))


def has_repeated_lines(text: Column) -> Column:
    """Whether three consecutive lines are equal, blank ones and white space at their ends aside."""

    def repeated(lines: Column) -> Column:
        starts = F.when(F.size(lines) >= 3, F.sequence(F.lit(1), F.size(lines) - 2)).otherwise(F.array().cast("array<int>"))
        at = lambda i: F.element_at(lines, i)
        return F.exists(starts, lambda i: (at(i) == at(i + 1)) & (at(i) == at(i + 2)))

    # the one element binds the lines, so that they are split once
    return F.exists(F.array(F.filter(F.transform(F.split(text, LINE_END), strip), lambda x: x != "")), repeated)


#: Names under which a text is looked for, in this order.
TEXT_NAMES = ("text", "content", "sentence", "document", "data")


def text_of_json(line: Column, names: tuple[str, ...] = TEXT_NAMES) -> Column:
    """The text of a JSON object of any layout: its first of these fields that holds a string that is not blank, else all its string fields, in their order, by line.

    Fields are VARIANT, so that no schema is needed; numbers, lists and objects are no text. Null for what is no object, empty for one without strings.
    """
    texts = lambda fields: F.transform(F.filter(F.map_entries(fields), lambda e: F.schema_of_variant(e["value"]) == "STRING"), lambda e: F.struct(e["key"].alias("key"), F.variant_get(e["value"], "$", "string").alias("text")))

    def pick(found: Column) -> Column:
        first = F.coalesce(*[F.get(F.filter(found, _named(n)), 0)["text"] for n in names])
        return F.coalesce(first, F.array_join(found["text"], "\n"))

    return F.transform(F.array(texts(F.from_json(line, "map<string, variant>"))), pick)[0]


def _named(name: str):
    return lambda e: (e["key"] == name) & (strip(e["text"]) != "")


def first_text(*columns: Column) -> Column:
    """The first that is not blank; if all are, the ones that are set, by lines."""
    return F.coalesce(*[F.when(strip(c) != "", c) for c in columns], F.concat_ws("\n", *columns))


def source_text(cleaned: Column, raw: Column) -> Column:
    """The cleaned text unless it is null or empty, else the raw one."""
    return F.coalesce(F.nullif(cleaned, F.lit("")), raw)


def page_title(url: Column) -> Column:
    """The title that a page's address names: what follows /wiki/, or the path."""
    path = F.coalesce(F.parse_url(url, F.lit("PATH")), F.lit(""))
    tail = F.when(F.instr(path, "/wiki/") > 0, F.regexp_replace(path, "^.*?/wiki/", "")).otherwise(F.regexp_replace(path, "^/+", ""))
    return F.translate(F.url_decode(F.replace(tail, F.lit("+"), F.lit("%2B"))), "_", " ")


def clean_extract(text: Column, excluded: list[str]) -> Column:
    """A plain-text page without the excluded sections and without heading marks. A section at the very start stays."""
    t = F.coalesce(text, F.lit(""))
    if excluded:
        names = "|".join("\\Q" + s + "\\E" for s in excluded)
        t = F.regexp_replace(t, rf"(?sui)\n==+[{SPACE}]*(?:{names})[{SPACE}]*==+\n(?:(?!\n==).)*+", "")
    return strip(F.regexp_replace(F.regexp_replace(t, _EXTRACT_HEADING, "$1"), r"\n{3,}", "\n\n"))


def paragraphs(text: Column, shortest: int = 50) -> Column:
    """Stripped parts between blank lines that have at least `shortest` characters."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n\n"), strip), lambda p: F.length(p) >= shortest)


def chunks(text: Column, size: int = 6000, overlap: int = 200) -> Column:
    """Windows of `size` characters that share `overlap` with the next; a short text is one window."""
    n, step = F.length(text), size - overlap
    count = F.when(n <= size, F.lit(1)).otherwise(F.ceil((n - size) / step).cast("int") + 1)
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(text, i * step + 1, F.lit(size)))


def chunks_at_paragraphs(text: Column, size: int = 6000, overlap: int = 200) -> Column:
    """Windows of at most `size` characters that end before the last blank line inside them, if one follows their start.

    A window begins `overlap` characters before the end of the last one, and always after its begin.
    """

    def windows(t: Column) -> Column:
        n = F.length(t)
        step = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("done"))

        def advance(state: Column) -> Column:
            at = state["at"]
            # the last pair of line feeds within the window, found from its end
            back = F.instr(F.reverse(F.substring(t, at + 1, F.lit(size))), "\n\n")
            cut = at + size - 1 - back
            end = F.when((back > 0) & (cut > at), cut).otherwise(at + size)
            to = lambda e: F.struct(F.greatest(at + 1, e - overlap).alias("at"), F.concat(state["done"], F.array(F.struct(at.alias("begin"), e.cast("int").alias("end")))).alias("done"))
            return F.transform(F.array(end), to)[0]

        # a window advances by a character at least; blocks of steps are left out once the end is reached, so that long texts cost their windows
        some = F.sequence(F.lit(0), F.ceil(F.sqrt(F.greatest(F.lit(0), n - size))).cast("int"))
        further = lambda state, f: F.when(state["at"] + size < n, f(state)).otherwise(state)
        walked = F.aggregate(some, step, lambda outer, _: further(outer, lambda state: F.aggregate(some, state, lambda inner, _: further(inner, advance))))
        parts = lambda s: F.concat(F.transform(s["done"], lambda w: F.substring(t, w["begin"] + 1, w["end"] - w["begin"])), F.array(F.substring(t, s["at"] + 1, n)))
        return F.transform(F.array(walked), parts)[0]

    return F.transform(F.array(F.coalesce(text, F.lit(""))), windows)[0]


def merge_chunks(order: Column, text: Column) -> Column:
    """Aggregate: cleaned windows of a text joined by blank lines, in order."""
    rows = F.array_sort(F.collect_list(F.struct(order.alias("i"), text.alias("t"))))
    return strip(F.array_join(rows["t"], "\n\n"))


def path_facts(path: Column) -> dict[str, Column]:
    """split_name, format and compression that a file's path names."""
    split = F.regexp_extract(path, r"(?:^|/)(?:split_name=)?(train|validation|test)(?=/|$)", 1)
    kind = F.regexp_extract(path, r"(parquet|jsonl\.gz|txt\.gz|[^./]*)$", 1)
    packed = F.when(path.endswith(".parquet"), "zstd").when(path.endswith(".gz"), "gzip").otherwise("none")
    return {"split_name": F.when(split == "", "unknown").otherwise(split), "format": kind, "compression": packed}


def vocab_size(name: Column) -> Column:
    """32000 from a name with 32k."""
    return F.regexp_extract(name, r"(\d+)k", 1).try_cast("int") * 1000
