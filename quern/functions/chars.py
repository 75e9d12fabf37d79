"""Character classes and counts by code point, in Java regex syntax that RE2 reads as well."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Unicode defines it for splitting words, with and without the line feed.
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE_IN_LINE = r"\t\x0b-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Decimal digits, superscripts, subscripts and circled digits.
DIGIT = r"\p{Nd}\x{b2}\x{b3}\x{b9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}\x{2460}-\x{2468}"
LATIN = "A-Za-z"
#: The characters of SPACE.
SPACES = "".join(map(chr, [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Line ends that split lines.
LINE_END = r"\r\n|[\n\x0b\f\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"


@dataclass(frozen=True)
class Script:
    """A writing system: its name and the inside of a character class."""

    name: str
    inside: str


DEVANAGARI = Script("Devanagari", r"\x{0900}-\x{097F}")
LATIN_SCRIPT = Script("Latin", r"A-Za-z\x{C0}-\x{24F}")


#: A word: ASCII first, as a negated class is tested range by range for every character.
WORD = f"[!-~]++[^{SPACE}]*+|[^{SPACE}]++"


def count_of(text: Column, inside: str, rare: bool = False) -> Column:
    """Characters of text in the class. Long matches are cheap, so what is removed is the class unless it is rare."""
    if rare:
        return F.length(F.regexp_replace(text, f"[^{inside}]+", ""))
    return F.length(text) - F.length(F.regexp_replace(text, f"[{inside}]+", ""))


def _share(count: Column, total: Column) -> Column:
    return F.coalesce(count / F.nullif(total, F.lit(0)), F.lit(0.0))


def script_ratio(text: Column, script: Script, of_visible: bool = False) -> Column:
    """Share of the script's characters in all characters, or in those that are not white space; 0 without any."""
    t = F.coalesce(text, F.lit(""))
    total = F.length(F.regexp_replace(t, f"[{SPACE}]+", "")) if of_visible else F.length(t)
    return _share(count_of(t, script.inside), total)


def char_ratios(text: Column, script: Script) -> dict[str, Column]:
    """script_ratio, latin_ratio, digit_ratio and symbol_ratio (neither letter, number, script nor white space)."""
    t = F.coalesce(text, F.lit(""))
    total = F.length(t)
    return {
        "script_ratio": script_ratio(t, script),
        "latin_ratio": _share(count_of(t, LATIN), total),
        "digit_ratio": _share(count_of(t, DIGIT, rare=True), total),
        "symbol_ratio": _share(F.length(F.regexp_replace(t, rf"[\p{{L}}\p{{N}}{script.inside}{SPACE}]+", "")), total),
    }


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD))


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def counts(text: Column, chars_per_token: float = 4.5) -> dict[str, Column]:
    """char_count, word_count and estimated_token_count (at least 1)."""
    n = F.length(F.coalesce(text, F.lit("")))
    return {
        "char_count": n.cast("long"),
        "word_count": word_count(text).cast("long"),
        "estimated_token_count": F.greatest(F.lit(1), (n / chars_per_token).cast("int")).cast("long"),
    }


def quality_score(ratio: Column, chars: Column, script_weight: float = 0.7, length_weight: float = 0.3, full_length: int = 1000) -> Column:
    """Weighted script share and length, to four places."""
    return F.round(script_weight * ratio + length_weight * F.least(F.lit(1.0), chars / full_length), 4)


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(text, F.lit(SPACES))


def mostly_latin(text: Column, threshold: float = 0.7) -> Column:
    """Whether ASCII letters reach the threshold among all letters; false without letters."""
    letters = count_of(text, r"\p{L}")
    return (letters > 0) & (count_of(text, LATIN) >= threshold * letters)
