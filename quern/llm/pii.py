"""Format-preserving Feistel pseudonyms for private values in texts, by SQL functions alone.

Found and, where a format has rules, validated: e-mail addresses (local part), IPv4 addresses, payment
cards (Luhn), IBANs (mod 97), social security numbers, calendar dates, phone numbers, access keys and
passwords. Each is mapped by a keyed Feistel network to another valid value of the same format: a
permutation, so equal values get equal pseudonyms in all documents and different values different ones.

- Strings: characters keep their class and place; each round shifts one half by a keyed hash of the
  other. Classes are digits, small and capital letters and, in secrets, symbols; other letters, marks
  and numbers move among those of their category within 64 neighbouring code points, so that every
  script stays itself. Check digits are made anew. Secrets and local parts have any length. A secret in quotes is all
  that they hold; one without ends before white space or a quote.
- Numbers: a pair (l, r) in Z_a x Z_b, one shifted by a keyed hash of the other in turn: addresses
  2^16 x 2^16; dates 189 x 773, the days of a 400-year cycle (1800 to 2199), so that each is a date;
  days after the 12th, which alone are written dd/mm/yyyy, 9 x 9833, so that they stay such days;
  social security numbers (898 x 99) x 9999 over the valid ones; phones of the North American plan
  80000 x 80000 over area and exchange codes from 200.

The hash is HMAC-SHA-512 under a key that the caller gives; an empty key is refused. `session_key`
takes it from the session's setting `spark.quern.pii.key` and draws one for the session where none is
set, so that no key is known to all; values of different runs are linked only under a key that is kept.
The key is part of the query plan, as any literal: guard plans and event logs as the key.

All in one row: matches are taken out as an array, mapped by higher-order functions, and put back
between the pieces of the text. Null texts stay null, texts without matches stay as they are, repeated
rows are mapped alike, an empty table stays empty, texts of any length are mapped whole. Columns of df
that are named like the list of kinds are replaced, all others pass. Numbers that fail validation are
left alone. Not looked for: bearer and JWT tokens, keys of other makers than named above, IPv6, ten digits without
separators, national phone numbers without `+`, dates in words or outside 1800 to 2199. A permutation may map a value to itself (one of a single letter does so once in 26 keys):
such a value is not listed among the kinds.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import fresh

ROUNDS = 8

# The lengths of IBANs and the countries that have them (ISO 13616).
IBANS = {
    15: "NO", 16: "BE", 18: "DK FK FO FI GL NL SD", 19: "MK SI", 20: "AT BA EE KZ XK LT LU MN", 21: "HR LV LI CH", 22: "BH BG CR GE DE IE ME RS GB VA", 23: "GI IQ IL OM SO TL AE",
    24: "AD CZ MD PK RO SA SK ES SE TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MR MC SM", 28: "AL AZ BY CY DO SV GT HN HU LB NI PL", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _iban(length: int, lands: str) -> str:
    """The pattern of whole IBANs of these countries, in groups of four or without spaces."""
    groups, rest = divmod(length - 4, 4)
    return f"(?:{lands.replace(' ', '|')})\\d{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}" + (f" ?[A-Z0-9]{{{rest}}}" if rest else "") + "(?![A-Za-z0-9])"


# What follows the name of a secret, with any white space and one line break on each side of the sign. In quotes it runs to the
# closing quote of the line (after `:` from 4 characters on). Else it ends before white space or a quote: after `=` any value, after `:`
# one of 8 characters or of 4 with a digit or symbol, as prose has colons too (the latter only behind a line break). One closing sign
# at its end is the sentence's, and brackets are; two signs and more are its own.
_GAP = r"[ \t]*+(?:\r?\n[ \t]*+)?+"
_NAME = r"(?i:password|passwd|passphrase|passcode|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?" + _GAP
_OPEN, _END, _SIGNS = _GAP + r"[\"']?", r"[^\s\"'.,;:!?)\]}>]", r"[.,;:!?]{2,}+(?=[\s\"']|$)"
_LAST = rf"(?:{_END}|{_SIGNS})"
_ODD = r"(?=[^\s\"']{0,7}[0-9#$%&*+/=@^|~_-])[^\s\"']{3,}" + _LAST
_QUOTED = r"(?:\"[^\"\r\n]{%d,}+(?=\"|$)|'[^'\r\n]{%d,}+(?='|$))"
SECRET = rf"{_NAME}(?:=(?:{_GAP}{_QUOTED % (1, 1)}|{_OPEN}[^\s\"']*{_LAST})|:(?:{_GAP}{_QUOTED % (4, 4)}|[ \t]*+[\"']?(?:[^\s\"']{{7,}}{_LAST}|{_ODD})|{_OPEN}{_ODD}))"
# The formats, tried in this order.
PATTERNS = {
    "email": r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]++@(?:[\p{L}\p{M}\p{N}-]{1,63}\.){1,126}[\p{L}\p{M}]{2,63}(?![\p{L}\p{M}\p{N}-])",
    "secret": SECRET,
    "key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\w]|\.\d)",
    # its country's length first, so that it does not run on into the next word; any length elsewhere
    "iban": r"(?<![A-Za-z0-9])(?=[A-Z]{2}\d{2})(?:" + "|".join(_iban(n, lands) for n, lands in IBANS.items()) + r"|[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))",
    "date": r"(?<![\w.-])(?:(?:1[89]|2[01])\d\d-\d\d-\d\d|\d\d[./]\d\d[./](?:1[89]|2[01])\d\d)(?![\w-]|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w-])(?:\d{13,19}|\d{4}(?: \d{4}){3}|\d{4}(?:-\d{4}){3}|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5})(?![\w-]|\.\d)",
    "nanp": r"(?<![\w+])(?:\+1[ .-]?)?(?:\([2-9]\d\d\) ?|[2-9]\d\d[ .-])[2-9]\d\d[ .-]\d{4}(?!\w|\.\d)",
    "phone": r"(?<![\w+])\+[1-9]\d{0,2}(?:[ .-]?\(?\d{1,4}\)?){2,6}(?!\w|\.\d)",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# The classes within which characters move, and those of symbols in secrets.
ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
SYMBOLS = ("-_", "#$%&*+/=@^|~", ".,;:!?")
#: Categories of other characters that move, and the neighbours among which they do.
CATEGORIES, BLOCK = ("Lu", "Ll", "Lt", "Lm", "Lo", "M", "N"), 64
_DAY0, _DAYS = "1800-01-01", 146_097
#: Days after the 12th in those 400 years, and a factor of their number.
_LATE_DAYS, _LATE_FACTOR = _DAYS - 4800 * 12, 9
KEY_SETTING = "spark.quern.pii.key"


def session_key(spark: SparkSession) -> str:
    """The key of KEY_SETTING; where it is unset, one is drawn and set for the session."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


def _hash(key: str, turn: Column, kind: Column, other: Column) -> Column:
    """HMAC-SHA-512 of turn, kind and the other half, as hexadecimal digits."""
    if not key:
        raise ValueError("a key is needed")
    raw = key.encode()
    raw = (raw if len(raw) <= 128 else hashlib.sha512(raw).digest()).ljust(128, b"\0")
    inner, outer = (F.lit(bytearray(b ^ pad for b in raw)) for pad in (0x36, 0x5C))
    message = F.concat_ws("|", turn.cast("string"), kind, other).cast("binary")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message), 512))), 512)


def _shift(c: Column, symbols: Column, by: Column) -> Column:
    """A character moved within its class."""

    def moved(alphabet: str) -> Column:
        n = len(alphabet)
        return F.substring(F.lit(alphabet), (F.pmod(F.instr(F.lit(alphabet), c) - 1 + by, F.lit(n)) + 1).cast("int"), F.lit(1))

    within = lambda a: (c != "") & (F.instr(F.lit(a), c) > 0)
    out = F.when(within(ALPHABETS[0]), moved(ALPHABETS[0]))
    for alphabet in ALPHABETS[1:]:
        out = out.when(within(alphabet), moved(alphabet))
    for alphabet in SYMBOLS:
        out = out.when(symbols & within(alphabet), moved(alphabet))
    return out.when(F.ascii(c) > 127, _among_neighbours(c, by)).otherwise(c)


def _among_neighbours(c: Column, by: Column) -> Column:
    """A character moved among those of its category in its block of code points; one of no such category stays."""

    def category(x: Column) -> Column:
        out = F.lit(None).cast("string")
        for name in CATEGORIES:
            out = F.when(x.rlike(rf"^\p{{{name}}}"), F.lit(name)).otherwise(out)
        return out

    first = F.floor(F.ascii(c) / BLOCK).cast("long") * BLOCK
    block = F.transform(F.sequence(first, first + BLOCK - 1), lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
    own = _bound(category(c), lambda kind: F.filter(block, lambda x: category(x) == kind))
    return F.coalesce(_bound(own, lambda chars: F.get(chars, F.pmod(F.array_position(chars, c) - 1 + by, F.size(chars)).cast("int"))), c)


def _hashes(hashed: Column, half: Column) -> Column:
    """The hash for the first 64 characters of a half, and hashes of it with counters for what follows."""
    more = F.transform(F.sequence(F.lit(1), ((F.length(half) - 1) / 64).cast("int")), lambda n: F.sha2(F.concat_ws("|", hashed, n.cast("string")), 512))
    return F.when(F.length(half) > 64, F.concat(F.array(hashed), more)).otherwise(F.array(hashed))


def _mixed(half: Column, hashes: Column, symbols: Column) -> Column:
    """Every character of a half moved by two hexadecimal digits of the hashes."""
    by = lambda i: F.conv(F.substring(hashes[F.floor(i / 64).cast("int")], (i % 64 * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("long")
    return F.array_join(F.transform(F.split(half, ""), lambda c, i: _shift(c, symbols, by(i))), "")


def _bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is made once: lambdas make what is not bound anew for every element."""
    return F.transform(F.array(value), f)[0]


def _feistel(x: Column, key: str, turn: Column) -> Column:
    """One round: l of struct x is moved by a hash of r, then they change places; an even number of rounds puts them back."""

    def moved(hashes: Column) -> Column:
        number = F.pmod(x["l"].cast("long") + F.conv(F.substring(hashes[0], 1, 14), 16, 10).cast("long"), x["a"])
        new = F.when(x["a"] > 0, number.cast("string")).otherwise(_mixed(x["l"], hashes, x["kind"] == "secret"))
        return x.withField("l", x["r"]).withField("r", new).withField("a", x["b"]).withField("b", x["a"])

    return _bound(_hash(key, turn, x["kind"], x["r"]), lambda first: _bound(_hashes(first, x["l"]), moved))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, r"\D", "")


def _luhn(s: Column) -> Column:
    """Luhn sum of digits that a check digit (place 0 from the right) will follow."""
    return F.aggregate(
        F.transform(F.split(F.reverse(s), ""), lambda c, i: F.when(i % 2 == 0, F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int") + 1)).otherwise(c.cast("int"))),
        F.lit(0),
        lambda total, v: total + F.coalesce(v, F.lit(0)),
    )


def _check_digit(s: Column) -> Column:
    return F.pmod(10 - _luhn(s) % 10, F.lit(10)).cast("string")


def _mod97(s: Column) -> Column:
    """The remainder of an alphanumeric string with A = 10 to Z = 35."""
    value = lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
    return F.aggregate(F.split(s, ""), F.lit(0), lambda t, c: F.when(c == "", t).otherwise(F.pmod(t * F.when(value(c) > 9, 100).otherwise(10) + value(c), F.lit(97))))


def _fill(layout: Column, core: Column, pattern: str) -> Column:
    """The characters of layout that match the pattern replaced by those of core in turn."""
    other = f"[^{pattern}]"
    nth = lambda i: F.length(F.regexp_replace(F.substring(layout, F.lit(1), (i + 1).cast("int")), other, ""))
    return F.array_join(F.transform(F.split(layout, ""), lambda c, i: F.when(c.rlike(f"^[{pattern}]$"), F.substring(core, nth(i).cast("int"), F.lit(1))).otherwise(c)), "")


def _date(day: Column, month: Column, year: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", year, month, day), "yyyy-MM-dd")


def _parsed_date(m: Column) -> Column:
    """The date of yyyy-mm-dd, dd.mm.yyyy, or mm/dd/yyyy (dd/mm/yyyy if that is none); null if it is none."""
    part = lambda i, n: F.substring(m, i, n)
    iso, dots = m.substr(5, 1) == "-", m.substr(3, 1) == "."
    first, second = _date(part(4, 2), part(1, 2), part(7, 4)), _date(part(1, 2), part(4, 2), part(7, 4))
    same = m.substr(3, 1) == m.substr(6, 1)
    return F.when(iso, _date(part(9, 2), part(6, 2), part(1, 4))).when(dots & same, second).when(same, F.coalesce(first, second))


def _day_first(m: Column) -> Column:
    """Whether a date is written dd/mm/yyyy: with slashes and, as its day is none of a month, not mm/dd/yyyy."""
    part = lambda i, n: F.substring(m, i, n)
    return (m.substr(3, 1) == "/") & _date(part(4, 2), part(1, 2), part(7, 4)).isNull()


def _days_before(months: Column) -> Column:
    """Days after the 12th in that many months from the first day on."""
    return F.datediff(F.add_months(F.lit(_DAY0).cast("date"), months.cast("int")), F.lit(_DAY0).cast("date")) - 12 * months


def _late_rank(day: Column) -> Column:
    """The place of a day among those after the 12th."""
    months = (F.year(day) - 1800) * 12 + F.month(day) - 1
    return (_days_before(months) + F.dayofmonth(day) - 13).cast("long")


def _late_day(rank: Column) -> Column:
    """The day of a place among those after the 12th: its month is near the mean, the last that begins at or before it."""
    guess = F.floor(rank * 4800 / _LATE_DAYS)
    near = F.filter(F.sequence(guess - 3, guess + 3), lambda n: (n >= 0) & (n < 4800))
    month = _bound(near, lambda n: F.array_max(F.filter(n, lambda k: _days_before(k) <= rank)))
    return _bound(month, lambda n: F.date_add(F.add_months(F.lit(_DAY0).cast("date"), n.cast("int")), (rank - _days_before(n) + 12).cast("int")))


def _kind(m: Column) -> Column:
    """The first format that the whole match has."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        out = F.when(m.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def _halves(x: Column) -> Column:
    """struct x (m, kind) with its permuted halves l and r, moduli a and b (0: strings), late (a date dd/mm/yyyy) and valid."""
    m, kind = x["m"], x["kind"]
    d = _digits(m)
    local = F.substring_index(m, "@", 1)
    secret = F.regexp_replace(m, f"^{_NAME}[=:]{_OPEN}", "")
    bban = F.substring(F.regexp_replace(m, " ", ""), F.lit(5), F.lit(40))
    national = F.regexp_replace(m, r"^\+[1-9]\d{0,2}", "")
    core = (
        F.when(kind == "email", local).when(kind == "secret", secret).when(kind == "key", F.substring(m, F.lit(5), F.lit(16)))
        .when(kind == "card", F.substring(d, F.lit(1), F.length(d) - 1)).when(kind == "iban", bban).when(kind == "phone", _digits(national)).otherwise(d)
    )
    octets = F.split(m, r"\.")
    two = lambda i: (octets[i].cast("long") * 256 + octets[i + 1].cast("long")).cast("string")
    late = (kind == "date") & _day_first(m)
    days = F.when(late, _late_rank(_parsed_date(m))).otherwise(F.datediff(_parsed_date(m), F.lit(_DAY0).cast("date")).cast("long"))
    years, rest = (F.when(late, F.lit(x)).otherwise(F.lit(y)).cast("long") for x, y in ((_LATE_FACTOR, 189), (_LATE_DAYS // _LATE_FACTOR, 773)))
    number = lambda i, n: F.substring(d, F.lit(i), F.lit(n)).cast("long")
    area = number(1, 3)
    area_no = F.when(area > 666, area - 2).otherwise(area - 1)
    ten = F.substring(d, F.length(d) - 9, F.lit(10))
    of10 = lambda i, n: F.substring(ten, F.lit(i), F.lit(n)).cast("long")
    half = (F.length(core) / 2).cast("int")

    def pick(strings: Column, **own: Column) -> Column:
        out = strings
        for k, v in own.items():
            out = F.when(kind == k, v).otherwise(out)
        return out

    left = pick(
        F.substring(core, F.lit(1), half), ip=two(0), date=F.floor(days / rest).cast("string"), ssn=(area_no * 99 + number(4, 2) - 1).cast("string"),
        nanp=((of10(1, 3) - 200) * 100 + of10(7, 2)).cast("string"),
    )
    right = pick(
        F.substring(core, half + 1, F.length(core)), ip=two(2), date=(days % rest).cast("string"), ssn=(number(6, 4) - 1).cast("string"),
        nanp=((of10(4, 3) - 200) * 100 + of10(9, 2)).cast("string"),
    )
    zero = F.lit(0).cast("long")
    valid = pick(
        F.lit(True), card=_check_digit(core) == F.substring(d, F.length(d), F.lit(1)), date=_parsed_date(m).isNotNull(),
        iban=_mod97(F.concat(bban, F.substring(m, F.lit(1), F.lit(4)))) == 1, ssn=(area > 0) & (area != 666) & (area < 900) & (number(4, 2) > 0) & (number(6, 4) > 0),
        phone=F.length(core).between(6, 12),
    )
    return F.struct(
        m.alias("m"), kind.alias("kind"), left.alias("l"), right.alias("r"),
        pick(zero, ip=F.lit(1 << 16).cast("long"), date=years, ssn=F.lit(898 * 99).cast("long"), nanp=F.lit(80_000).cast("long")).alias("a"),
        pick(zero, ip=F.lit(1 << 16).cast("long"), date=rest, ssn=F.lit(9999).cast("long"), nanp=F.lit(80_000).cast("long")).alias("b"),
        F.coalesce(late, F.lit(False)).alias("late"), F.coalesce(valid, F.lit(False)).alias("valid"),
    )


def _written(x: Column) -> Column:
    """The pseudonym of a struct whose halves are permuted, in the format of its match."""
    m, kind, core = x["m"], x["kind"], F.concat(x["l"], x["r"])
    left, right = x["l"].cast("long"), x["r"].cast("long")
    pad = lambda n, width: F.lpad(n.cast("string"), width, "0")
    day = F.date_add(F.lit(_DAY0).cast("date"), (left * 773 + right).cast("int"))
    shape = F.when(x["late"], F.date_format(_late_day(left * (_LATE_DAYS // _LATE_FACTOR) + right), "dd/MM/yyyy"))
    shape = shape.when(m.substr(5, 1) == "-", F.date_format(day, "yyyy-MM-dd")).when(m.substr(3, 1) == ".", F.date_format(day, "dd.MM.yyyy")).otherwise(F.date_format(day, "MM/dd/yyyy"))
    area = F.floor(left / 99) + 1
    ssn = F.concat_ws("-", pad(F.when(area >= 666, area + 1).otherwise(area), 3), pad(left % 99 + 1, 2), pad(right + 1, 4))
    ip = F.concat_ws(".", F.floor(left / 256), left % 256, F.floor(right / 256), right % 256)
    ten = F.concat(F.floor(left / 100) + 200, F.floor(right / 100) + 200, pad(left % 100, 2), pad(right % 100, 2))
    country = F.regexp_extract(m, r"^(\+1)", 1)
    nanp = F.concat(country, _fill(F.substring(m, F.length(country) + 1, F.lit(60)), ten, "0-9"))
    code = F.regexp_extract(m, r"^(\+[1-9]\d{0,2})", 1)
    phone = F.concat(code, _fill(F.substring(m, F.length(code) + 1, F.lit(60)), core, "0-9"))
    land = F.substring(m, F.lit(1), F.lit(2))
    check = F.lpad((98 - _mod97(F.concat(core, land, F.lit("00")))).cast("string"), 2, "0")
    iban = F.concat(land, check, _fill(F.substring(m, F.lit(5), F.lit(60)), core, "A-Z0-9"))
    size = F.length(core)
    return (
        F.when(~x["valid"], m).when(kind == "email", F.concat(core, F.substring(m, size + 1, F.length(m)))).when(kind == "secret", F.concat(F.substring(m, F.lit(1), F.length(m) - size), core))
        .when(kind == "key", F.concat(F.substring(m, F.lit(1), F.lit(4)), core)).when(kind == "ip", ip).when(kind == "iban", iban).when(kind == "date", shape).when(kind == "ssn", ssn)
        .when(kind == "card", _fill(m, F.concat(core, _check_digit(core)), "0-9")).when(kind == "nanp", nanp).when(kind == "phone", phone).otherwise(m)
    )


def _staged(column: Column, *steps: Callable[[Column], Column]) -> Column:
    for step in steps:
        column = F.transform(column, step)
    return column


def pseudonyms(matches: Column, key: str) -> Column:
    """An array of structs (kind, value, pseudonym, valid) for an array of matches."""

    turns = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    done = _staged(matches, lambda m: F.struct(m.alias("m"), _kind(m).alias("kind")), _halves, lambda x: F.aggregate(turns, x, lambda y, turn: _feistel(y, key, turn)))
    return F.transform(done, lambda x: F.struct(x["kind"].alias("kind"), x["m"].alias("value"), _written(x).alias("pseudonym"), x["valid"].alias("valid")))


def pseudonymise(df: DataFrame, text: str, key: str, found: str = "pii_kinds") -> DataFrame:
    """df with `text` replaced and, in `found`, the formats of the values that were (an array, in the order of the text)."""
    t = F.col(text)
    # one array element binds the matches, so that they are mapped once
    bound = F.transform(F.array(pseudonyms(F.regexp_extract_all(t, F.lit(ANY), F.lit(0)), key)), lambda done: F.struct(
        F.concat(F.array_join(F.zip_with(F.split(t, ANY, -1), done["pseudonym"], lambda piece, p: F.concat(piece, F.coalesce(p, F.lit("")))), "")).alias("text"),
        F.transform(F.filter(done, lambda x: x["valid"] & (x["pseudonym"] != x["value"])), lambda x: x["kind"]).alias("kinds"),
    ))[0]
    none = F.struct(t.alias("text"), F.array().cast("array<string>").alias("kinds"))
    (both,) = fresh(df, "_pii")
    out = df.withColumn(both, F.when(t.rlike(ANY), bound).otherwise(none))
    kept = [F.col(both)["text"].alias(c) if c == text else F.col(c) for c in df.columns if c != found]
    return out.select(*kept, F.col(both)["kinds"].alias(found))
