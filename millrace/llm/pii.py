"""Format-preserving pseudonyms for personal numbers, dates and addresses; built-in functions only.

One pattern finds candidates, ``split`` gives the text between them, and each validated candidate is
replaced by a keyed permutation within its own format. Equal values get equal pseudonyms in every
document, different values of one format different ones, without any join or lookup table: the
operator is one narrow projection.

| kind | validated by | permuted |
| --- | --- | --- |
| card | 13 to 19 digits, in fours or not, check digit right | all digits but the last, which is computed anew |
| date | a day from 1900 to 2099 as y-m-d, y/m/d, d.m.y or d/m/y | the day's number |
| ip | four numbers up to 255 | the 32-bit address |
| phone | +country or (area) forms | all digits after a leading +1, or after + |
| ssn | ddd-dd-dddd, no group of zeros | all digits |
| email | local part, host with a dot | letters and digits of the local part, each within its class |
| secret | 32 hex digits or more, a letter among them | digits and letters a to f, each within its class |

The permutation is a Feistel network of eight rounds. Over strings, even and odd places take turns:
each place moves by keyed SHA-512 output that depends on all places of the other half, modulo the
size of its class. Days and addresses split into two numbers of fixed ranges (17 x 4297 days are
exactly 1900 to 2099) that take turns in the same way, so nothing falls outside and no walking is needed.

Null texts stay null with no values; texts without candidates are returned as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
FIRST_DAY = "1900-01-01"
DAY_PARTS = (17, 4297)
KINDS = ("card", "date", "ip", "phone", "ssn", "email", "secret")

# Candidates in the order they are tried at a place.
CANDIDATE = "|".join([
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){1,8}",
    r"(?<![A-Za-z0-9])[0-9a-f]{32,}+(?![A-Za-z0-9])",
    r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)",
    r"(?<![\d-])\d{4}-\d\d-\d\d(?![\d-])",
    r"(?<![\d/])\d{4}/\d\d/\d\d(?![\d/])",
    r"(?<![\d.])\d\d\.\d\d\.\d{4}(?!\d)",
    r"(?<![\d/])\d\d/\d\d/\d{4}(?![\d/])",
    r"(?<![\d-])\d{3}-\d\d-\d{4}(?![\d-])",
    r"(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)",
    r"(?<![\d(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)",
    r"(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])",
    r"(?<!\d)\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}(?!\d)",
    r"(?<!\d)\d{13,19}(?!\d)",
])


def _bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _digest(key: str, kind: str, turn: Column, other: Column) -> Column:
    inner = F.sha2(F.concat(F.lit(f"{key}|{kind}|"), turn.cast("string"), F.lit("|"), other), 512)
    return F.sha2(F.concat(F.lit(f"{key}|"), inner), 512)


def _number(digest: Column, at: Column | int, hexes: int) -> Column:
    return F.conv(F.substring(digest, at, hexes), 16, 10).cast("bigint")


def permuted_codes(codes: Column, sizes: Column, key: str, kind: str) -> Column:
    """Keyed permutation of an array of numbers, each below the size at its place."""

    def step(v: Column, turn: Column) -> Column:
        other = F.array_join(F.transform(F.filter(v, lambda _, j: j % 2 != turn % 2), lambda y: y.cast("string")), ",")
        moved = lambda d: F.transform(
            v, lambda x, i: F.when(
                i % 2 == turn % 2, F.pmod(x + _number(d, F.pmod(F.floor(i / 2), F.lit(32)).cast("int") * 4 + 1, 4), F.element_at(sizes, i + 1))
            ).otherwise(x)
        )
        return _bound(_digest(key, kind, turn, other), moved)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), codes, step)


def permuted_pair(a: Column, b: Column, sizes: tuple[int, int], key: str, kind: str) -> Column:
    """Keyed permutation of ``array(a, b)`` with ``a < sizes[0]`` and ``b < sizes[1]``."""

    def step(v: Column, turn: Column) -> Column:
        move = lambda k: F.pmod(v[k] + _number(_digest(key, kind, turn, v[1 - k].cast("string")), 1, 12), F.lit(sizes[k]))
        return F.when(turn % 2 == 0, F.array(move(0), v[1])).otherwise(F.array(v[0], move(1)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.array(a.cast("bigint"), b.cast("bigint")), step)


def _chars(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def permuted_text(value: Column, key: str, kind: str, letters: int = 26) -> Column:
    """Digits stay digits, small letters small letters (of the first ``letters``), capitals capitals."""
    chars = _chars(value)
    low = lambda c: F.when(c.rlike("[0-9]"), 48).when(c.rlike("[a-z]"), 97).when(c.rlike("[A-Z]"), 65)
    plain = F.filter(chars, lambda c: c.rlike("[0-9A-Za-z]"))
    codes = F.transform(plain, lambda c: (F.ascii(c) - low(c)).cast("bigint"))
    sizes = F.transform(plain, lambda c: F.when(c.rlike("[0-9]"), 10).otherwise(letters).cast("bigint"))
    new = _bound(plain, lambda p: _bound(
        permuted_codes(codes, sizes, key, kind), lambda n: F.zip_with(p, n, lambda c, x: F.char(low(c) + x))
    ))
    return _bound(new, lambda n: _threaded(value, n, "[^0-9A-Za-z]"))


def _threaded(value: Column, new: Column, fixed: str) -> Column:
    """``value`` with its characters that aren't ``fixed`` replaced by ``new``, in order."""
    steps = F.aggregate(
        _chars(value), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.when(c.rlike(fixed), F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))).otherwise(
            F.struct(F.concat(s["out"], F.element_at(new, s["at"])).alias("out"), (s["at"] + 1).alias("at"))
        ),
    )
    return steps["out"]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def check_sum(digits: Column) -> Column:
    """The card check sum of a string of digits whose last digit is not doubled."""
    n = F.length(digits)
    at = lambda x, i: F.when((n - i) % 2 == 0, x * 2 - F.when(x > 4, 9).otherwise(0)).otherwise(x)
    return F.aggregate(F.transform(F.transform(_chars(digits), lambda c: c.cast("int")), at), F.lit(0), lambda s, x: s + x)


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    body = permuted_text(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    full = _bound(body, lambda b: F.concat(b, F.pmod(-check_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))
    return _bound(full, lambda d: _threaded(value, _chars(d), "[^0-9]"))


# Shapes of dates and their formats.
DATE_FORMS = {
    r"^\d{4}-\d\d-\d\d$": "yyyy-MM-dd", r"^\d{4}/\d\d/\d\d$": "yyyy/MM/dd",
    r"^\d\d\.\d\d\.\d{4}$": "dd.MM.yyyy", r"^\d\d/\d\d/\d{4}$": "dd/MM/yyyy",
}


def _day(value: Column) -> Column:
    """Days since the first one; null for what is no date of the range."""
    days = F.lit(None).cast("int")
    for shape, form in DATE_FORMS.items():
        days = F.when(value.rlike(shape), F.date_diff(F.try_to_timestamp(value, F.lit(form)).cast("date"), F.lit(FIRST_DAY).cast("date"))).otherwise(days)
    return F.when(days.between(0, DAY_PARTS[0] * DAY_PARTS[1] - 1), days)


def _date(value: Column, key: str) -> Column:
    day = _day(value)
    pair = permuted_pair(day % DAY_PARTS[0], F.floor(day / DAY_PARTS[0]), DAY_PARTS, key, "date")

    def written(p: Column) -> Column:
        date = F.date_add(F.lit(FIRST_DAY).cast("date"), (p[1] * DAY_PARTS[0] + p[0]).cast("int"))
        out = F.lit(None).cast("string")
        for shape, form in DATE_FORMS.items():
            out = F.when(value.rlike(shape), F.date_format(date, form)).otherwise(out)
        return out

    return _bound(pair, written)


def _ip(value: Column, key: str) -> Column:
    octet = lambda k: F.split(value, r"\.")[k].cast("bigint")
    pair = permuted_pair(octet(0) * 256 + octet(1), octet(2) * 256 + octet(3), (65536, 65536), key, "ip")
    return _bound(pair, lambda p: F.concat_ws(".", *[F.floor(p[k] / 256) if half == 0 else p[k] % 256 for k in (0, 1) for half in (0, 1)]))


def kind_of(value: Column) -> Column:
    """The kind of a validated candidate, else null."""
    digits = _digits(value)
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike("^[0-9a-f]{32,}$"), F.when(value.rlike("[a-f]"), "secret"))
        .when(value.rlike(r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$"), F.when(F.forall(F.split(value, r"\."), lambda o: o.cast("int") <= 255), "ip"))
        .when(_day(value).isNotNull(), "date")
        .when(value.rlike(r"^\d{3}-\d\d-\d{4}$"), F.when(~value.rlike("^000|-00-|0000$"), "ssn"))
        .when(value.rlike(r"^[+(]|^\d{3}-\d{3}-\d{4}$"), "phone")
        .when(value.rlike(r"^[0-9 -]+$") & (F.length(digits) >= 13) & (F.length(digits) <= 19), F.when(check_sum(digits) % 10 == 0, "card"))
    )


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a candidate of this kind; what isn't validated stays."""
    head = F.when(value.startswith("+1"), F.lit("+1")).otherwise(F.lit(""))
    return (
        F.when(kind == "card", _card(value, key))
        .when(kind == "date", _date(value, key))
        .when(kind == "ip", _ip(value, key))
        .when(kind == "phone", F.concat(head, permuted_text(F.substring(value, F.length(head) + 1, F.length(value)), key, "phone")))
        .when(kind == "ssn", permuted_text(value, key, "ssn"))
        .when(kind == "email", F.concat(permuted_text(F.substring_index(value, "@", 1), key, "email"), F.lit("@"), F.substring_index(value, "@", -1)))
        .when(kind == "secret", permuted_text(value, key, "secret", 6))
        .otherwise(value)
    )


def pseudonymised(docs: DataFrame, key: str, text_col: str = "text", found_col: str = "pii_values") -> DataFrame:
    """``docs`` with pseudonyms in ``text_col`` and an array ``found_col`` of ``(kind, value)``: the kind
    and the pseudonym of every validated value, in order. A column of that name is replaced."""
    text = F.col(f"`{text_col}`").cast("string")
    maybe = text.rlike("[0-9@]")
    docs = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns if c != found_col],
        F.struct(
            F.when(maybe, F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))).alias("hits"),
            F.when(maybe, F.split(text, CANDIDATE, -1)).alias("pieces"),
        ).alias(found_col),
    )
    hits = F.col(f"`{found_col}`.hits")
    named = F.transform(hits, lambda v: F.struct(kind_of(v).alias("kind"), v.alias("value")))
    named = F.transform(named, lambda s: F.struct(s["kind"].alias("kind"), pseudonym(s["value"], s["kind"], key).alias("value")))
    docs = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns if c != found_col],
        F.struct(F.when(F.size(hits) > 0, named).alias("new"), F.col(f"`{found_col}`.pieces").alias("pieces")).alias(found_col),
    )
    new, pieces = F.col(f"`{found_col}`.new"), F.col(f"`{found_col}`.pieces")
    whole = F.array_join(F.zip_with(pieces, F.array_append(F.transform(new, lambda s: s["value"]), F.lit("")), lambda p, v: F.concat(p, v)), "")
    typed = F.coalesce(F.filter(new, lambda s: s["kind"].isNotNull()), F.array().cast("array<struct<kind:string,value:string>>"))
    return docs.select(
        *[F.when(new.isNotNull(), whole).otherwise(text).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c != found_col],
        typed.alias(found_col),
    )
