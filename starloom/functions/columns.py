"""Column expressions shared by the loaders, marts and checks. All stay inside code generation."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Attribute separator, NULL marker and unknown key of the change fingerprint / star.
HASH_SEPARATOR = "|"
HASH_NULL = "~NULL~"
UNKNOWN_KEY = -1
OPEN_END = "9999-12-31 00:00:00"

MONEY = "decimal(19,4)"
AMOUNT = "decimal(21,4)"
RATIO = "decimal(5,4)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scd_hash(*attributes: Column | str) -> Column:
    """md5 over the attributes as text; a NULL keeps its position through a marker."""
    texts = [F.coalesce(_col(a).cast("string"), F.lit(HASH_NULL)) for a in attributes]
    return F.md5(F.concat_ws(HASH_SEPARATOR, *texts))


def date_key(day: Column | str) -> Column:
    """Calendar day -> yyyymmdd integer, NULL -> the unknown key."""
    d = _col(day)
    return F.coalesce(F.year(d) * 10000 + F.month(d) * 100 + F.day(d), F.lit(UNKNOWN_KEY))


def instant(text: str) -> Column:
    """Literal instant. Instants are kept without a zone and mean UTC."""
    return F.to_timestamp_ntz(F.lit(text))


def month_keys(year: int, month: int) -> tuple[int, int]:
    """First day key of a month and of the month after it."""
    following = (year + 1, 1) if month == 12 else (year, month + 1)
    return year * 10000 + month * 100 + 1, following[0] * 10000 + following[1] * 100 + 1


def in_month(key: Column | str, year: int, month: int) -> Column:
    """Half-open range on the bare date key, so the predicate reaches the file statistics."""
    first, after = month_keys(year, month)
    return (_col(key) >= first) & (_col(key) < after)


def in_days(moment: Column | str, first: date, after: date) -> Column:
    """Half-open range of a timestamp column without wrapping the column in a function."""
    c = _col(moment)
    return (c >= F.to_timestamp_ntz(F.lit(f"{first} 00:00:00"))) & (
        c < F.to_timestamp_ntz(F.lit(f"{after} 00:00:00"))
    )


def like_class(text: Column | str, pattern: str) -> Column:
    """Case-insensitive LIKE that also knows `[abc]`, `[a-f]` and `[^abc]` character classes."""
    pieces = []
    for token in re.findall(r"\[\^?[^\]]+\]|.", pattern, flags=re.S):
        if token == "%":
            pieces.append(".*")
        elif token == "_":
            pieces.append(".")
        elif len(token) > 2 and token[0] == "[":
            pieces.append(token.replace("\\", "\\\\").replace("&&", "&\\&"))
        else:
            pieces.append(re.escape(token))
    return _col(text).rlike("(?is)^" + "".join(pieces) + "$")


def differs(left: list[Column], right: list[Column]) -> Column:
    """NULL-safe inequality of two rows of columns."""
    return ~F.struct(*left).eqNullSafe(F.struct(*right))


def percent(part: Column, whole: Column) -> Column:
    """part / whole in percent at two places, NULL when the whole is zero."""
    top = (part * 100).cast("decimal(28,4)")
    return F.round(top / F.nullif(whole.cast("decimal(28,4)"), F.lit(0)), 2).cast("decimal(9,2)")


def mean_money(total: Column, n: Column, places: int = 2) -> Column:
    """total / n at the given places, NULL when n is zero."""
    quotient = total.cast("decimal(25,4)") / F.nullif(n.cast("decimal(12,0)"), F.lit(0))
    return F.round(quotient, places).cast(f"decimal(19,{places})")


def safe_ratio_4(top: Column, bottom: Column) -> Column:
    """Exact half-up quotient of two positive amounts at four places."""
    return F.round(
        top.cast("decimal(22,4)") / F.nullif(bottom.cast("decimal(22,4)"), F.lit(0)), 4
    )


def extended_price(unit_price: Column, quantity: Column, discount: Column) -> Column:
    return (unit_price * quantity * (1 - discount)).cast(AMOUNT)


def money(c: Column | str) -> Column:
    return _col(c).cast(MONEY)


def fixed_text(amount: Column) -> Column:
    """Amount as text with two places, for comparing figures across layers."""
    return F.round(amount, 2).cast("decimal(38,2)").cast("string")


def normalise_us_date(text: Column | str) -> Column:
    """`M/D/YYYY[ time]` -> ISO; ISO, blank and unrecognised text pass through (trimmed)."""
    v = F.trim(_col(text))
    day = F.substring_index(v, " ", 1)
    bits = F.split(day, "/")
    clock = F.regexp_extract(v, r"^\S+ (.*)$", 1)
    year, month, number = (F.get(bits, i).try_cast("bigint") for i in (2, 0, 1))
    iso = F.format_string("%04d-%02d-%02d", year, month, number)
    is_us = day.rlike(r"^\d+/\d+/\d+$")
    return F.when(is_us, F.trim(F.concat(iso, F.lit(" "), clock))).otherwise(v)


def clean_literal(text: Column | str, was_quoted: Column | bool, is_date: bool = False) -> Column:
    """Raw literal -> value: bare NULL and bare 0x blobs become NULL, dates are normalised."""
    v = F.trim(_col(text))
    quoted = F.lit(was_quoted) if isinstance(was_quoted, bool) else was_quoted
    empty = ~quoted & ((F.upper(v) == "NULL") | F.lower(v).startswith("0x"))
    return F.when(~empty, normalise_us_date(v) if is_date else v)
