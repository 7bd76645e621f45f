"""Scalar expressions: standard forms of keys, time, ratios, sampling buckets, calibration. All of them stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 10_000


def mobile(c: Column) -> Column:
    """The last ten digits; null where there are fewer."""
    digits = F.regexp_replace(c, r"\D", "")
    return F.when(F.length(digits) >= 10, F.right(digits, F.lit(10)))


def handle(c: Column) -> Column:
    return F.lower(F.trim(c))


def code(c: Column) -> Column:
    return F.upper(F.trim(c))


def hashed(c: Column, salt: str) -> Column:
    """Salted SHA-256 in hex; null stays null."""
    return F.sha2(F.concat(F.lit(salt), c), 256)


def masked(c: Column) -> Column:
    """First two and last three digits; null stays null."""
    return F.concat(F.left(c, F.lit(2)), F.lit("xxxxx"), F.right(c, F.lit(3)))


def address(*parts: Column) -> Column:
    """Letters and digits of the parts that are there, in upper case."""
    return F.regexp_replace(F.upper(F.concat_ws(" ", *parts)), "[^A-Z0-9]", "")


def subnet(c: Column) -> Column:
    """The first three numbers of an IPv4 address; empty where it is none."""
    return F.regexp_extract(c, r"^(\d+\.\d+\.\d+)\.", 1)


def instant(c: Column) -> Column:
    """A timestamp with time zone semantics, also from one without."""
    return c.cast("timestamp")


def epoch(c: Column) -> Column:
    return F.unix_seconds(instant(c))


def day_end(day: Column) -> Column:
    """Epoch second of the last second of a date."""
    return F.unix_seconds(F.date_add(day, 1).cast("timestamp")) - 1


def exact_sum(column: str | Column, digits: int, shown: int) -> Column:
    """The sum of numbers of so many digits after the point, rounded to fewer: the same in whatever order they are added."""
    return F.round(F.sum((F.col(column) if isinstance(column, str) else column).cast(f"decimal(28,{digits})")), shown).cast("double")


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom; 0 where bottom is not positive or null."""
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def at_night(ts: Column) -> Column:
    return F.hour(ts).isin(23, 0, 1, 2, 3, 4)


def multiple_of(amount: Column, unit: float) -> Column:
    return amount % F.lit(unit) == 0


def bucket(*parts: Column, buckets: int = BUCKETS) -> Column:
    """A sampling bucket that other engines compute alike: the first 32 bits of MD5 of the parts, apart by `|`."""
    return (F.conv(F.left(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), F.lit(8)), 16, 10).cast("long") % buckets).cast("int")


def odds_ratio(context_rate: float, book_rate: float) -> float:
    for name, rate in (("context_rate", context_rate), ("book_rate", book_rate)):
        if not 0.0 < rate < 1.0:
            raise ValueError(f"{name} must lie between 0 and 1, not {rate}")
    return book_rate / (1 - book_rate) / (context_rate / (1 - context_rate))


def prior_corrected(p: Column, context_rate: float, book_rate: float) -> Column:
    """The probability under the book's rate of one that was learned under the context's."""
    clipped, r = F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)), odds_ratio(context_rate, book_rate)
    return clipped * r / (clipped * r + 1 - clipped)


def differs(left: Column, right: Column) -> Column:
    """Whether two values are distinct, null being a value."""
    return ~left.eqNullSafe(right)
