"""Numeric column expressions that are safe against missing, zero and non-finite input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def finite(x: Column) -> Column:
    """The value, or NULL when it is NaN or infinite."""
    x = x.cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def coerce_numeric(text: Column) -> Column:
    """Text to double, NULL when it is not a number.

    The pattern comes first because a bare cast also takes Java suffixes such as ``1d``.
    """
    return F.when(text.rlike(NUMBER_TEXT), F.regexp_replace(text, r"\s", "").try_cast("double"))


def log10_positive(x: Column) -> Column:
    """log10 of positive finite values, NULL for all others."""
    x = x.cast("double")
    return F.when((x > 0) & (x < F.lit(float("inf"))), F.log10(x))


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, NULL when the quotient is not a finite number."""
    return finite(F.try_divide(a.cast("double"), b.cast("double")))


def flag(predicate: Column) -> Column:
    """A predicate as a flag that is never NULL: a missing value raises no flag."""
    return F.coalesce(predicate, F.lit(False))


def id_hash(*ids: Column) -> Column:
    """The md5 text of a row id, the portable source of every random choice."""
    return F.md5(F.concat_ws("-", *[i.cast("string") for i in ids]))


def hash_percent(*ids: Column) -> Column:
    """A number in 0..99 that depends on the row id alone."""
    return hash_bucket(100, *ids)


def hash_bucket(n: int, *ids: Column) -> Column:
    head = F.substring(id_hash(*ids), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(n)).cast("int")


def hash_rank(*ids: Column) -> Column:
    """The leading 52 bits of the id hash as a double, ordered like the md5 text."""
    return F.conv(F.substring(id_hash(*ids), 1, 13), 16, 10).cast("double")
