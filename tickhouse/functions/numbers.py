"""Defensive numeric reads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickhouse.functions.times import DIGITS

MONEY = "decimal(38,9)"


def count_value(text: Column) -> Column:
    """Non-negative whole number written in digits, else null."""
    value = text.cast("string")
    return F.when(value.rlike(DIGITS), value.try_cast("long"))


def whole_number(text: Column) -> Column:
    """Bigint from a number text without a fractional part (``5`` or ``5.0``), else null."""
    plain = F.regexp_replace(text, r"\.0+$", "")
    return F.coalesce(text.try_cast("long"), plain.try_cast("long"))


def money(text: Column) -> Column:
    """Finite amount at two decimals (half-even on the decimal text), else null."""
    return F.bround(F.trim(text.cast("string")).try_cast(MONEY), 2).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Mean at two decimals; null when either side is missing or the denominator is zero."""
    return F.round(F.try_divide(numerator.cast("double"), denominator.cast("double")), 2)


def queue_depth(capacity: Column, free: Column) -> Column:
    return F.greatest(capacity - free, F.lit(0).cast("long"))
