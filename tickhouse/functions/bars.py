"""Identity hashes and derived values of one bar."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickhouse.functions.times import micros_text
from tickhouse.schemas import BAR_COLUMNS


def payload_hash() -> Column:
    """SHA-256 of the ten wire values joined by ``|`` in wire order."""
    return F.sha2(F.concat_ws("|", *[F.col(name).cast("string") for name in BAR_COLUMNS]), 256)


def event_id(symbol: Column, ts: Column) -> Column:
    """SHA-256 of symbol and microsecond UTC text."""
    return F.sha2(F.concat_ws("|", symbol, micros_text(ts)), 256)


def typical_price(high: Column, low: Column, close: Column) -> Column:
    """Mean of high, low and close, taken in decimals and rounded once to two places."""
    total = sum((p.cast("decimal(24,10)") for p in (low, close)), high.cast("decimal(24,10)"))
    return F.round(total / F.lit(3), 2).cast("double")


def trade_count(volume: Column) -> Column:
    return F.greatest(F.lit(1).cast("long"), F.floor(volume / F.lit(100)).cast("long"))


def producer_fault(symbol: Column, ts: Column, volume: Column) -> Column:
    """Why a produced bar is refused, or null when it is fine."""
    return (
        F.when(symbol.isNull() | (symbol == ""), "symbol_required")
        .when(volume.isNull() | (volume < 0), "negative_volume")
        .when(ts.isNull(), "timestamp_required")
    )


def symbol_list(text: Column) -> Column:
    """Comma list to trimmed, non-empty names."""
    return F.filter(F.transform(F.split(text, ","), lambda name: F.trim(name)), lambda name: name != "")


def subscribed(symbol: Column, subscription: str) -> Column:
    """Does the comma list (or ``*``) include the symbol?"""
    names = [name.strip() for name in subscription.split(",") if name.strip()]
    return F.lit(True) if "*" in names else symbol.isin(names)
