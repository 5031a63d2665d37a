"""Deterministic bars: every period crossed with every symbol, on integer cents."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.functions.bars import event_id, trade_count
from tickhouse.functions.times import micros_text
from tickhouse.session import aware

BASE_CENTS = {"AAPL": 17500, "MSFT": 38000}
DEFAULT_SYMBOLS = ("AAPL", "MSFT")


def expand_periods(periods: DataFrame, symbols: Sequence[str] = DEFAULT_SYMBOLS) -> DataFrame:
    """Bars for rows of ``period, event_ts``. The symbol list is exploded inside each row."""
    names = [name.strip() for name in symbols]
    if not names or not all(names):
        raise ValueError("at least one symbol is required, none of them empty")
    listed = F.array(*[
        F.struct(
            F.lit(name).alias("symbol"),
            F.lit(i).cast("long").alias("symbol_index"),
            F.lit(BASE_CENTS.get(name, 10000 + 100 * i) + 10 * i).cast("long").alias("base"),
        )
        for i, name in enumerate(names)
    ])
    rows = periods.select("period", "event_ts", F.inline(listed))
    close = F.col("base") + F.col("period") * 25
    volume = F.lit(1000) + F.col("period") * 10 + F.col("symbol_index")

    def price(cents: Column) -> Column:
        return cents / F.lit(100.0)

    # high + low + close is three closes and no cents left over: the typical price is the close.
    return rows.select(
        "period",
        "symbol_index",
        F.lit("b").alias("bar_type"),
        "symbol",
        price(close - 5).alias("open"),
        price(close + 15).alias("high"),
        price(close - 15).alias("low"),
        price(close).alias("close"),
        volume.alias("volume"),
        micros_text(F.col("event_ts")).alias("event_time_text"),
        trade_count(volume).alias("trade_count"),
        price(close).alias("vwap"),
        "event_ts",
        event_id(F.col("symbol"), F.col("event_ts")).alias("event_id"),
    )


def synthetic_bars(
    spark: SparkSession,
    start: datetime,
    periods: int,
    symbols: Sequence[str] = DEFAULT_SYMBOLS,
    interval: timedelta = timedelta(minutes=1),
) -> DataFrame:
    if periods <= 0:
        raise ValueError("periods must be positive")
    if interval <= timedelta(0):
        raise ValueError("interval must be positive")
    micros = interval // timedelta(microseconds=1)
    first = F.unix_micros(F.lit(aware(start, "start")))
    numbered = spark.range(periods).select(
        F.col("id").alias("period"),
        F.timestamp_micros(first + F.col("id") * micros).alias("event_ts"),
    )
    return expand_periods(numbered, symbols)
