"""Read views over the append-only bar table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.session import aware

DELIVERY = ("ingested_at", "topic", "part_id", "src_offset", "pos")


def deduplicated(bars: DataFrame) -> DataFrame:
    """First delivery of every payload with how often it arrived.

    Equal payloads have equal event times, so with ``event_date`` present each day is resolved by
    itself and a filter on it prunes both readings. The aggregate holds hash and delivery only and
    combines map-side; the rows themselves are exchanged once, to meet their first delivery, and a
    payload that fills a third of the table is split there as a skewed join. Rows that agree in
    hash and delivery are one.
    """
    keys = [c for c in ("event_date", "payload_hash") if c in bars.columns]
    firsts = bars.groupBy(*keys).agg(
        F.min(F.struct(*DELIVERY)).alias("_first"), F.count(F.lit(1)).alias("delivery_count")
    )
    same = Window.partitionBy(*keys).orderBy(F.lit(0))
    return (
        bars.join(firsts, keys)
        .filter(F.struct(*DELIVERY).eqNullSafe(F.col("_first")))
        .withColumn("_copy", F.row_number().over(same))
        .filter(F.col("_copy") == 1)
        .drop("_first", "_copy")
    )


def bounded(
    bars: DataFrame,
    start: datetime,
    end: datetime,
    limit: int,
    text_compare: bool = False,
) -> DataFrame:
    """Bars with ``start <= time < end``, by time then symbol, at most ``limit`` rows.

    ``text_compare`` compares the stored text, which orders ``…00.000000Z`` before ``…00Z``.
    """
    if limit <= 0:
        raise ValueError("limit must be positive")
    if text_compare:
        column, bounds = F.col("event_time_text"), [
            F.lit(aware(value).strftime("%Y-%m-%dT%H:%M:%SZ")) for value in (start, end)
        ]
    else:
        column, bounds = F.col("event_ts"), [F.lit(aware(value)) for value in (start, end)]
    return (
        bars.filter((column >= bounds[0]) & (column < bounds[1]))
        .select(
            "symbol", "event_time_text", "open", "high", "low", "close",
            "volume", "trade_count", "vwap", "ingested_at", "payload_hash",
        )
        .orderBy("event_time_text" if text_compare else column, "symbol")
        .limit(limit)
    )


def uniqueness(rows: DataFrame, column: str) -> DataFrame:
    """Row count, distinct values of ``column`` and whether they agree.

    Grouping first makes the distinct count an ordinary two-stage aggregate.
    """
    return (
        rows.groupBy(column)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
            F.count(column).alias("distinct_count"),
        )
        .withColumn("is_unique", F.col("row_count") == F.col("distinct_count"))
    )
