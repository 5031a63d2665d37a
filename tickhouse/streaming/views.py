"""Streaming views: replay-safe bars, cumulative counters, idle sessions."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickhouse.operators.extractor import counter_windows, window_start


def stream_deduplicated(bars: DataFrame, delay: str = "1 day", salts: int = 1) -> DataFrame:
    """One delivery of each payload within the delay; state is bounded by the watermark.

    With ``salts`` above one, copies are first thinned in that many groups per payload, so a
    payload that makes up a large share of the stream never lands on one task whole.
    """
    marked = bars.withWatermark("ingested_at", delay)
    if salts > 1:
        source = [c for c in ("topic", "part_id", "src_offset", "pos") if c in bars.columns]
        salt = F.pmod(F.xxhash64("ingested_at", *source), F.lit(salts))
        marked = marked.withColumn("_salt", salt).dropDuplicatesWithinWatermark(
            ["payload_hash", "_salt"]
        ).drop("_salt")
    return marked.dropDuplicatesWithinWatermark(["payload_hash"])


def stream_sessions(frames: DataFrame, idle_seconds: int = 600, delay: str = "1 minute") -> DataFrame:
    """Closed activity sessions per component: each row is an idle event at ``idle_at``.

    A session closes once nothing arrived for ``idle_seconds``.
    """
    if idle_seconds <= 0:
        raise ValueError("a streaming idle watch needs a positive idle time")
    session = F.session_window("received_at", f"{idle_seconds} seconds")
    return (
        frames.withWatermark("received_at", delay)
        .groupBy("component", session.alias("session"))
        .agg(F.count(F.lit(1)).alias("frames"), F.max("received_at").alias("last_message_at"))
        .select("component", "frames", "last_message_at", F.col("session.end").alias("idle_at"))
    )


KINDS = {
    "messages_received": "received", "messages_sent": "sent", "delivery_failures": "delivery_failure",
    "errors": "error",
}
TIMES = {"last_message_us": "received", "last_delivery_us": "sent"}
TOTALS = ", ".join(f"{name} bigint" for name in (*KINDS, *TIMES))


class RunningTotals(StatefulProcessor):
    """Adds up the closed intervals of a component; they close in the order of their times."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", TOTALS)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        known = self.totals.get() if self.totals.exists() else (0,) * len(KINDS) + (None,) * len(TIMES)
        closed = pd.concat(list(rows)).sort_values("start_us")
        counts = closed[list(KINDS)].cumsum() + np.array(known[:len(KINDS)])
        times = pd.concat([pd.DataFrame([known[len(KINDS):]], columns=list(TIMES)), closed[list(TIMES)]])
        times = times.astype("Int64").ffill().cummax().iloc[1:]
        last = (*counts.iloc[-1].tolist(), *times.iloc[-1].tolist())
        self.totals.update(tuple(None if pd.isna(v) else int(v) for v in last))
        yield pd.concat([closed[["component", "start_us"]].reset_index(drop=True),
                         counts.reset_index(drop=True), times.reset_index(drop=True)], axis=1)

    def close(self) -> None:
        pass


def stream_counters(activity: DataFrame, seconds: int = 60, delay: str = "1 minute") -> DataFrame:
    """Cumulative counters per component at the end of each closed interval that saw activity.

    Two stateful steps: intervals are counted (map-side first, so a busy component is thinned before it
    is exchanged), and when the watermark closes one, its row enters the component's running totals.
    Intervals that the watermark has not closed yet are added by ``final_counters``.
    """
    kind = F.col("kind")
    closed = (
        activity.withWatermark("at", delay)
        .groupBy("component", F.window("at", f"{seconds} seconds").alias("w"))
        .agg(
            *[F.count_if(kind == value).alias(name) for name, value in KINDS.items()],
            *[F.max(F.when(kind == value, F.unix_micros("at"))).alias(name) for name, value in TIMES.items()],
        )
        .select("component", F.unix_micros("w.start").alias("start_us"), *KINDS, *TIMES)
    )
    totals = closed.groupBy("component").transformWithStateInPandas(
        RunningTotals(), f"component string, start_us bigint, {TOTALS}", "Append", "None")
    return totals.select(
        "component", F.timestamp_micros("start_us").alias("window_start"), *KINDS,
        F.timestamp_micros("last_message_us").alias("last_message_at"),
        F.timestamp_micros("last_delivery_us").alias("last_delivery_at"))


def final_counters(emitted: DataFrame, activity: DataFrame, seconds: int = 60) -> DataFrame:
    """Snapshots that a drained stream still owes: the totals of intervals after the last emitted one.

    ``emitted`` is what ``stream_counters`` wrote, ``activity`` the same input as a table. Only activity
    after a component's last emitted interval is counted; the rest comes from that interval's totals.
    """
    last = emitted.groupBy("component").agg(F.max_by(F.struct("*"), "window_start").alias("t")).select(
        "component", *[F.col(f"t.{c}").alias(f"_{c}") for c in emitted.columns if c != "component"])
    tail = activity.join(last.select("component", "_window_start"), "component", "left").where(
        F.col("_window_start").isNull() | (window_start(F.col("at"), seconds) > F.col("_window_start")))
    counted = counter_windows(tail.select(*activity.columns), seconds).join(last, "component", "left")
    return counted.select(
        "component", "window_start",
        *[(F.col(n) + F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in KINDS],
        *[F.coalesce(n, f"_{n}").alias(n) for n in ("last_message_at", "last_delivery_at")])
