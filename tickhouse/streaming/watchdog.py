"""A live idle watchdog: tells that a component is silent while nothing arrives.

The state of a component is the start of its process and its last data frame. A processing-time timer
stands at that time plus the idle limit; each data frame moves it on. Spark runs a micro-batch at every
trigger while timers may be due, so the timer fires without any input. It fires once; the next frame or
the next start of the process arms it again.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STARTED, DATA = "started", "data"
IDLE = "component string, started_us bigint, last_us bigint, idle_us bigint"


class IdleWatch(StatefulProcessor):
    def __init__(self, idle_seconds: int):
        self.idle = idle_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "started bigint, last bigint, armed bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        started, last, armed = self.seen.get() if self.seen.exists() else (None, None, None)
        for chunk in rows:
            for kind, newest in chunk.groupby("kind")["at_us"].max().items():
                if kind == STARTED:
                    started = max(int(newest), started if started is not None else int(newest))
                else:
                    last = max(int(newest), last if last is not None else int(newest))
        if started is not None and last is not None and last < started:
            last = None  # frames of an earlier process
        due = (last if last is not None else started) + self.idle
        if due != armed:
            if armed is not None:
                self.handle.deleteTimer(self._millis(armed))
            self.handle.registerTimer(self._millis(due))
        self.seen.update((started, last, due))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        started, last, armed = self.seen.get()
        if armed is not None and expiredTimerInfo.getExpiryTimeInMs() == self._millis(armed):
            yield pd.DataFrame({
                "component": [key[0]], "started_us": pd.array([started], "Int64"),
                "last_us": pd.array([last], "Int64"), "idle_us": [armed]})

    @staticmethod
    def _millis(micros: int) -> int:
        return -(-micros // 1000)

    def close(self) -> None:
        pass


def stream_idle(activity: DataFrame, idle_seconds: int = 600) -> DataFrame:
    """A row whenever a component has sent no data frame for ``idle_seconds``; 0 disables the watch.

    ``activity`` streams ``component, at, kind``; ``started`` is the start of a process (the baseline
    until its first data frame), ``data`` a frame; other kinds, such as keep-alives, do not count. The
    row has ``started_at``, ``last_message_at`` (null before any frame) and ``idle_at``, when the limit was reached.
    """
    counted = activity.where(F.col("kind").isin(STARTED, DATA)).select(
        "component", "kind", F.unix_micros("at").alias("at_us"))
    if idle_seconds <= 0:
        nothing = F.lit(None).cast("timestamp")
        return counted.where(F.lit(False)).select("component", *[
            nothing.alias(n) for n in ("started_at", "last_message_at", "idle_at")])
    found = counted.groupBy("component").transformWithStateInPandas(
        IdleWatch(idle_seconds), IDLE, "Append", "ProcessingTime")
    return found.select("component", *[
        F.timestamp_micros(us).alias(name) for us, name in (
            ("started_us", "started_at"), ("last_us", "last_message_at"), ("idle_us", "idle_at"))])
