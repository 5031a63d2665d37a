"""Stall tracking on a live heartbeat stream, in event-time order and with an expiry.

The batch form (``operators.loader.track_health``) handles histories. Here the state of a key (one loader
process: previous offsets, start of the lag, last progress, previous state) lives in Spark's state
store. Heartbeats wait in the state until the watermark has passed them and are taken in the order of
their times then, so it does not matter in which trigger, or in which order, they arrived. A process that
has been silent for ``expire_seconds`` of event time loses its state.

A heartbeat that arrives after the watermark has passed it is dropped by Spark and counted in the query's
progress; ``delay`` is how late one may be. The newest heartbeats wait for the watermark.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickhouse.streaming.run import ROCKSDB

STATE_STORE = ROCKSDB
WAITING = (
    "at_us bigint, seq bigint, lag bigint, offsets string, committing boolean, buffered_bars bigint, "
    "buffered_sources bigint"
)
REMEMBERED = "offsets string, lag_since bigint, progress_at bigint, state string, last_at bigint"
TRACKED = (
    "topic string, process_id string, at_us bigint, seq bigint, lag_records bigint, progressed boolean, "
    "lag_since_us bigint, progress_us bigint, state string, stall_reported boolean"
)
FIELDS = [field.split()[0] for field in WAITING.split(", ")]


def state_of(sample: dict[str, Any], waiting_since: int | None, stall: int) -> str:
    if sample["offsets"] == "{}":
        return "starting"
    if sample["committing"]:
        return "committing"
    if sample["lag"] > 0 and waiting_since is not None and sample["at_us"] - waiting_since >= stall:
        return "stalled"
    if sample["lag"] > sample["buffered_sources"]:
        return "catching_up"
    return "buffering" if sample["buffered_bars"] > 0 or sample["buffered_sources"] > 0 else "idle"


class HealthTracker(StatefulProcessor):
    def __init__(self, stall_seconds: int = 900, expire_seconds: int = 86_400):
        self.stall, self.expire = stall_seconds * 1_000_000, expire_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.memory = handle.getValueState("health", REMEMBERED)
        self.waiting = handle.getListState("waiting", WAITING)
        self.armed = handle.getValueState("armed", "at bigint")

    def _arm(self, micros: int) -> None:
        """One timer per key: at the earliest waiting heartbeat, or at the expiry of the state."""
        millis = -(-micros // 1000)
        if self.armed.exists():
            self.handle.deleteTimer(self.armed.get()[0])
        self.handle.registerTimer(millis)
        self.armed.update((millis,))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        earliest = None
        for chunk in rows:
            self.waiting.appendList([tuple(r) for r in chunk[FIELDS].astype(object).itertuples(index=False)])
            first = int(chunk["at_us"].min())
            earliest = first if earliest is None else min(first, earliest)
        due = None if self._is_expiry() or not self.armed.exists() else self.armed.get()[0]
        if earliest is not None and (due is None or -(-earliest // 1000) < due):
            self._arm(earliest)
        return iter(())

    def _is_expiry(self) -> bool:
        """Whether the timer that stands is that of the state's expiry."""
        if not self.armed.exists() or not self.memory.exists():
            return False
        return self.armed.get()[0] == -(-(self.memory.get()[4] + self.expire) // 1000)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        if not self.armed.exists() or expiredTimerInfo.getExpiryTimeInMs() != self.armed.get()[0]:
            return
        self.armed.clear()
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held = sorted((dict(zip(FIELDS, r, strict=True)) for r in self.waiting.get()),
                      key=lambda s: (s["at_us"], s["seq"]))
        ready = [s for s in held if s["at_us"] <= passed]
        rest = held[len(ready):]
        if ready:
            yield self._track(key, ready)
            self.waiting.clear()
            if rest:
                self.waiting.put([tuple(s[f] for f in FIELDS) for s in rest])
        if rest:
            self._arm(rest[0]["at_us"])
        elif self.memory.exists():
            expiry = self.memory.get()[4] + self.expire
            if expiry <= passed:
                self.memory.clear()
            else:
                self._arm(expiry)

    def _track(self, key: Any, samples: list[dict[str, Any]]) -> pd.DataFrame:
        known = self.memory.get() if self.memory.exists() else ("{}", None, None, None, None)
        offsets, lag_since, progress_at, state, last_at = json.loads(known[0]), *known[1:]
        out = []
        for sample in samples:
            if last_at is not None and sample["at_us"] - last_at >= self.expire:
                offsets, lag_since, progress_at, state = {}, None, None, None
            last_at = sample["at_us"]
            now = json.loads(sample["offsets"])
            progressed = any(part in offsets and committed > offsets[part] for part, committed in now.items())
            lag_since = None if sample["lag"] == 0 else sample["at_us"] if lag_since is None else lag_since
            if sample["lag"] == 0 or progressed:
                progress_at = sample["at_us"]
            boundary = max((t for t in (lag_since, progress_at) if t is not None), default=None)
            previous, state = state, state_of(sample, boundary, self.stall)
            offsets = now
            out.append((key[0], key[1], sample["at_us"], sample["seq"], sample["lag"], progressed, lag_since,
                        progress_at, state, state == "stalled" and previous != "stalled"))
        self.memory.update((json.dumps(offsets), lag_since, progress_at, state, last_at))
        table = pd.DataFrame(out, columns=[field.split()[0] for field in TRACKED.split(", ")])
        return table.astype({"lag_since_us": "Int64", "progress_us": "Int64"})

    def close(self) -> None:
        pass


def stream_health(
    samples: DataFrame, stall_seconds: int = 900, delay: str = "2 minutes", expire_seconds: int = 86_400
) -> DataFrame:
    """State and one-time stall reports per heartbeat; needs the RocksDB state store."""
    parts = F.col("partitions")
    lag = F.aggregate(parts, F.lit(0).cast("long"), lambda acc, p: acc + F.greatest(
        p["end_offset"] - p["committed_offset"], F.lit(0)).cast("long"))
    offsets = F.to_json(F.map_from_entries(F.transform(
        parts, lambda p: F.struct(p["part_id"].cast("string"), p["committed_offset"].cast("long")))))
    narrow = samples.withWatermark("at", delay).select(
        "topic", "process_id", "at", F.unix_micros("at").alias("at_us"), F.col("seq").cast("long").alias("seq"),
        F.coalesce(lag, F.lit(0)).alias("lag"), F.coalesce(offsets, F.lit("{}")).alias("offsets"), "committing",
        F.col("buffered_bars").cast("long").alias("buffered_bars"),
        F.col("buffered_source_records").cast("long").alias("buffered_sources"))
    tracked = narrow.groupBy("topic", "process_id").transformWithStateInPandas(
        HealthTracker(stall_seconds, expire_seconds), TRACKED, "Append", "EventTime")
    return tracked.select(
        "topic", "process_id", F.timestamp_micros("at_us").alias("at"), "seq", "lag_records", "progressed",
        F.timestamp_micros("lag_since_us").alias("positive_lag_since"),
        F.timestamp_micros("progress_us").alias("last_progress_at"), "state", "stall_reported")
