"""Live batch cuts: full batches at once, a non-empty rest when it gets too old.

State per partition: the open rest (bars, sources, when it was opened, the offset it may commit) and
where the partition stands. Bars stay in the landed log; a cut names how many of them it takes. Frames of
a trigger are put in offset order; frames below the position were seen before and are left out.

A rest opened at ``t`` is cut by the first frame that arrives at ``t + max_age`` or later or, when
nothing arrives, by a timer. Both give the cut that ``operators.cuts.replay_cuts`` finds in the log.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickhouse.operators.batching import SOURCE, _checked
from tickhouse.operators.cuts import AGE, CUT, OPEN, Frames, cut_times

REST = (
    "batch bigint, bars bigint, sources bigint, commit_offset bigint, opened bigint, filled bigint, "
    "clock bigint, position bigint"
)


class BatchCutter(StatefulProcessor):
    def __init__(self, limit: int, max_age_seconds: int, grace_seconds: float, timers: bool):
        self.limit, self.age = limit, max_age_seconds * 1_000_000
        self.grace, self.timers = int(grace_seconds * 1_000_000), timers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rest = handle.getValueState("rest", REST)

    def _read(self) -> dict[str, Any]:
        names = [field.split()[0] for field in REST.split(", ")]
        values = self.rest.get() if self.rest.exists() else (0, 0, 0, None, None, None, None, 0)
        return dict(zip(names, values, strict=True))

    def _due(self, rest: dict[str, Any]) -> int | None:
        """Milliseconds at which the rest is too old; none without a rest."""
        return -(-(rest["opened"] + self.age + self.grace) // 1000) if self.timers and rest["bars"] else None

    def _write(self, rest: dict[str, Any], before: int | None) -> None:
        due = self._due(rest)
        if before is not None and before != due:
            self.handle.deleteTimer(before)
        if due is not None and before != due:
            self.handle.registerTimer(due)
        self.rest.update(tuple(rest.values()))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        rest = self._read()
        before = self._due(rest)
        came = pd.concat(list(rows)).drop_duplicates("src_offset").sort_values("src_offset")
        came = came[came["src_offset"] >= rest["position"]]
        if len(came):
            rest["position"] = int(came["src_offset"].iloc[-1]) + 1
            came = came[came["frame_size"] > 0]
        if len(came):
            yield from self._cut(key, rest, came)
        self._write(rest, before)

    def _cut(self, key: Any, rest: dict[str, Any], came: pd.DataFrame) -> Iterator[pd.DataFrame]:
        clock = np.maximum.accumulate(came["received_us"].to_numpy())
        if rest["clock"] is not None:
            clock = np.maximum(clock, rest["clock"])
        rest["clock"] = int(clock[-1])
        size, offset = came["frame_size"].to_numpy(), came["src_offset"].to_numpy()
        held = rest["bars"] > 0
        if held:  # the rest is one frame before the others
            size, offset = np.r_[rest["bars"], size], np.r_[-1, offset]
            clock = np.r_[rest["opened"], clock]
        frames = Frames(np.cumsum(size) - size, size, clock, offset, self.limit, self.age)
        starts, ends, at = [], [], 0
        while at < frames.end:
            starts.append(at)
            at = int(frames.ends(np.array([at]))[0])
            ends.append(at)
        found = frames.batches(np.array(starts), np.array(ends))
        table = pd.DataFrame({name: found[name] for name in (
            "bars", "source_records", "opened_us", "filled_us", "reason")})
        newest = found["whole_frame"]
        table["commit_offset"] = pd.Series(frames.offset[np.maximum(newest, 0)] + 1, dtype="Int64").mask(
            newest < found["first_frame"])
        if held:
            table.loc[0, "source_records"] += rest["sources"] - 1
            if newest[0] == 0:
                table.loc[0, "commit_offset"] = pd.NA if rest["commit_offset"] is None else rest["commit_offset"]
            if found["last_frame"][0] == 0:
                table.loc[0, "filled_us"] = rest["filled"]
        table["batch_id"] = rest["batch"] + np.arange(len(table))
        last = table.iloc[-1]
        is_open = last["reason"] == OPEN
        closed = table[table["reason"] != OPEN]
        rest["batch"] += len(closed)
        rest.update({"bars": 0, "sources": 0, "commit_offset": None, "opened": None, "filled": None})
        if is_open:
            commit = last["commit_offset"]
            rest.update({
                "bars": int(last["bars"]), "sources": int(last["source_records"]),
                "commit_offset": None if pd.isna(commit) else int(commit),
                "opened": int(last["opened_us"]), "filled": int(last["filled_us"])})
        if len(closed):
            yield self._rows(key, closed)

    def _rows(self, key: Any, table: pd.DataFrame) -> pd.DataFrame:
        names = [field.split()[0] for field in CUT.split(", ")]
        return table.assign(topic=key[0], part_id=key[1])[names]

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        rest = self._read()
        if self._due(rest) == expiredTimerInfo.getExpiryTimeInMs():
            yield self._rows(key, pd.DataFrame({
                "batch_id": [rest["batch"]], "bars": [rest["bars"]], "source_records": [rest["sources"]],
                "commit_offset": pd.array([rest["commit_offset"]], "Int64"), "opened_us": [rest["opened"]],
                "filled_us": [rest["filled"]], "reason": [AGE]}))
            rest.update({"batch": rest["batch"] + 1, "bars": 0, "sources": 0, "commit_offset": None,
                         "opened": None, "filled": None})
            self.rest.update(tuple(rest.values()))

    def close(self) -> None:
        pass


def stream_cuts(
    frames: DataFrame, limit: int = 100, max_age_seconds: int = 300, grace_seconds: float = 0, timers: bool = True
) -> DataFrame:
    """Cuts of a live stream of ``topic, part_id, src_offset, frame_size, received_at``.

    ``grace_seconds`` is how long a frame may take from its arrival to this stream; timers wait that much
    longer. Without ``timers`` a rest waits for the next frame, which suits the replay of an old log: to
    its clock every rest of an old log would be overdue at the end of each trigger.
    """
    if max_age_seconds <= 0:
        raise ValueError("the age of a batch must be positive")
    cutter = BatchCutter(_checked(limit), max_age_seconds, grace_seconds, timers)
    narrow = frames.select(
        "topic", F.col("part_id").cast("int").alias("part_id"), F.col("src_offset").cast("long").alias("src_offset"),
        F.col("frame_size").cast("long").alias("frame_size"), F.unix_micros("received_at").alias("received_us"))
    found = narrow.groupBy(*SOURCE).transformWithStateInPandas(
        cutter, CUT, "Append", "ProcessingTime" if timers else "None")
    return cut_times(found)
