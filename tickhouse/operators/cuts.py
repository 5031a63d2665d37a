"""Bars-or-age batch cuts of a landed log: the exact rule, without one task per partition.

A batch starts at some bar. It ends after ``limit`` bars, or before the first frame that arrives
``max_age_seconds`` or later after the frame of its first bar; an age cut never divides a frame. The
clock is the arrival time, never running backwards. So the end of a batch is a function of its first
bar alone, and the batches of a partition are the orbit of bar 0 under that function.

Bars are dealt into chunks. Within a chunk every possible first bar (a batch reaches at most ``limit``
bars into the next chunk) is followed to the chunk's end by doubling its jumps. Chaining the chunks then
takes one lookup per chunk, and each chunk can name its batches on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickhouse.operators.batching import SOURCE, _checked
from tickhouse.operators.ordered import Running, scan
from tickhouse.session import checkpoint_dir

#: Bars that one task holds at a time, as a few numbers per frame.
CHUNK = 1 << 16
CUT = (
    "topic string, part_id int, batch_id bigint, bars bigint, source_records bigint, commit_offset bigint, "
    "opened_us bigint, filled_us bigint, reason string"
)
FULL, AGE, OPEN = "full", "age", "open"


class Frames:
    """Frames in offset order: first bar, bars, clock (microseconds) and offset of each."""

    def __init__(self, first: Any, size: Any, clock: Any, offset: Any, limit: int, age: int):
        self.first, self.size = np.asarray(first, np.int64), np.asarray(size, np.int64)
        self.clock, self.offset = np.asarray(clock, np.int64), np.asarray(offset, np.int64)
        self.limit, self.age = limit, age
        self.end = int(self.first[-1] + self.size[-1])

    def frame_of(self, bar: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, bar, side="right") - 1

    def ends(self, start: np.ndarray) -> np.ndarray:
        """Where batches that start at these bars end; the end of the log at most."""
        late = np.searchsorted(self.clock, self.clock[self.frame_of(start)] + self.age, side="left")
        by_age = np.append(self.first, self.end)[late]
        return np.minimum(np.minimum(start + self.limit, by_age), self.end)

    def batches(self, start: np.ndarray, end: np.ndarray) -> dict[str, np.ndarray]:
        """What batches hold. The last one is open if neither rule has ended it."""
        begin, last = self.frame_of(start), self.frame_of(end - 1)
        whole = self.first[last] + self.size[last] <= end
        newest = np.where(whole, last, last - 1)
        reason = np.where(end - start == self.limit, FULL, np.where(end < self.end, AGE, OPEN))
        return {"bars": end - start, "first_frame": begin, "last_frame": last, "whole_frame": newest,
                "source_records": last - begin + 1, "opened_us": self.clock[begin],
                "filled_us": self.clock[last], "reason": reason}


def _commit(frames: Frames, found: dict[str, np.ndarray]) -> pd.Series:
    """One past the newest frame that ends in the batch; null if none does."""
    newest = found["whole_frame"]
    offset = pd.Series(frames.offset[np.maximum(newest, 0)] + 1, dtype="Int64")
    return offset.mask(newest < found["first_frame"])


def _exits(frames: Frames, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """For each possible first bar: where its chain leaves the chunk, and after how many batches."""
    goes = frames.ends(np.arange(low, high))
    taken = np.ones(len(goes), np.int64)
    while (inside := np.flatnonzero(goes < high)).size:
        target = goes[inside] - low
        taken[inside], goes[inside] = taken[inside] + taken[target], goes[target]
    return goes[:frames.limit], taken[:frames.limit]


def _of(group: pd.DataFrame, limit: int, age: int) -> Frames:
    ordered = group.sort_values("src_offset")
    return Frames(ordered["first_bar"], ordered["frame_size"], ordered["clock"], ordered["src_offset"], limit, age)


def replay_cuts(
    placed: DataFrame, limit: int = 100, max_age_seconds: int = 300, chunk: int = CHUNK
) -> DataFrame:
    """The batches that a live loader would have cut from this log.

    ``placed`` has ``topic, part_id, src_offset, frame_size, first_bar, received_at`` (``place_frames``).
    Returns ``batch_id, bars, source_records, commit_offset, opened_at, filled_at, reason`` per
    partition; the reason of a last batch that is neither full nor too old is ``open``.
    """
    if max_age_seconds <= 0:
        raise ValueError("the age of a batch must be positive")
    checkpoint_dir(placed.sparkSession)
    age, chunk = max_age_seconds * 1_000_000, max(chunk, _checked(limit))
    clocked = scan(
        placed.select("topic", F.col("part_id").cast("int").alias("part_id"), "src_offset", "frame_size",
                      "first_bar", F.unix_micros("received_at").alias("_at")),
        SOURCE, ["src_offset"], clock=Running("max", F.col("_at")),
    ).drop("_at")
    first, last = F.col("first_bar"), F.col("first_bar") + F.col("frame_size") - 1
    # A chunk also sees the frames of the ``limit`` bars after it, where its last batches end.
    chunks = F.sequence(
        F.greatest(F.lit(0).cast("long"), F.floor((first - limit) / chunk)), F.floor(last / chunk))
    chunked = clocked.withColumn("chunk", F.explode(chunks)).checkpoint()
    keys = [*SOURCE, "chunk"]

    def exits(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        frames, low = _of(group, limit, age), int(key[2]) * chunk
        goes, taken = _exits(frames, low, min(low + chunk, frames.end))
        return pd.DataFrame({"topic": [key[0]], "part_id": [key[1]], "chunk": [key[2]],
                             "goes": [goes], "taken": [taken]})

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, entry, made = None, 0, 0
        for batch in batches:
            own = list(zip(batch.column("topic").to_pylist(), batch.column("part_id").to_pylist(), strict=True))
            at, entries, numbers = batch.column("chunk").to_pylist(), [], []
            for i, k in enumerate(own):
                if k != key:
                    key, entry, made = k, 0, 0
                entries.append(entry)
                numbers.append(made)
                place = entry - at[i] * chunk
                goes, taken = batch.column("goes")[i].values, batch.column("taken")[i].values
                if place < len(goes):  # else the log ended in the chunk before
                    entry, made = goes[place].as_py(), made + taken[place].as_py()
            yield pa.RecordBatch.from_arrays(
                [batch.column("topic"), batch.column("part_id"), batch.column("chunk"),
                 pa.array(entries, pa.int64()), pa.array(numbers, pa.int64())],
                names=["topic", "part_id", "chunk", "entry", "made"])

    def name(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        frames, low = _of(group, limit, age), int(key[2]) * chunk
        high = min(low + chunk, frames.end)
        at, starts = int(group["entry"].iloc[0]), []
        goes = frames.ends(np.arange(low, high)) if at < high else np.empty(0, np.int64)
        while at < high:
            starts.append(at)
            at = int(goes[at - low])
        start = np.array(starts, np.int64)
        found = frames.batches(start, goes[start - low])
        return pd.DataFrame({
            "topic": key[0], "part_id": key[1], "batch_id": int(group["made"].iloc[0]) + np.arange(len(start)),
            "bars": found["bars"], "source_records": found["source_records"],
            "commit_offset": _commit(frames, found), "opened_us": found["opened_us"],
            "filled_us": found["filled_us"], "reason": found["reason"]})

    maps = chunked.groupBy(*keys).applyInPandas(
        exits, "topic string, part_id int, chunk bigint, goes array<bigint>, taken array<bigint>")
    entries = maps.repartition(*SOURCE).sortWithinPartitions(*keys).mapInArrow(
        chain, "topic string, part_id int, chunk bigint, entry bigint, made bigint")
    named = chunked.join(entries, keys).groupBy(*keys).applyInPandas(name, CUT)
    return cut_times(named)


def cut_times(cuts: DataFrame) -> DataFrame:
    return cuts.select(
        *SOURCE, "batch_id", "bars", "source_records", "commit_offset",
        F.timestamp_micros("opened_us").alias("opened_at"), F.timestamp_micros("filled_us").alias("filled_at"),
        "reason")
