"""Stateful streams: watchdog, batch cuts, stalls, counters, late rows."""

from __future__ import annotations

import random
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import test_loader
from tickhouse.operators import batching, cuts, extractor, loader
from tickhouse.streaming import heartbeat, late, views, watchdog
from tickhouse.streaming import cuts as live_cuts
from tickhouse.streaming.run import drained, with_state

T0 = datetime(2026, 1, 2, 15, tzinfo=timezone.utc)
SECOND = timedelta(seconds=1)


def utc(value):
    """Spark returns UTC without a zone."""
    return None if value is None else value.replace(tzinfo=timezone.utc)


def add(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


class Running:
    """A live query with a short trigger that writes to a folder."""

    def __init__(self, frame, folder):
        self.spark, self.folder, self.schema = with_state(frame.sparkSession), folder, frame.schema
        self.query = (frame.writeStream.format("parquet").option("path", f"{folder}/rows")
                      .option("checkpointLocation", f"{folder}/checkpoint").trigger(processingTime="1 second").start())

    def rows(self, enough, seconds=90):
        end = time.time() + seconds
        while True:
            try:
                got = self.spark.read.schema(self.schema).parquet(f"{self.folder}/rows").collect()
            except Exception:  # the folder comes with the first rows
                got = []
            if len(got) >= enough or time.time() > end:
                return got
            time.sleep(0.5)

    def __enter__(self):
        return self

    def __exit__(self, *error):
        self.query.stop()


# --- T4 ----------------------------------------------------------------------------------------

ACTIVITY = "component string, at timestamp, kind string"


def test_watchdog_fires_while_nothing_arrives(spark, tmp_path):
    now = datetime.now(timezone.utc)
    source = str(tmp_path / "in")
    add(spark, source, [
        ("fed", now - 60 * SECOND, "started"), ("fed", now, "data"),
        ("mute", now - SECOND, "started"), ("mute", now + 3 * SECOND, "keepalive"),
    ], ACTIVITY)
    with Running(watchdog.stream_idle(stream(spark, source, ACTIVITY), 6), str(tmp_path / "out")) as live:
        got = {r.component: r for r in live.rows(2)}
        assert {c: (utc(r.last_message_at), utc(r.idle_at)) for c, r in got.items()} == {
            "fed": (now, now + 6 * SECOND), "mute": (None, now + 5 * SECOND)}
        time.sleep(3)
        assert len(live.rows(0)) == 2  # each silence is told once
        again = datetime.now(timezone.utc)
        add(spark, source, [("fed", again, "data")], ACTIVITY)
        rows = live.rows(3)
        assert sorted((r.component, utc(r.idle_at)) for r in rows)[1] == ("fed", again + 6 * SECOND) and len(rows) == 3


def test_watchdog_forgets_frames_of_an_earlier_process(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("a", T0, "data"), ("a", T0 + 5 * SECOND, "started"), ("b", T0 + 9 * SECOND, "data"),
            ("b", T0, "started"), ("b", T0 + 3 * SECOND, "data")]
    add(spark, source, rows, ACTIVITY)
    got = drained(watchdog.stream_idle(stream(spark, source, ACTIVITY), 600), timers=True)
    assert sorted((r.component, utc(r.last_message_at), utc(r.idle_at)) for r in got.collect()) == [
        ("a", None, T0 + 605 * SECOND), ("b", T0 + 9 * SECOND, T0 + 609 * SECOND)]
    off = drained(watchdog.stream_idle(stream(spark, source, ACTIVITY), 0))
    assert off.collect() == [] and off.columns == got.columns


# --- T1 ----------------------------------------------------------------------------------------

FRAMES = "topic string, part_id int, src_offset bigint, frame_size bigint, received_at timestamp"
CUT = ["part_id", "batch_id", "bars", "source_records", "commit_offset", "opened_at", "filled_at", "reason"]


def by_hand(frames, limit, age):
    """The rule, bar by bar: frames (part, offset, size, seconds) to cuts."""
    out = []
    for part in sorted({f[0] for f in frames}):
        batch, held, clock = 0, [], None

        def close(reason, part=part):
            nonlocal batch, held
            ended = [o for o, _, final in held if final]
            out.append((part, batch, len(held), len({o for o, _, _ in held}), max(ended) + 1 if ended else None,
                        T0 + held[0][1] * SECOND, T0 + held[-1][1] * SECOND, reason))
            batch, held = batch + 1, []

        for _, offset, size, at in sorted(f for f in frames if f[0] == part):
            if not size:
                continue
            clock = at if clock is None else max(clock, at)
            if held and clock - held[0][1] >= age:
                close("age")
            for k in range(size):
                held.append((offset, clock, k == size - 1))
                if len(held) == limit:
                    close("full")
        if held:
            close("open")
    return out


def cut_rows(df):
    return sorted((r.part_id, r.batch_id, r.bars, r.source_records, r.commit_offset, utc(r.opened_at),
                   utc(r.filled_at), r.reason) for r in df.select(*CUT).collect())


def some_frames(seed, n=120):
    rnd, frames = random.Random(seed), []
    for part in (0, 1):
        at = 0
        for offset in range(n):
            at += rnd.choice([0, 0, 1, 2, -1, 40])
            frames.append((part, offset, rnd.choice([0, 1, 2, 3, 7, 25]), max(at, 0)))
    return frames


def as_rows(frames):
    return [("bars", p, o, s, T0 + at * SECOND) for p, o, s, at in frames]


@pytest.mark.parametrize(("limit", "age", "chunk"), [(10, 30, 16), (1, 5, 4), (100, 45, 128), (7, 1000, 1 << 16)])
def test_replay_cuts_equal_the_rule(spark, limit, age, chunk):
    frames = some_frames(limit)
    placed = batching.place_frames(spark.createDataFrame(as_rows(frames), FRAMES))
    assert cut_rows(cuts.replay_cuts(placed, limit, age, chunk)) == by_hand(frames, limit, age)


def test_replay_cuts_of_nothing(spark):
    placed = batching.place_frames(spark.createDataFrame([], FRAMES))
    assert cuts.replay_cuts(placed).collect() == []
    with pytest.raises(ValueError):
        cuts.replay_cuts(placed, max_age_seconds=0)


def test_live_cuts_over_several_triggers_equal_the_replay(spark, tmp_path):
    frames, source, folder = some_frames(3, 60), str(tmp_path / "in"), str(tmp_path / "out")
    for low, high in ((0, 7), (7, 31), (31, 60)):
        some = [f for f in frames if low <= f[1] < high]
        random.Random(low).shuffle(some)
        add(spark, source, as_rows(some), FRAMES)
    add(spark, source, as_rows([f for f in frames if 20 <= f[1] < 31]), FRAMES)  # delivered again
    live = live_cuts.stream_cuts(stream(spark, source, FRAMES), 10, 30, timers=False)
    closed = [r for r in by_hand(frames, 10, 30) if r[-1] != "open"]
    assert cut_rows(drained(live, folder)) == closed
    # A later run goes on with the rest that the state holds.
    more = [(p, 60, 40, 10_000) for p in (0, 1)]
    add(spark, source, as_rows(more), FRAMES)
    live = live_cuts.stream_cuts(stream(spark, source, FRAMES), 10, 30, timers=False)
    assert cut_rows(drained(live, folder)) == [r for r in by_hand(frames + more, 10, 30) if r[-1] != "open"]


def test_a_rest_is_cut_by_its_own_age(spark, tmp_path):
    """Idle time before a batch opens does not count; a rest gets a fresh clock."""
    now = datetime.now(timezone.utc)
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    add(spark, source, [("bars", 0, 0, 0, now - timedelta(hours=1)), ("bars", 0, 1, 12, now)], FRAMES)
    with Running(live_cuts.stream_cuts(stream(spark, source, FRAMES), 10, 8), folder) as live:
        first = live.rows(1)
        assert [(r.bars, r.reason, r.commit_offset) for r in first] == [(10, "full", None)]
        both = sorted(live.rows(2), key=lambda r: r.batch_id)
        assert [(r.bars, r.reason, r.commit_offset) for r in both[1:]] == [(2, "age", 2)]
        assert utc(both[1].opened_at) == now
        time.sleep(3)
        assert len(live.rows(0)) == 2  # nothing is open now


# --- T6 ----------------------------------------------------------------------------------------

BEAT = test_loader.SAMPLE + ", process_id string"
TRACKED = ["seq", "lag_records", "progressed", "positive_lag_since", "last_progress_at", "state", "stall_reported"]


def test_stalls_do_not_depend_on_arrival(spark, tmp_path):
    samples = [test_loader.sample("t", m, [(0, m // 30, m // 10)], bars=m % 2) for m in range(0, 120, 5)]
    shuffled = samples[:]
    random.Random(2).shuffle(shuffled)
    source = str(tmp_path / "in")
    for part in (shuffled[:9], shuffled[9:13], shuffled[13:]):
        add(spark, source, [(*s, "p") for s in part], BEAT)
    add(spark, source, [(*test_loader.sample("t", 2000, []), "later")], BEAT)  # moves the watermark on
    live = heartbeat.stream_health(stream(spark, source, BEAT), delay="3 hours")
    got = [r for r in drained(live).collect() if r.process_id == "p"]
    want = loader.track_health(spark.createDataFrame(samples, test_loader.SAMPLE)).collect()
    assert sorted(tuple(r[n] for n in TRACKED) for r in got) == sorted(tuple(r[n] for n in TRACKED) for r in want)
    assert any(r.stall_reported for r in got)


def test_state_of_a_silent_process_expires(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    beats = [(0, "p"), (10, "p"), (20, "q"), (300, "q"), (301, "p"), (400, "q"), (900, "q")]
    for minute, process in beats:
        add(spark, source, [(*test_loader.sample("t", minute, [(0, 0, 5)]), process)], BEAT)
    live = heartbeat.stream_health(stream(spark, source, BEAT), delay="1 minute", expire_seconds=3600)
    got = {(r.process_id, r.seq): r for r in drained(live, folder).collect()}
    # The lag of p began at 0, but its state was gone when it came back at 301.
    assert got["p", 10].positive_lag_since == got["p", 0]["at"]
    assert got["p", 301].positive_lag_since == got["p", 301]["at"]
    left = spark.read.format("statestore").option("path", f"{folder}/checkpoint").option("stateVarName", "health").load()
    assert {r["key"]["process_id"] for r in left.collect()} <= {"q"}


# --- T5 ----------------------------------------------------------------------------------------


def test_live_counters_equal_the_batch_form(spark, tmp_path):
    rnd, source, folder = random.Random(4), str(tmp_path / "in"), str(tmp_path / "out")
    kinds = ["received", "sent", "delivery_failure", "error"]
    rows = sorted((f"c{rnd.randrange(3)}", T0 + rnd.randrange(7200) * SECOND, rnd.choice(kinds)) for _ in range(400))
    rows.sort(key=lambda r: r[1])
    for k in range(4):
        add(spark, source, rows[100 * k:100 * k + 100], ACTIVITY)
    emitted = drained(views.stream_counters(stream(spark, source, ACTIVITY), 300), folder)
    whole = spark.createDataFrame(rows, ACTIVITY)
    names = emitted.columns
    final = views.final_counters(emitted, whole, 300)
    got = sorted(tuple(r) for r in emitted.unionByName(final).select(*names).collect())
    assert got == sorted(tuple(r) for r in extractor.counter_windows(whole, 300).select(*names).collect())
    assert emitted.count() > 40 and 0 < final.count() < 10
    assert all(r["last_delivery_at"] is not None for r in final.collect())


# --- T3 ----------------------------------------------------------------------------------------

BARS = "payload_hash string, ingested_at timestamp"


def test_kept_copies_and_late_rows_add_up(spark, tmp_path):
    source = str(tmp_path / "in")
    batches = [
        [("a", 0), ("b", 10), ("a", 20)],
        [("c", 5000), ("b", 4000)],          # the watermark is 20 - 100 here: nothing is late
        [("a", 30), ("d", 4950), ("c", 5001), ("e", None)],  # 30 is behind 5000 - 100
        [("f", 10), ("g", 6000)],
    ]
    for rows in batches:
        add(spark, source, [(h, None if t is None else T0 + t * SECOND) for h, t in rows], BARS)
    splitter = late.LateSplitter(str(tmp_path / "split"), delay_seconds=100)
    late.start_split(stream(spark, source, BARS), splitter).awaitTermination()
    assert sorted(r.payload_hash for r in late.late_rows(spark, splitter).collect()) == ["a", "f"]
    ledger = sorted((r.batch_id, r.input_rows, r.late_rows) for r in late.late_ledger(spark, splitter).collect())
    assert ledger == [(0, 3, 0), (1, 2, 0), (2, 4, 1), (3, 2, 1)]
    on_time = late.stream_on_time(spark, splitter, max_files=1)
    kept = drained(views.stream_deduplicated(on_time, "100 seconds"))
    copies = 9 - kept.count()
    assert sorted(r.payload_hash for r in kept.collect() if r.ingested_at is not None) in (
        ["a", "b", "c", "d", "g"], ["a", "b", "b", "c", "d", "g"])
    assert kept.count() + copies + 2 == 11
    splitter(spark.read.parquet(source).limit(3), 3)  # a batch that runs again replaces itself
    assert late.late_ledger(spark, splitter).count() == 4
