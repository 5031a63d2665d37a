from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tickhouse.operators import extractor, loader
from tickhouse.queries import inputs

START = datetime(2026, 8, 27, 12, tzinfo=timezone.utc)
EVENT = (
    "pipeline_id string, process_id string, at timestamp, seq long, event string, batch_bars long, "
    "batch_source_records long, last_commit_at_utc string, durable_commit_total_duration_ms long"
)
SAMPLE = (
    "topic string, at timestamp, seq long, partitions array<struct<part_id:bigint,"
    "committed_offset:bigint,end_offset:bigint>>, committing boolean, buffered_bars long, "
    "buffered_source_records long"
)
MINUTE = timedelta(minutes=1)


def test_state_precedence(spark):
    now, old = START, START - timedelta(minutes=15)
    rows = [
        # initialized, committing, lag, bars, sources, lag since, progress at -> state
        (False, True, 9, 1, 1, old, old, "starting"),
        (True, True, 9, 1, 1, old, old, "committing"),
        (True, False, 9, 1, 1, old, old, "stalled"),
        (True, False, 9, 1, 1, old, now - 14 * MINUTE, "catching_up"),
        (True, False, 9, 1, 1, None, None, "catching_up"),
        (True, False, 1, 5, 1, now, None, "buffering"),
        (True, False, 0, 0, 0, None, old, "idle"),
    ]
    frame = spark.createDataFrame(
        rows, "init boolean, busy boolean, lag long, bars long, src long, since timestamp, "
        "progress timestamp, want string")
    state = loader.infer_state(
        F.col("init"), F.col("busy"), F.col("lag"), F.col("bars"), F.col("src"), F.col("since"),
        F.col("progress"), F.lit(now), 900)
    for row in frame.withColumn("got", state).collect():
        assert row["got"] == row["want"]


def sample(topic, minute, parts, seq=None, committing=False, bars=0, sources=0):
    return (topic, START + minute * MINUTE, minute if seq is None else seq, parts, committing, bars, sources)


def track(spark, samples):
    rows = loader.track_health(spark.createDataFrame(samples, SAMPLE))
    return rows.orderBy("topic", "at", "seq").collect()


def test_a_stall_is_reported_once(spark):
    rows = track(spark, [sample("t", m, [(0, 0, 10)]) for m in (0, 15, 16)])
    assert [r["state"] for r in rows] == ["catching_up", "stalled", "stalled"]
    assert [r["stall_reported"] for r in rows] == [False, True, False]


def by_hand(samples, stall=timedelta(seconds=900)):
    result = []
    for topic in sorted({s[0] for s in samples}):
        seen, since, progress, state = {}, None, None, None
        for s in sorted((s for s in samples if s[0] == topic), key=lambda s: (s[1], s[2])):
            _, at, seq, parts, committing, bars, sources = s
            lag = sum(max(e - c, 0) for _, c, e in parts)
            moved = any(p in seen and c > seen[p] for p, c, _ in parts)
            seen = {p: c for p, c, _ in parts}
            since = None if lag == 0 else (since or at)
            if lag == 0 or moved:
                progress = at
            edge = max([t for t in (since, progress) if t], default=None)
            before = state
            if not parts:
                state = "starting"
            elif committing:
                state = "committing"
            elif lag > 0 and edge and at - edge >= stall:
                state = "stalled"
            elif lag > sources:
                state = "catching_up"
            else:
                state = "buffering" if bars > 0 or sources > 0 else "idle"
            result.append((topic, seq, lag, moved, since, progress, state,
                           state == "stalled" and before != "stalled"))
    return result


@pytest.mark.parametrize("seed", [1, 2])
def test_tracking_against_one_by_one(spark, seed):
    rng = random.Random(seed)
    samples, committed = [], {}
    for minute in range(240):
        topic = rng.choice(["hot", "hot", "cold"])
        parts = []
        for part in rng.sample(range(3), rng.randrange(0, 4)):
            end = minute // 3
            done = committed.get((topic, part), 0)
            if rng.random() < 0.15:
                done = end if rng.random() < 0.6 else min(end, done + 1)
            committed[topic, part] = done
            parts.append((part, done, end))
        samples.append(sample(topic, minute * 2, parts, minute, rng.random() < 0.05,
                              rng.randrange(3), rng.randrange(30)))
    expected = by_hand(samples)
    shuffled = samples[:]
    rng.shuffle(shuffled)
    got = [(r["topic"], r["seq"], r["lag_records"], r["progressed"],
            r["positive_lag_since"] and r["positive_lag_since"].replace(tzinfo=timezone.utc),
            r["last_progress_at"] and r["last_progress_at"].replace(tzinfo=timezone.utc),
            r["state"], r["stall_reported"]) for r in track(spark, shuffled)]
    assert got == expected
    assert {row[6] for row in got} >= {"stalled", "catching_up", "committing"}


def pending_by_hand(events):
    pending, commits = {}, []
    for pipeline, process, at, seq, event, bars, sources, _, duration in sorted(events, key=lambda e: (e[2], e[3])):
        if process is None:
            continue
        key = (pipeline, process)
        if event == "commit_started":
            pending[key] = (bars, sources)
        elif event == "commit_succeeded":
            commits.append((pipeline, seq, *pending.pop(key, (None, None)), duration))
        elif event != "heartbeat":
            pending.pop(key, None)
    return sorted(commits)


def test_commit_pairing_against_a_pending_map(spark):
    rng = random.Random(11)
    kinds = ["heartbeat", "commit_started", "commit_started", "commit_succeeded", "loader_failed"]
    events = []
    for i in range(600):
        kind = rng.choice(kinds)
        start = kind == "commit_started"
        events.append((
            rng.choice("ab"), rng.choice(["p", "p", "q", None]), START + timedelta(seconds=i // 4), i, kind,
            i * 10 if start else None, i if start else None, None, i if kind == "commit_succeeded" else None))
    rng.shuffle(events)
    pairs = loader.pair_commits(spark.createDataFrame(events, EVENT)).collect()
    got = sorted((r["pipeline_id"], r["seq"], r["bars"], r["source_records"], r["duration_ms"]) for r in pairs)
    assert got == pending_by_hand(events)


def test_missing_offsets_are_resolved(spark):
    keys = "topic string, part_id int"
    assigned = spark.createDataFrame([("t", 0), ("t", 1), ("t", 2), ("t", 3)], keys)
    committed = spark.createDataFrame([("t", 0, 5)], keys + ", committed_offset long")
    beginning = spark.createDataFrame([("t", 1, 3)], keys + ", beginning_offset long")
    end = spark.createDataFrame([("t", 0, 4), ("t", 1, 10), ("t", 2, 2)], keys + ", end_offset long")
    rows = loader.resolve_offsets(assigned, committed, beginning, end)
    assert [tuple(r)[1:] for r in rows.orderBy("part_id").collect()] == [
        (0, 5, 4, 0), (1, 3, 10, 7), (2, 0, 2, 2), (3, 0, 0, 0)]
    total = loader.partition_arrays(rows).first()
    assert total["aggregate_lag_records"] == 9 and [p["part_id"] for p in total["partitions"]] == [0, 1, 2, 3]


def test_idle_watch(spark):
    frames = spark.createDataFrame(
        [("a", START), ("a", START + 10 * MINUTE), ("a", START + 19 * MINUTE + timedelta(seconds=59))],
        "component string, received_at timestamp")
    gaps = extractor.idle_gaps(frames, 600).collect()
    assert [r["idle_micros"] for r in gaps] == [600_000_000]
    assert extractor.idle_gaps(frames, 0).count() == 0
    starts = spark.createDataFrame(
        [("a", START), ("b", START + 20 * MINUTE), ("c", START + 21 * MINUTE)],
        "component string, started_at timestamp")
    rows = extractor.idle_now(frames, starts, F.lit(START + 30 * MINUTE), 600).collect()
    assert {r["component"]: r["is_idle"] for r in rows} == {"a": True, "b": True, "c": False}
    rows = extractor.idle_now(frames, starts, F.lit(START + 60 * MINUTE), 0).collect()
    assert not any(r["is_idle"] for r in rows)


def test_newest_logs_are_cut_before_the_shuffle(spark):
    from tickhouse.operators import journal
    from tickhouse.settings import LIVE_READ_LIMITS

    entries = inputs.log_entries(spark, "/root/testdata/sf0.001").withColumn("log_class", F.lit("extractor"))
    plan = journal.newest_per_class(entries, LIVE_READ_LIMITS)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
