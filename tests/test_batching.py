from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickhouse.operators import batching

START = datetime(2026, 1, 2, tzinfo=timezone.utc)
SCHEMA = "topic string, part_id int, src_offset long, frame_size int, received_at timestamp"


def placed(spark, sizes, span=batching.OFFSET_SPAN, part=0):
    rows = [("bars", part, offset, size, START + timedelta(minutes=i))
            for i, (offset, size) in enumerate(sizes)]
    random.Random(7).shuffle(rows)
    return batching.place_frames(spark.createDataFrame(rows, SCHEMA), span)


def summary(spark, sizes, limit, span=batching.OFFSET_SPAN):
    rows = batching.batch_summary(placed(spark, sizes, span), limit).orderBy("batch_id").collect()
    return [(r["bars"], r["source_records"], r["commit_offset"], r["is_partial"]) for r in rows]


def test_split_commits_only_whole_frames(spark):
    assert summary(spark, [(41, 900), (42, 500)], 1000) == [(1000, 2, 42, False), (400, 1, 43, True)]


def test_oversized_frame(spark):
    assert summary(spark, [(7, 2500)], 1000) == [
        (1000, 1, None, False), (1000, 1, None, False), (500, 1, 8, True)]


def test_distinct_sources(spark):
    assert summary(spark, [(0, 2), (1, 1)], 3) == [(3, 2, 2, False)]


def test_empty_frames_never_commit_on_their_own(spark):
    assert summary(spark, [(0, 2), (1, 0)], 10) == [(2, 1, 1, True)]


def test_limit_must_hold_a_bar(spark):
    with pytest.raises(ValueError):
        batching.batch_summary(placed(spark, [(0, 1)]), 0)


def test_time_rule(spark):
    rows = batching.replay_windows(placed(spark, [(i, 1) for i in range(6)]), 100, 300).collect()
    assert [(r["age_seconds"], r["over_age"]) for r in rows] == [(300.0, True)]
    rows = batching.replay_windows(placed(spark, [(i, 1) for i in range(5)]), 100, 300).collect()
    assert [(r["age_seconds"], r["over_age"]) for r in rows] == [(240.0, False)]


def by_hand(frames, limit):
    """Bars one by one, as a single consumer would cut them."""
    batches = defaultdict(lambda: [0, set(), None])
    count = 0
    for offset, size in sorted(frames):
        for pos in range(size):
            batch = batches[count // limit]
            batch[0] += 1
            batch[1].add(offset)
            if pos == size - 1:
                batch[2] = offset + 1
            count += 1
    return [(b[0], len(b[1]), b[2], b[0] < limit) for _, b in sorted(batches.items())]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 60), st.integers(0, 9), min_size=1), st.integers(1, 7), st.integers(1, 20))
def test_against_one_by_one(spark, frames, limit, span):
    assert summary(spark, list(frames.items()), limit, span) == by_hand(frames.items(), limit)
