"""Loader events, commit pairing, offset lag, stall tracking and the loader section."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.functions.codes import failure_code, is_failure, normal_event
from tickhouse.functions.times import lenient_instant, lenient_text, seconds_text
from tickhouse.operators.ordered import CHUNK, Running, chunk_rows, running, scan
from tickhouse.settings import (
    COMMIT_STARTED,
    COMMIT_SUCCEEDED,
    FAILURE_EVENTS,
    HEARTBEAT,
    LogNames,
    Thresholds,
)

ORDER = ("at", "seq")
TOPIC_PARTITION = ("topic", "part_id")


def loader_events(
    entries: DataFrame, names: LogNames = LogNames(), strict: bool = False
) -> DataFrame:
    """Recognised health events of the loader unit, one flat row each."""
    fields = F.col("fields")
    event = normal_event(fields["event"], fields["failure_type"], strict)
    wanted = (F.col("unit") == names.loader_unit) & (F.col("target") == names.health_target)
    if names.topics is not None:
        wanted = wanted & fields["topic"].isin(*names.topics)
    return entries.filter(wanted & event.isin(
        HEARTBEAT, COMMIT_STARTED, COMMIT_SUCCEEDED, *FAILURE_EVENTS
    )).select(
        "pipeline_id",
        "seq",
        "at",
        event.alias("event"),
        fields["process_started_at_utc"].alias("process_id"),
        *[
            fields[name].alias(name)
            for name in (
                "topic", "state", "last_input_at_utc", "last_commit_at_utc",
                "last_commit_duration_ms", "durable_commit_total_duration_ms", "batch_bars",
                "batch_source_records", "aggregate_lag_records", "buffered_bars",
                "buffered_source_records",
            )
        ],
        safe_partitions(fields["partitions"]).alias("partitions"),
    )


def safe_partitions(reported: Column) -> Column:
    """Reported offsets in either spelling, without topics; incomplete elements are left out."""

    def flat(item: Column) -> Column:
        return F.struct(
            item["partition"].alias("partition"),
            F.coalesce(item["committedOffset"], item["committed_offset"]).alias("committed_offset"),
            F.coalesce(item["endOffset"], item["end_offset"]).alias("end_offset"),
            F.coalesce(item["lagRecords"], item["lag_records"]).alias("lag_records"),
        )

    def complete(item: Column) -> Column:
        return (
            item["partition"].isNotNull()
            & item["committed_offset"].isNotNull()
            & item["end_offset"].isNotNull()
            & item["lag_records"].isNotNull()
        )

    return F.coalesce(F.filter(F.transform(reported, flat), complete), F.array())


def loader_alerts(events: DataFrame) -> DataFrame:
    return events.filter(is_failure(F.col("event"))).select(
        "pipeline_id",
        "seq",
        "at",
        F.lit("loader").alias("component"),
        F.lit("ERROR").alias("severity"),
        failure_code(F.col("event")).alias("code"),
    )


# ---- commits -------------------------------------------------------------------------------


def pair_commits(events: DataFrame) -> DataFrame:
    """Every successful commit with the sizes announced by its start.

    Within one process only starts, successes and failures change what is pending, so a success
    is paired exactly when the row before it (among those) is a start.
    """
    keys = ("pipeline_id", "process_id")
    event = F.col("event")
    steps = events.filter(F.col("process_id").isNotNull()).filter(
        event.isin(COMMIT_STARTED, COMMIT_SUCCEEDED, *FAILURE_EVENTS)
    ).select(
        *keys, *ORDER, "event", "batch_bars", "batch_source_records", "last_commit_at_utc",
        "durable_commit_total_duration_ms",
    )
    pending = F.struct("event", "batch_bars", "batch_source_records")
    ordered = scan(steps, keys, ORDER, _last=Running("previous", pending))
    started = F.col("_last.event") == COMMIT_STARTED
    return ordered.filter(event == COMMIT_SUCCEEDED).select(
        *keys,
        "at",
        "seq",
        lenient_text(F.col("last_commit_at_utc"), F.col("at")).alias("at_utc"),
        F.when(started, F.col("_last.batch_bars")).alias("bars"),
        F.when(started, F.col("_last.batch_source_records")).alias("source_records"),
        F.col("durable_commit_total_duration_ms").alias("duration_ms"),
    )


def recent(commits: DataFrame, limit: int = 48) -> DataFrame:
    """The newest ``limit`` commits of each pipeline, numbered from the newest."""
    newest = Window.partitionBy("pipeline_id").orderBy(F.col("at").desc(), F.col("seq").desc())
    return commits.withColumn("newest_rank", F.row_number().over(newest)).filter(
        F.col("newest_rank") <= limit
    )


def recent_array(commits: DataFrame, limit: int = 48) -> DataFrame:
    """The same as one array per pipeline, oldest first; at most ``limit`` elements each."""
    shown = ("at_utc", "bars", "source_records", "duration_ms")
    ordered = F.array_sort(F.collect_list(F.struct(*ORDER, *shown)))
    return recent(commits, limit).groupBy("pipeline_id").agg(
        F.transform(ordered, lambda c: F.struct(*[c[name].alias(name) for name in shown])).alias(
            "recent_commits"
        )
    )


# ---- sections ------------------------------------------------------------------------------


def failure_counts(events: DataFrame) -> DataFrame:
    """``pipeline_id, failure_total``: the failures before anything is cut."""
    return events.filter(is_failure(F.col("event"))).groupBy("pipeline_id").agg(
        F.count(F.lit(1)).alias("failure_total")
    )


def failure_summary(events: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Failures per pipeline. ``totals`` (:func:`failure_counts`) tells what was there before a
    cut; the cap flag says whether failures were cut."""
    failed = is_failure(F.col("event"))
    return _failure_columns(events.groupBy("pipeline_id").agg(
        F.count_if(failed).alias("failure_count"),
        F.max(F.when(failed, F.struct(*ORDER, "event"))).alias("last_failure"),
    ), totals)


def _failure_columns(rows: DataFrame, totals: DataFrame | None) -> DataFrame:
    """Count, cap flag, time and code from ``failure_count`` and ``last_failure``."""
    if totals is None:
        rows = rows.withColumn("failure_total", F.col("failure_count"))
    else:
        rows = rows.join(totals, "pipeline_id", "left").fillna(0, ["failure_total"])
    return rows.withColumns({
        "failure_count": F.col("failure_total"),
        "failure_count_is_capped": F.col("failure_total") > F.col("failure_count"),
        "last_failure_at": F.col("last_failure.at"),
        "last_failure_code": failure_code(F.col("last_failure.event")),
    }).drop("last_failure", "failure_total")


def latest_signals(events: DataFrame) -> DataFrame:
    """Per pipeline: the newest event, the newest heartbeat of that event's process, the newest
    success of any process and the failures.

    Positions are aggregated alone, per process and then per pipeline; at most three events of each
    pipeline are then fetched whole."""
    position = F.struct(*ORDER)
    event = F.col("event")
    beat, success, failed = event == HEARTBEAT, event == COMMIT_SUCCEEDED, is_failure(event)
    per_process = events.groupBy("pipeline_id", "process_id").agg(
        F.max(position).alias("newest"),
        F.max(F.when(beat, position)).alias("newest_beat"),
        F.max(F.when(success, position)).alias("newest_success"),
        F.count_if(failed).alias("failures"),
        F.max(F.when(failed, F.struct(*ORDER, "event"))).alias("last_failure"),
    )
    found = per_process.groupBy("pipeline_id").agg(
        F.max("newest").alias("latest_event"),
        F.max_by("newest_beat", "newest").alias("latest_heartbeat"),
        F.max("newest_success").alias("latest_success"),
        F.sum("failures").alias("failure_count"),
        F.max("last_failure").alias("last_failure"),
    )
    roles = ("latest_event", "latest_heartbeat", "latest_success")
    wanted = found.select("pipeline_id", F.explode(F.map_from_arrays(
        F.array(*[F.lit(role) for role in roles]), F.array(*roles))).alias("_role", "_at"))
    wanted = wanted.select("pipeline_id", "_role", *[F.col("_at")[c].alias(c) for c in ORDER])
    row = F.struct(*[c for c in events.columns if c != "pipeline_id"])
    rows = events.join(wanted, ["pipeline_id", *ORDER]).groupBy("pipeline_id").agg(*[
        F.first(F.when(F.col("_role") == role, row), ignorenulls=True).alias(role) for role in roles
    ])
    return found.drop(*roles).join(rows, "pipeline_id").select(
        "pipeline_id", *roles, "failure_count", "last_failure"
    )


def _last_commit(success: Column, current: Column) -> Column:
    """The newest success's own commit time, else what the current signal reports."""
    return F.coalesce(
        F.nullif(success["last_commit_at_utc"], F.lit("")), current["last_commit_at_utc"]
    )


def last_commits(events: DataFrame) -> DataFrame:
    """``pipeline_id, last_commit_at`` (to the second), for resolving alerts."""
    needed = events.select(
        "pipeline_id", "process_id", "at", "seq", "event", "last_commit_at_utc"
    )
    current = F.coalesce("latest_heartbeat", "latest_event")
    text = _last_commit(F.col("latest_success"), current)
    return latest_signals(needed).select(
        "pipeline_id", F.date_trunc("second", lenient_instant(text)).alias("last_commit_at")
    )


def loader_summary(
    events: DataFrame, limits: Thresholds = Thresholds(), totals: DataFrame | None = None
) -> DataFrame:
    """The loader section, one row per pipeline that has any loader event."""
    signals = _failure_columns(latest_signals(events), totals).withColumn(
        "current", F.coalesce("latest_heartbeat", "latest_event")
    )
    current, success = F.col("current"), F.col("latest_success")
    section = signals.select(
        "pipeline_id",
        F.lit("observed").alias("status"),
        current["state"].alias("state"),
        seconds_text(F.col("latest_heartbeat.at")).alias("latest_heartbeat_utc"),
        lenient_text(current["process_id"]).alias("process_started_at_utc"),
        lenient_text(current["last_input_at_utc"]).alias("last_input_utc"),
        lenient_text(_last_commit(success, current)).alias("last_commit_utc"),
        F.coalesce(
            success["durable_commit_total_duration_ms"], current["last_commit_duration_ms"]
        ).alias("last_commit_duration_ms"),
        current["aggregate_lag_records"].alias("aggregate_lag_records"),
        current["buffered_bars"].alias("buffered_bars"),
        current["buffered_source_records"].alias("buffered_source_records"),
        current["partitions"].alias("partitions"),
        "failure_count",
        "failure_count_is_capped",
        seconds_text(F.col("last_failure_at")).alias("last_failure_utc"),
        "last_failure_code",
    )
    commits = recent_array(pair_commits(events), limits.history_limit)
    return section.join(commits, "pipeline_id", "left")


# ---- offsets and stalls --------------------------------------------------------------------


def resolve_offsets(
    assignment: DataFrame, committed: DataFrame, beginning: DataFrame, end: DataFrame
) -> DataFrame:
    """Committed, end and lag of each assigned partition.

    An uncommitted partition starts at its beginning (or zero); a missing end means no lag.
    The side tables are keyed by (topic, part_id), each with an ``*_offset`` column.
    """
    committed_at = F.coalesce("committed_offset", "beginning_offset", F.lit(0).cast("long"))
    joined = assignment
    for side in (committed, beginning, end):
        joined = joined.join(side, list(TOPIC_PARTITION), "left")
    return joined.select(
        *TOPIC_PARTITION,
        committed_at.alias("committed_offset"),
        F.coalesce(F.col("end_offset"), committed_at).alias("end_offset"),
    ).withColumn(
        "lag_records",
        F.greatest(F.col("end_offset") - F.col("committed_offset"), F.lit(0).cast("long")),
    )


def partition_arrays(offsets: DataFrame) -> DataFrame:
    """One row per topic with its partitions in order and their summed lag."""
    element = F.struct("part_id", "committed_offset", "end_offset", "lag_records")
    return offsets.groupBy("topic").agg(
        F.array_sort(F.collect_list(element)).alias("partitions"),
        F.sum("lag_records").alias("aggregate_lag_records"),
    )


def infer_state(
    initialized: Column,
    committing: Column,
    lag: Column,
    buffered_bars: Column,
    buffered_sources: Column,
    lag_since: Column,
    progress_at: Column,
    now: Column,
    stall_seconds: int,
) -> Column:
    """Loader state; the first matching rule wins. ``greatest`` skips nulls."""
    waited = F.unix_micros(now) - F.unix_micros(F.greatest(lag_since, progress_at))
    return (
        F.when(~initialized, "starting")
        .when(committing, "committing")
        .when((lag > 0) & (waited >= stall_seconds * 1_000_000), "stalled")
        .when(lag > buffered_sources, "catching_up")
        .when((buffered_bars > 0) | (buffered_sources > 0), "buffering")
        .otherwise("idle")
    )


def sample_lag(partitions: Column) -> Column:
    zero = F.lit(0).cast("long")
    return F.aggregate(
        partitions,
        zero,
        lambda total, p: total + F.greatest(p["end_offset"] - p["committed_offset"], zero),
    )


def advanced(partitions: Column, previous: Column) -> Column:
    """Did any partition commit beyond what the previous sample of it showed?"""
    return F.coalesce(
        F.exists(
            partitions,
            lambda now: F.exists(
                previous,
                lambda before: (before["part_id"] == now["part_id"])
                & (now["committed_offset"] > before["committed_offset"]),
            ),
        ),
        F.lit(False),
    )


def track_health(
    samples: DataFrame, keys: Sequence[str] = ("topic",), stall_seconds: int = 900
) -> DataFrame:
    """Lag, progress, state and one-time stall transitions of a history of offset samples.

    ``samples``: keys, ``at``, ``seq``, ``partitions`` array<struct<part_id, committed_offset,
    end_offset>>, ``committing``, ``buffered_bars``, ``buffered_source_records``. A partition
    absent from the sample just before counts as new, which is not progress. Two ordered scans: the
    sample before each, then start of the lag and last progress.
    """
    if stall_seconds < 1:
        raise ValueError("a stall needs at least a second")
    measured = chunk_rows(
        samples.withColumn("lag_records", sample_lag(F.col("partitions"))), keys, ORDER
    )
    lag, at = F.col("lag_records"), F.col("at")
    before = F.struct("partitions", "lag_records", "committing", "at")
    compared = running(measured, keys, ORDER, _before=Running("previous", before))
    # The second scan reads this twice; stored, it does not repeat the first.
    flagged = compared.withColumn(
        "progressed", advanced(F.col("partitions"), F.col("_before.partitions"))
    ).withColumn(
        "_lag_starts", (lag > 0) & (F.coalesce(F.col("_before.lag_records"), F.lit(0)) == 0)
    ).checkpoint()
    carried = running(
        flagged, keys, ORDER,
        _lag_since=Running("last", F.when(F.col("_lag_starts"), at)),
        last_progress_at=Running("last", F.when((lag == 0) | F.col("progressed"), at)),
    ).withColumn("positive_lag_since", F.when(lag > 0, F.col("_lag_since")))
    told = carried.withColumn("state", infer_state(
        F.size("partitions") > 0, F.col("committing"), lag, F.col("buffered_bars"),
        F.col("buffered_source_records"), F.col("positive_lag_since"), F.col("last_progress_at"),
        at, stall_seconds,
    ))
    # A stalled sample neither progressed nor began its lag, so the sample before it had the same
    # lag start and progress: its state needs no scan of its own.
    previous = F.col("_before")
    waited = F.unix_micros(previous["at"]) - F.unix_micros(
        F.greatest("positive_lag_since", "last_progress_at"))
    was_stalled = F.coalesce(
        (F.size(previous["partitions"]) > 0) & ~previous["committing"] & (previous["lag_records"] > 0)
        & (waited >= stall_seconds * 1_000_000),
        F.lit(False),
    )
    reported = (F.col("state") == "stalled") & ~was_stalled
    return told.withColumn("stall_reported", reported).drop(
        "_before", "_lag_starts", "_lag_since", CHUNK)


def heartbeat_samples(events: DataFrame) -> DataFrame:
    """Heartbeat events as offset samples for :func:`track_health`."""
    parts = F.transform("partitions", lambda p: F.struct(
        p["partition"].alias("part_id"), p["committed_offset"].alias("committed_offset"),
        p["end_offset"].alias("end_offset"),
    ))
    return events.filter(F.col("event") == HEARTBEAT).select(
        "pipeline_id", "process_id", "topic", "at", "seq", parts.alias("partitions"),
        F.lit(False).alias("committing"),
        F.coalesce("buffered_bars", F.lit(0)).alias("buffered_bars"),
        F.coalesce("buffered_source_records", F.lit(0)).alias("buffered_source_records"),
    )
