"""Extractor events, counters, idle detection and the extractor section of the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.functions.codes import alert_code
from tickhouse.functions.times import seconds_text
from tickhouse.operators.ordered import Running, scan
from tickhouse.schemas import COUNTERS
from tickhouse.settings import FINAL_METRICS, IDLE_SHUTDOWN, METRICS, LogNames

LATEST = ("at", "seq")


def extractor_entries(entries: DataFrame, names: LogNames = LogNames()) -> DataFrame:
    return entries.filter(F.col("unit") == names.extractor_unit)


def extractor_events(entries: DataFrame, names: LogNames = LogNames()) -> DataFrame:
    """Entries with a message; the counter snapshot is JSON inside a string, bad JSON is empty."""
    fields = F.col("fields")
    return (
        extractor_entries(entries, names)
        .filter(fields["message"].isNotNull())
        .select(
            "pipeline_id",
            "seq",
            "at",
            fields["message"].alias("message"),
            F.from_json(fields["snapshot"], COUNTERS).alias("snapshot"),
            fields["idle_secs"].alias("idle_secs"),
        )
    )


def extractor_alerts(entries: DataFrame, names: LogNames = LogNames()) -> DataFrame:
    """Warnings and errors as coded alerts; the orderly idle shutdown is not one."""
    level = F.upper(F.coalesce(F.col("level"), F.col("severity"), F.lit("INFO")))
    fields = F.col("fields")
    message = F.coalesce(
        F.when(fields.isNotNull(), F.coalesce(fields["message"], F.lit(""))),
        F.col("message"),
        F.lit(""),
    )
    return (
        extractor_entries(entries, names)
        .filter(level.isin("WARN", "WARNING", "ERROR", "CRITICAL"))
        .filter(message != IDLE_SHUTDOWN)
        .select(
            "pipeline_id",
            "seq",
            "at",
            F.lit("extractor").alias("component"),
            F.when(level.isin("ERROR", "CRITICAL"), "ERROR").otherwise("WARNING").alias("severity"),
            alert_code("extractor", message).alias("code"),
        )
    )


def extractor_summary(events: DataFrame) -> DataFrame:
    """One row per pipeline. A final snapshot counts only while it is the newest snapshot."""
    position = F.struct(*LATEST)
    is_metrics = F.col("message").isin(METRICS, FINAL_METRICS)
    latest = F.max_by(F.struct("message", "at", "snapshot"), F.when(is_metrics, position))
    grouped = events.groupBy("pipeline_id").agg(
        F.max("at").alias("last_event_at"),
        latest.alias("latest"),
        F.bool_or(F.col("message") == IDLE_SHUTDOWN).alias("saw_shutdown"),
    )
    final = F.coalesce(F.col("latest.message") == FINAL_METRICS, F.lit(False))
    snapshot = F.col("latest.snapshot")
    return grouped.select(
        "pipeline_id",
        F.when(final, "clean_shutdown")
        .when(F.col("latest").isNotNull(), "observed")
        .otherwise("no_recent_session")
        .alias("status"),
        seconds_text(F.col("last_event_at")).alias("last_event_utc"),
        snapshot["last_message_ts"].alias("last_bar_utc"),
        *[
            snapshot[name].alias(name)
            for name in ("messages_received", "messages_sent", "delivery_failures", "errors")
        ],
        F.when(final, seconds_text(F.col("latest.at"))).alias("final_metrics_at_utc"),
        F.when(final & F.col("saw_shutdown"), "idle_window").alias("shutdown_reason"),
    )


def window_start(at: Column, seconds: int) -> Column:
    return F.timestamp_seconds(F.floor(F.unix_seconds(at) / F.lit(seconds)) * seconds)


def counter_windows(activity: DataFrame, seconds: int = 60) -> DataFrame:
    """Cumulative counters per component at the end of each interval that saw activity.

    ``activity`` has ``component, at, kind`` with kind received, sent, delivery_failure or error.
    Rows shrink to one per interval map-side; only those enter the running totals.
    """
    kinds = {
        "messages_received": "received",
        "messages_sent": "sent",
        "delivery_failures": "delivery_failure",
        "errors": "error",
    }
    kind = F.col("kind")
    intervals = activity.groupBy(
        "component", window_start(F.col("at"), seconds).alias("window_start")
    ).agg(
        *[F.count_if(kind == value).alias(name) for name, value in kinds.items()],
        F.max(F.when(kind == "received", F.col("at"))).alias("last_message_at"),
        F.max(F.when(kind == "sent", F.col("at"))).alias("last_delivery_at"),
    )
    times = ("last_message_at", "last_delivery_at")
    counted = intervals.withColumnsRenamed({name: f"_{name}" for name in (*kinds, *times)})
    totals = scan(
        counted, ["component"], ["window_start"],
        **{name: Running("sum", F.col(f"_{name}")) for name in kinds},
        **{name: Running("max", F.col(f"_{name}")) for name in times},
    )
    return totals.select("component", "window_start", *kinds, *times)


def idle_gaps(frames: DataFrame, idle_seconds: int = 600) -> DataFrame:
    """Stretches of at least ``idle_seconds`` without a data frame, per component.

    Two frames that far apart never share a bucket of that width, so comparing neighbouring
    buckets (earliest against previous latest) is exact and only buckets are ordered.
    """
    if idle_seconds == 0:
        frames, idle_seconds = frames.filter(F.lit(False)), 1
    buckets = frames.groupBy(
        "component", F.floor(F.unix_seconds("received_at") / F.lit(idle_seconds)).alias("_bucket")
    ).agg(F.min("received_at").alias("_first"), F.max("received_at").alias("_last"))
    ordered = scan(
        buckets, ["component"], ["_bucket"],
        last_message_at=Running("previous", F.col("_last")),
    )
    gap = F.unix_micros("resumed_at") - F.unix_micros("last_message_at")
    return (
        ordered.select("component", "last_message_at", F.col("_first").alias("resumed_at"))
        .filter(gap >= idle_seconds * 1_000_000)
        .withColumn("idle_micros", gap)
    )


def idle_now(frames: DataFrame, starts: DataFrame, now: Column, idle_seconds: int = 600) -> DataFrame:
    """Components whose last frame (or start, before any frame) is at least that long ago."""
    last = frames.groupBy("component").agg(F.max("received_at").alias("last_message_at"))
    baseline = F.coalesce("last_message_at", "started_at")
    idle = (F.unix_micros(now) - F.unix_micros(baseline)) >= idle_seconds * 1_000_000
    return starts.join(last, "component", "left").select(
        "component",
        "last_message_at",
        (F.lit(idle_seconds > 0) & idle).alias("is_idle"),
    )
