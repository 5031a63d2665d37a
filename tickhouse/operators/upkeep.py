"""Checks and dry-run plans around table maintenance."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.session import IDENTIFIER, OBJECT_DIRECTORY, PROJECT, RECEIPT_OBJECT, aware


def quiet_tables(
    samples: DataFrame, now: datetime | Column, window_seconds: int = 900, max_gap_seconds: int = 120,
    run_now: bool = False,
) -> DataFrame:
    """Which tables stayed unchanged through the whole window that ends now.

    ``samples``: ``table_id, sampled_at, metadata_version, snapshot_id``. A table is quiet when its
    samples cover the window, from before its start until now with no gap over ``max_gap_seconds``,
    and all of them show one version and one snapshot. ``reason`` is ``quiet``, ``changed``,
    ``not_covered`` (too few samples, or a gap) or ``run_now``, where the newest sample suffices.
    Samples after ``now`` do not count. The reported version is that of the newest sample.
    """
    if window_seconds < 1 or max_gap_seconds < 1:
        raise ValueError("window and gap must be positive")
    end = F.unix_micros(now if isinstance(now, Column) else F.lit(aware(now)))
    seen = F.struct("metadata_version", "snapshot_id")
    at = F.unix_micros("sampled_at")
    gap = max_gap_seconds * 1_000_000
    begin = end - window_seconds * 1_000_000
    # A sample before this cannot cover the start of the window without a gap.
    told = samples.where(at <= end).withColumn("_in", at >= begin - gap)
    order = Window.partitionBy("table_id").orderBy("sampled_at", "metadata_version", "snapshot_id")
    near = told.where("_in").select(
        "table_id", "sampled_at", seen.alias("seen"), F.lag(at).over(order).alias("_before"),
        F.lag(seen).over(order).alias("_was"), F.lead(at).over(order).alias("_after"))
    inside = at >= begin
    watched = near.where(inside | (F.coalesce("_after", end) > begin)).groupBy("table_id").agg(
        F.count(F.lit(1)).alias("samples"),
        F.min(at).alias("_first"), F.max(at).alias("_last"),
        F.max(F.when(F.col("_before") >= begin - gap, at - F.col("_before"))).alias("_widest"),
        F.min(F.when((F.col("_was") != F.col("seen")) & inside, F.col("sampled_at"))).alias("changed_at"),
    )
    newest = told.groupBy("table_id").agg(F.max_by(seen, F.struct("sampled_at", seen)).alias("newest"))
    covered = F.coalesce(
        (F.col("_first") <= begin) & (end - F.col("_last") <= gap) & (F.coalesce("_widest", F.lit(0)) <= gap),
        F.lit(False))
    reason = (
        F.when(F.lit(run_now), "run_now").when(F.col("changed_at").isNotNull(), "changed")
        .when(~covered, "not_covered").otherwise("quiet")
    )
    return newest.join(watched, "table_id", "left").select(
        "table_id", F.timestamp_micros(begin).alias("window_start"), "newest.metadata_version",
        "newest.snapshot_id", F.coalesce("samples", F.lit(0).cast("long")).alias("samples"), "changed_at",
        reason.alias("reason"), reason.isin("quiet", "run_now").alias("is_quiet"),
    )


def fence(expected: DataFrame, latest: DataFrame) -> DataFrame:
    """Expected against observed snapshot ids; only matching tables may be rewritten."""
    observed = latest.select("table_id", F.col("snapshot_id").alias("observed_id"))
    wanted = expected.select("table_id", F.col("snapshot_id").alias("expected_id"))
    return wanted.join(observed, "table_id", "left").withColumn(
        "may_rewrite", F.coalesce(F.col("expected_id") == F.col("observed_id"), F.lit(False))
    )


def expiry_plan(
    snapshots: DataFrame,
    now: datetime,
    days: int = 7,
    keep: int = 100,
    protected: DataFrame | None = None,
) -> DataFrame:
    """Snapshots that may expire (dry run): old enough, beyond the newest ``keep``, unreferenced.

    ``snapshots``: ``table_id, snapshot_id, committed_at``. Only the newest ``keep`` of a table
    are ranked, so a table with a long history is never sorted whole. The current snapshot is
    always among those kept.
    """
    if keep < 1:
        raise ValueError("keep at least the current snapshot")
    position = F.struct("committed_at", "snapshot_id")
    newest = Window.partitionBy("table_id").orderBy(
        F.col("committed_at").desc(), F.col("snapshot_id").desc()
    )
    kept = (
        snapshots.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= keep)
        .groupBy("table_id")
        .agg(F.min(position).alias("_oldest_kept"))
    )
    boundary = F.lit(aware(now) - timedelta(days=days))
    old = snapshots.filter(F.col("committed_at") < boundary)
    # Snapshots without a table name are one table, as in a window.
    named = kept.withColumnRenamed("table_id", "_table")
    plan = old.join(named, F.col("table_id").eqNullSafe(F.col("_table"))).filter(
        position < F.col("_oldest_kept")).drop("_oldest_kept", "_table")
    if protected is not None:
        plan = plan.join(protected, ["table_id", "snapshot_id"], "left_anti")
    return plan


def orphan_plan(
    listing: DataFrame, referenced: DataFrame, now: datetime, min_age: timedelta = timedelta(days=3)
) -> DataFrame:
    """Unreferenced files old enough to remove (dry run); never younger than a day.

    A reference without a path may mean any file, so then nothing may go; a file without a path never may.
    """
    if min_age < timedelta(hours=24):
        raise ValueError("orphan age must be at least 24 hours")
    old = listing.filter((F.col("modified_at") < F.lit(aware(now) - min_age)) & F.col("file_path").isNotNull())
    if referenced.filter(F.col("file_path").isNull()).limit(1).count():
        return old.limit(0)
    return old.join(referenced.select("file_path"), "file_path", "left_anti")


def name_faults(name: Column, project: Column, directory: Column, receipt: Column) -> Column:
    """Which of the submitted names and locations are malformed."""
    checks = {
        "identifier": name.rlike(IDENTIFIER),
        "project": project.rlike(PROJECT),
        "directory": directory.rlike(OBJECT_DIRECTORY),
        "receipt": receipt.rlike(RECEIPT_OBJECT),
    }
    return F.array_compact(F.array(*[
        F.when(~F.coalesce(ok, F.lit(False)), label) for label, ok in checks.items()
    ]))
