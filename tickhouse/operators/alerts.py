"""Alerts of all components: union, newest first, and which errors are still open."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.functions.times import seconds_text


def all_alerts(*sources: DataFrame) -> DataFrame:
    merged = sources[0]
    for other in sources[1:]:
        merged = merged.unionByName(other)
    return merged


def newest_alerts(alerts: DataFrame, limit: int = 20) -> DataFrame:
    """Newest first by second; within a second the entry read first comes first."""
    newest = Window.partitionBy("pipeline_id").orderBy(
        F.date_trunc("second", "at").desc(), F.col("seq"), F.col("component")
    )
    return alerts.withColumn("alert_rank", F.row_number().over(newest)).filter(
        F.col("alert_rank") <= limit
    )


def alert_array(alerts: DataFrame, limit: int = 20) -> DataFrame:
    shown = {
        "at_utc": seconds_text(F.col("at")),
        "component": F.col("component"),
        "severity": F.col("severity"),
        "code": F.col("code"),
    }
    item = F.struct("alert_rank", *[value.alias(name) for name, value in shown.items()])
    ordered = F.array_sort(F.collect_list(item))
    return newest_alerts(alerts, limit).groupBy("pipeline_id").agg(
        F.transform(ordered, lambda a: F.struct(*[a[name].alias(name) for name in shown])).alias(
            "alerts"
        )
    )


def unresolved(alerts: DataFrame, last_commits: DataFrame) -> DataFrame:
    """ERROR alerts still open: loader errors only while no later commit succeeded."""
    at = F.date_trunc("second", "at")
    still_open = (
        (F.col("component") != "loader")
        | F.col("last_commit_at").isNull()
        | (at > F.col("last_commit_at"))
    )
    return (
        alerts.filter(F.col("severity") == "ERROR")
        .join(last_commits.select("pipeline_id", "last_commit_at"), "pipeline_id", "left")
        .filter(still_open)
    )


def error_marks(alerts: DataFrame) -> DataFrame:
    """Per pipeline what the health roll-up needs: any other error, newest loader error."""
    error = F.col("severity") == "ERROR"
    loader = F.col("component") == "loader"
    return alerts.groupBy("pipeline_id").agg(
        F.bool_or(error & ~loader).alias("has_other_error"),
        F.max(F.when(error & loader, F.date_trunc("second", "at"))).alias("last_loader_error_at"),
    )
