"""Log routing and the bounded newest-first reads behind a status document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.functions.codes import is_failure, normal_event
from tickhouse.functions.times import lenient_instant
from tickhouse.schemas import HEALTH_PAYLOAD
from tickhouse.settings import (
    COMMIT_STARTED,
    COMMIT_SUCCEEDED,
    FINAL_METRICS,
    HEALTH_PREFIX,
    HEARTBEAT,
    IDLE_SHUTDOWN,
    METRICS,
    JournalNames,
    LogNames,
)

ALERT_LEVELS = ("WARN", "WARNING", "ERROR", "CRITICAL", "ALERT", "EMERGENCY")


def journal_route(names: JournalNames = JournalNames()) -> Column:
    """plain, extractor_json, loader_health or null (not kept) for ``unit, identifier, message``.

    Decided on the raw line, before any parsing, so a line can only take one route.
    """
    unit, identifier, message = F.col("unit"), F.col("identifier"), F.col("message")
    text = F.coalesce(message, F.lit(""))
    from_loader = F.coalesce(unit == names.loader_unit, F.lit(False))
    ours = F.coalesce(unit.isin(*names.pipeline_units), F.lit(False))
    lifecycle = F.coalesce(identifier == "systemd", F.lit(False)) & text.rlike(
        names.lifecycle_pattern
    )
    return (
        F.when(F.coalesce(unit.isin(*names.extractor_units), F.lit(False)), "extractor_json")
        .when(from_loader & text.startswith(HEALTH_PREFIX), "loader_health")
        .when(from_loader & text.rlike(names.telemetry_pattern), F.lit(None))
        .when(ours | lifecycle, "plain")
    )


def route_journal(lines: DataFrame, names: JournalNames = JournalNames()) -> DataFrame:
    """Kept lines with their route; a filter and a projection, no shuffle."""
    return lines.withColumn("route", journal_route(names)).filter(F.col("route").isNotNull())


def health_payload(message: Column) -> Column:
    """Parsed ``LOADER_HEALTH {json}`` payload; null fields when the text does not match."""
    text = F.regexp_extract(message, r"^LOADER_HEALTH (\{.*\})$", 1)
    return F.from_json(text, HEALTH_PAYLOAD)


def parse_routed(routed: DataFrame) -> DataFrame:
    """Routed JSON lines as log entries; the loader's level becomes its severity."""
    health = F.col("route") == "loader_health"
    payload = F.when(health, health_payload(F.col("message"))).otherwise(
        F.from_json("message", HEALTH_PAYLOAD)
    )
    parsed = routed.filter(F.col("route") != "plain").withColumn("_payload", payload)
    at = F.coalesce(lenient_instant(F.col("_payload.timestamp")), F.col("at"))
    return parsed.select(
        "pipeline_id",
        "seq",
        at.alias("at"),
        "unit",
        F.col("_payload.level").alias("level"),
        F.when(health, F.col("_payload.level")).alias("severity"),
        F.col("_payload.target").alias("target"),
        F.col("message"),
        F.col("_payload.fields").alias("fields"),
    )


def log_class(names: LogNames = LogNames(), strict: bool = False) -> Column:
    """Which of the four bounded reads an entry belongs to; null entries are never read.

    Works on ``unit, level, severity, target, fields``. Severity falls back to level because the
    extractor stream carries only a level.
    """
    fields = F.col("fields")
    severity = F.upper(F.coalesce(F.col("severity"), F.col("level")))
    extractor = (F.col("unit") == names.extractor_unit) & (
        fields["message"].isin(METRICS, FINAL_METRICS, IDLE_SHUTDOWN)
        | F.coalesce(severity.isin(*ALERT_LEVELS), F.lit(False))
    )
    loader = (F.col("unit") == names.loader_unit) & (F.col("target") == names.health_target)
    if names.topics is not None:
        loader = loader & fields["topic"].isin(*names.topics)
    event = normal_event(fields["event"], fields["failure_type"], strict)
    return (
        F.when(extractor, "extractor")
        .when(loader & (event == HEARTBEAT), "loader_heartbeats")
        .when(loader & event.isin(COMMIT_STARTED, COMMIT_SUCCEEDED), "loader_commits")
        .when(loader & is_failure(event), "loader_failures")
    )


def classify_logs(
    entries: DataFrame, since: Column | None = None, names: LogNames = LogNames()
) -> DataFrame:
    """Entries of the four classes (not older than ``since``), in one pass over the log."""
    if since is not None:
        entries = entries.filter(F.col("at") >= since)
    return entries.withColumn("log_class", log_class(names)).filter(F.col("log_class").isNotNull())


def newest_per_class(classified: DataFrame, limits: dict[str, int]) -> DataFrame:
    """The newest N entries of each class and pipeline; classes without a limit are left out.

    The constant bound lets Spark cut each input task to N rows per group before the shuffle.
    """
    newest = Window.partitionBy("pipeline_id", "log_class").orderBy(
        F.col("at").desc(), F.col("seq").desc()
    )
    own = F.lit(0)
    for name, limit in limits.items():
        own = F.when(F.col("log_class") == name, limit).otherwise(own)
    return (
        classified.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= max(limits.values()))
        .filter(F.col("_rank") <= own)
        .drop("_rank")
    )
