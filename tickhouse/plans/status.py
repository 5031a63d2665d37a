"""The status document: one row per pipeline from logs, table metadata and costs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.functions.market import freshness, market_state, next_open
from tickhouse.functions.times import lenient_instant, seconds_text
from tickhouse.operators.alerts import alert_array, all_alerts, error_marks
from tickhouse.operators.costs import cost_section
from tickhouse.operators.extractor import (
    extractor_alerts,
    extractor_events,
    extractor_summary,
)
from tickhouse.operators.journal import classify_logs, newest_per_class
from tickhouse.operators.loader import (
    failure_counts,
    loader_alerts,
    loader_events,
    loader_summary,
)
from tickhouse.operators.tables import table_section
from tickhouse.schemas import COST_SNAPSHOT_TEXT
from tickhouse.session import aware, checkpoint_dir
from tickhouse.settings import LogNames, Thresholds

SCHEMA_VERSION = 3


def with_health(rows: DataFrame, now: Column, limits: Thresholds = Thresholds()) -> DataFrame:
    """Add ``health`` struct(status, reasons) to rows with ``state, extractor, loader, open_error``.

    The checks apply in order and later ones may overwrite the status. Each step is its own
    projection, so no text is parsed and no grade computed more than once.
    """
    state, extractor, loader = F.col("state"), F.col("extractor"), F.col("loader")
    is_open = state == "market_open"
    steps = rows.withColumns({
        "_bar_at": lenient_instant(extractor["last_bar_utc"]),
        "_commit_at": lenient_instant(loader["last_commit_utc"]),
        "_beat_at": lenient_instant(loader["latest_heartbeat_utc"]),
        "_awaiting": (state == "settling") & extractor["final_metrics_at_utc"].isNull(),
        "_silent": state.isin("closed", "weekend", "pre_open") & (
            F.coalesce(extractor["status"], F.lit("no_recent_session")) == "no_recent_session"
        ),
        "_stalled": F.coalesce(loader["state"] == "stalled", F.lit(False)),
    })
    status, reason = freshness(
        "extractor_bar", F.lit("healthy"), F.col("_bar_at"), now, limits.bar_warning,
        limits.bar_unhealthy,
    )
    steps = steps.withColumns({"_bar_status": status, "_bar_reason": F.when(is_open, reason)})
    status, reason = freshness(
        "loader_commit", F.col("_bar_status"), F.col("_commit_at"), now, limits.commit_warning,
        limits.commit_unhealthy,
    )
    session = (
        F.when(is_open, status)
        .when(F.col("_awaiting"), "warning")
        .when(F.col("_silent"), "unknown")
        .otherwise("healthy")
    )
    steps = steps.withColumns({"_session": session, "_commit_reason": F.when(is_open, reason)})
    status, reason = freshness(
        "loader_heartbeat", F.col("_session"), F.col("_beat_at"), now, limits.heartbeat_warning,
        limits.heartbeat_unhealthy,
    )
    forced = F.col("_stalled") | F.col("open_error")
    reasons = F.array_compact(F.array(
        F.col("_bar_reason"),
        F.col("_commit_reason"),
        F.when(F.col("_awaiting"), "awaiting_clean_shutdown"),
        F.when(F.col("_silent"), "no_recent_session"),
        reason,
        F.when(F.col("_stalled"), "loader_stalled"),
        F.when(F.col("open_error"), "recent_error"),
    ))
    health = F.struct(
        F.when(forced, "unhealthy").otherwise(status).alias("status"), reasons.alias("reasons")
    )
    return steps.select(*rows.columns, health.alias("health"))


def _struct(df: DataFrame, name: str) -> DataFrame:
    return df.select("pipeline_id", F.struct(*[c for c in df.columns if c != "pipeline_id"]).alias(name))


def _filled(section: Column, defaults: dict[str, Column], names: list[str]) -> Column:
    return F.struct(*[
        F.coalesce(section[n], defaults[n]).alias(n) if n in defaults else section[n].alias(n)
        for n in names
    ])


def status_documents(
    entries: DataFrame,
    now: datetime,
    pipelines: DataFrame | None = None,
    metadata: DataFrame | None = None,
    costs: DataFrame | None = None,
    limits: Thresholds = Thresholds(),
    names: LogNames = LogNames(),
    since: datetime | None = None,
    newest: dict[str, int] | None = None,
) -> DataFrame:
    """Sections of the document, one row per pipeline.

    ``entries``: normalised log entries. ``pipelines`` lists the pipelines to report even when
    silent (default: those with entries that count). ``metadata``: ``pipeline_id, metadata[, reason]``;
    ``costs``: ``pipeline_id`` and text snapshot columns ``[, reason]``. Every entry counts unless
    the caller bounds the read: ``since`` leaves out older entries, ``newest`` keeps that many of
    each log class. The failure count is taken before ``newest`` cuts, and its flag tells a cut.
    """
    at_now = F.lit(aware(now))
    entries = entries.filter(F.col("unit").isin(names.extractor_unit, names.loader_unit))
    if since is not None:
        entries = entries.filter(F.col("at") >= F.lit(aware(since, "since")))
    # Every section below reads these entries: the log itself is scanned and parsed once.
    checkpoint_dir(entries.sparkSession)
    entries = entries.checkpoint()
    totals = None
    if newest is not None:
        totals = failure_counts(loader_events(entries, names))
        entries = newest_per_class(classify_logs(entries, names=names), newest).drop("log_class")
        entries = entries.checkpoint()
    if pipelines is None:
        pipelines = entries.select("pipeline_id").distinct()
    loader_rows = loader_events(entries, names)
    alerts = all_alerts(extractor_alerts(entries, names), loader_alerts(loader_rows))
    extractor = _struct(extractor_summary(extractor_events(entries, names)), "extractor")
    loader = _struct(loader_summary(loader_rows, limits, totals), "loader")
    joined = pipelines.select("pipeline_id")
    for part in (extractor, loader, error_marks(alerts), alert_array(alerts, limits.alert_limit)):
        joined = joined.join(part, "pipeline_id", "left")
    extractor_names = extractor.schema["extractor"].dataType.names
    loader_names = loader.schema["loader"].dataType.names
    no_extractor = {"status": F.lit("no_recent_session")}
    no_loader = {
        "status": F.lit("no_recent_signal"),
        "partitions": F.array(),
        "failure_count": F.lit(0).cast("long"),
        "failure_count_is_capped": F.lit(False),
        "recent_commits": F.array(),
    }
    joined = joined.withColumn(
        "extractor", _filled(F.col("extractor"), no_extractor, extractor_names)
    ).withColumn("loader", _filled(F.col("loader"), no_loader, loader_names))
    last_commit = lenient_instant(F.col("loader.last_commit_utc"))
    loader_error = F.col("last_loader_error_at")
    open_error = F.coalesce("has_other_error", F.lit(False)) | F.coalesce(
        loader_error.isNotNull() & (last_commit.isNull() | (loader_error > last_commit)),
        F.lit(False),
    )
    joined = joined.withColumns({"state": market_state(at_now), "open_error": open_error})
    report = with_health(joined, at_now, limits).select(
        "pipeline_id",
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        seconds_text(at_now).alias("generated_at_utc"),
        F.struct(
            "state", seconds_text(next_open(at_now)).alias("next_expected_open_utc")
        ).alias("market"),
        "health",
        "extractor",
        "loader",
        F.coalesce("alerts", F.array()).alias("alerts"),
    )
    for section in (_table(pipelines, metadata), _costs(pipelines, costs, at_now)):
        report = report.join(section, "pipeline_id", "left")
    return report


def _read(pipelines: DataFrame, given: DataFrame | None, empty: dict[str, str]) -> DataFrame:
    """One row per pipeline with what was read for it; ``read_reason`` says why nothing was."""
    keys = pipelines.select("pipeline_id")
    if given is None:
        nothing = {name: F.lit(None).cast(kind) for name, kind in empty.items()}
        return keys.withColumns({**nothing, "read_reason": F.lit("not_configured")})
    if "reason" not in given.columns:
        given = given.withColumn("reason", F.lit(None).cast("string"))
    read = given.select("pipeline_id", *empty, F.col("reason").alias("read_reason"))
    return keys.join(read, "pipeline_id", "left").fillna("not_configured", ["read_reason"])


def _table(pipelines: DataFrame, metadata: DataFrame | None) -> DataFrame:
    read = _read(pipelines, metadata, {"metadata": "string"})
    return _struct(table_section(read, F.col("read_reason")).drop("read_reason"), "table")


def _costs(pipelines: DataFrame, costs: DataFrame | None, now: Column) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in COST_SNAPSHOT_TEXT.fields}
    read = _read(pipelines, costs, kinds)
    return _struct(cost_section(read, now, F.col("read_reason")).drop("read_reason"), "costs")


def document_json(report: DataFrame) -> DataFrame:
    """``pipeline_id, document``: pretty JSON with sorted keys and nulls kept."""
    fields = {f.name: f.dataType for f in report.schema.fields if f.name != "pipeline_id"}

    def ordered(value: Column, kind) -> Column:
        if kind.typeName() == "struct":
            inner = F.struct(*[
                ordered(value[name], kind[name].dataType).alias(name) for name in sorted(kind.names)
            ])
            return F.when(value.isNotNull(), inner)
        if kind.typeName() == "array" and kind.elementType.typeName() == "struct":
            return F.transform(value, lambda item: ordered(item, kind.elementType))
        return value

    body = F.struct(*[ordered(F.col(name), fields[name]).alias(name) for name in sorted(fields)])
    text = F.to_json(body, {"pretty": "true", "ignoreNullFields": "false"})
    return report.select("pipeline_id", text.alias("document"))


# What no public document may hold, whoever asks: storage locations and local paths, UUIDs,
# class names of exceptions, and a failure's stack frames.
PRIVATE = {
    "location": r"(?i)\b(?:gs|s3a?|hdfs|abfss?|file)://",
    "local_path": r"(?:^|[\s\"'=(])/(?:home|root|var|etc|opt|usr|tmp|mnt|srv)/",
    "uuid": r"(?i)\b[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\b",
    "exception": r"\b[A-Za-z_$][\w$]*(?:Exception|Error)\b",
    "stack_frame": r"\bat [\w.$]+\([\w.]+:\d+\)",
}


def leaks(documents: DataFrame, forbidden: list[str]) -> DataFrame:
    """Public-boundary check: documents that hold a forbidden text or anything of a private kind.

    ``tokens`` names the texts, and the kinds of ``PRIVATE`` that were found.
    """
    body = F.col("document")
    found = [F.when(body.contains(token), F.lit(token)) for token in forbidden]
    found += [F.when(body.rlike(pattern), F.lit(kind)) for kind, pattern in PRIVATE.items()]
    tokens = F.array_compact(F.array(*found))
    return documents.select("pipeline_id", tokens.alias("tokens")).filter(F.size("tokens") > 0)
