"""Reading, building and writing status documents in one call."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.operators.costs import decode_row_payload
from tickhouse.plans.status import document_json, leaks, status_documents
from tickhouse.schemas import COST_SNAPSHOT_TEXT
from tickhouse.session import at_most_one, aware, exactly_one
from tickhouse.settings import LogNames, Thresholds
from tickhouse.sources.logs import log_entries, read_log_export
from tickhouse.sources.metadata import read_current_metadata
from tickhouse.sources.sinks import write_documents

DEFAULT = "default"


def _unread(spark: SparkSession, column: str) -> DataFrame:
    return spark.range(1).select(
        F.lit(DEFAULT).alias("pipeline_id"),
        F.lit(None).cast("string").alias(column),
        F.lit("read_failed").alias("reason"),
    )


def _document(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One whole JSON file for the default pipeline; a missing one is a reason, not a failure."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return _unread(spark, column)
    return text.select(
        F.lit(DEFAULT).alias("pipeline_id"),
        F.col("value").alias(column),
        F.lit(None).cast("string").alias("reason"),
    )


def read_costs(documents: DataFrame, row_encoded: bool) -> DataFrame:
    """Text snapshots from ``pipeline_id, document, reason``; undecodable ones were not read."""
    text = F.col("document")
    decoded = decode_row_payload(text) if row_encoded else F.when(
        F.json_object_keys(text).isNotNull(), F.from_json(text, COST_SNAPSHOT_TEXT)
    )
    rows = documents.withColumn("_s", decoded)
    why = F.coalesce("reason", F.when(F.col("_s").isNull(), "read_failed"))
    return rows.select("pipeline_id", "_s.*", why.alias("reason"))


def export_status(
    spark: SparkSession,
    output: str,
    now: datetime,
    saved_entries: str | None = None,
    live_entries: DataFrame | None = None,
    metadata_document: str | None = None,
    metadata_folders: dict[str, str] | None = None,
    cost_document: str | None = None,
    cost_rows: str | None = None,
    since: datetime | None = None,
    newest: dict[str, int] | None = None,
    json_lines: bool = False,
    forbidden: tuple[str, ...] = (),
    limits: Thresholds = Thresholds(),
    names: LogNames = LogNames(),
) -> DataFrame:
    """Write one status document per pipeline and return them.

    Give either a saved export (``json_lines``: one entry per line, which Spark can split) or live
    entries. Every entry counts unless ``since`` or ``newest`` bound the read. Table metadata and
    costs are optional: when they cannot be read their section says so and the rest of the document
    is unaffected. ``metadata_folders`` maps a pipeline to its table's metadata folder. Nothing is
    written if a document holds a location, a local path, a UUID, an exception's name or one of the
    ``forbidden`` texts.
    """
    exactly_one(saved_entries, live_entries, "give exactly one of saved or live entries")
    at_most_one(metadata_document, metadata_folders, "give at most one table metadata input")
    at_most_one(cost_document, cost_rows, "give at most one cost snapshot input")
    aware(now)
    entries, pipelines = live_entries, None
    if saved_entries is not None:
        raw = read_log_export(spark, saved_entries, json_lines=json_lines)
        entries = log_entries(raw, F.lit(now))
        pipelines = spark.range(1).select(F.lit(DEFAULT).alias("pipeline_id"))
    metadata = costs = None
    if metadata_document is not None:
        metadata = _document(spark, metadata_document, "metadata")
    elif metadata_folders is not None:
        metadata = read_current_metadata(spark, metadata_folders).withColumnRenamed(
            "table_id", "pipeline_id"
        )
    if cost_document is not None or cost_rows is not None:
        documents = _document(spark, cost_document or cost_rows, "document")
        costs = read_costs(documents, row_encoded=cost_rows is not None)
    report = status_documents(
        entries, now, pipelines, metadata, costs, limits, names, since, newest
    )
    documents = document_json(report)
    found = leaks(documents, list(forbidden)).limit(1).collect()
    if found:
        kinds = [t if t not in forbidden else "forbidden text" for t in found[0]["tokens"]]
        raise ValueError(f"a status document contains {', '.join(kinds)}; nothing was written")
    write_documents(documents, output)
    return documents
