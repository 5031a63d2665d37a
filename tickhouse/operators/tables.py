"""Table metadata, snapshot history and data-file statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.functions.codes import safe_operation
from tickhouse.functions.numbers import count_value, ratio
from tickhouse.functions.times import millis_text
from tickhouse.operators.ordered import Running, scan
from tickhouse.schemas import TABLE_METADATA

# Section name and the summary key it is read from.
SUMMARY_COUNTS = {
    "latest_added_records": "added-records",
    "latest_added_data_files": "added-data-files",
    "latest_added_files_size_bytes": "added-files-size",
    "total_records": "total-records",
    "total_data_files": "total-data-files",
    "total_files_size_bytes": "total-files-size",
    "total_delete_files": "total-delete-files",
    "total_position_deletes": "total-position-deletes",
    "total_equality_deletes": "total-equality-deletes",
}


def table_section(documents: DataFrame, reason: Column | None = None) -> DataFrame:
    """Public table section from metadata text (column ``metadata``), one row in, one row out.

    Null text was never read (``reason`` says why); text that is no JSON object could not be read.
    """
    others = [c for c in documents.columns if c != "metadata"]
    parsed = documents.withColumn("_m", F.from_json("metadata", TABLE_METADATA))
    snapshots, current_id = F.col("_m.snapshots"), F.col("_m")["current-snapshot-id"]
    parsed = parsed.withColumn(
        "_current",
        F.get(F.filter(snapshots, lambda s: s["snapshot-id"] == current_id), F.lit(0)),
    )
    summary = F.col("_current.summary")
    problem = (
        F.when(F.col("metadata").isNull(), F.lit("not_configured") if reason is None else reason)
        .when(F.json_object_keys("metadata").isNull(), "read_failed")
        .when(snapshots.isNull() | current_id.isNull(), "invalid_metadata")
        .when(F.col("_current").isNull(), "missing_current_snapshot")
        .when(summary.isNull(), "missing_snapshot_summary")
    )
    counts = {
        name: count_value(F.try_element_at(summary, F.lit(key)))
        for name, key in SUMMARY_COUNTS.items()
    }
    values = {
        "last_metadata_update_utc": millis_text(F.col("_m")["last-updated-ms"]),
        "current_snapshot_commit_utc": millis_text(F.col("_current")["timestamp-ms"]),
        "latest_operation": safe_operation(
            F.coalesce(F.try_element_at(summary, F.lit("operation")), F.lit("other"))
        ),
        **counts,
        "average_rows_per_data_file": ratio(counts["total_records"], counts["total_data_files"]),
        "average_data_file_size_bytes": ratio(
            counts["total_files_size_bytes"], counts["total_data_files"]
        ),
        "snapshot_history_count": F.size(snapshots).cast("long"),
        "metadata_history_count": F.when(
            F.col("_m")["metadata-log"].isNotNull(), F.size(F.col("_m")["metadata-log"])
        ).cast("long"),
    }
    checked = parsed.withColumn("_problem", problem)
    fine = F.col("_problem").isNull()
    return checked.select(
        *others,
        F.when(fine, "available").otherwise("unavailable").alias("status"),
        F.col("_problem").alias("reason"),
        *[F.when(fine, value).alias(name) for name, value in values.items()],
    )


def running_totals(commits: DataFrame, order: tuple[str, ...] = ("committed_at",)) -> DataFrame:
    """Snapshot history: ``total_records`` and ``total_bytes`` after each commit of a table."""
    return scan(
        commits, ("table_id",), order,
        total_records=Running("sum", F.col("added_records")),
        total_bytes=Running("sum", F.col("added_bytes")),
    )


def latest_snapshot(commits: DataFrame) -> DataFrame:
    """Newest commit and current totals of each table."""
    return commits.groupBy("table_id").agg(
        F.max("committed_at").alias("committed_at"),
        F.max_by("added_records", "committed_at").alias("latest_added_records"),
        F.coalesce(F.sum("added_records"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("added_bytes"), F.lit(0)).alias("total_bytes"),
        F.count(F.lit(1)).alias("snapshot_count"),
    )


def record_counts(tables: DataFrame, commits: DataFrame) -> DataFrame:
    """Records of each table, zero for a table without a snapshot."""
    totals = commits.groupBy("table_id").agg(F.sum("added_records").alias("_records"))
    return tables.join(totals, "table_id", "left").select(
        "table_id", F.coalesce("_records", F.lit(0)).alias("record_count")
    )


def file_report(files: DataFrame, target_bytes: int) -> DataFrame:
    """Per table: file count, bytes, averages and how many files are below the target size.

    ``files``: ``table_id, file_path, file_size, record_count``.
    """
    small = F.col("file_size") < target_bytes
    return files.groupBy("table_id").agg(
        F.count(F.lit(1)).alias("data_files"),
        F.sum("file_size").alias("total_bytes"),
        F.sum("record_count").alias("total_records"),
        F.count_if(small).alias("small_files"),
    ).select(
        "*",
        ratio(F.col("total_records"), F.col("data_files")).alias("average_rows_per_data_file"),
        ratio(F.col("total_bytes"), F.col("data_files")).alias("average_data_file_size_bytes"),
    )


def bin_plan(files: DataFrame, target_bytes: int) -> DataFrame:
    """Which rewrite bin each file falls into: cumulative bytes before it over the target."""
    ordered = scan(
        files, ("table_id",), ("file_path",), _through=Running("sum", F.col("file_size"))
    )
    before = F.col("_through") - F.col("file_size")
    return ordered.withColumn(
        "bin_id", F.call_function("div", before, F.lit(target_bytes))
    ).drop("_through")


def bins(planned: DataFrame) -> DataFrame:
    return planned.groupBy("table_id", "bin_id").agg(
        F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes")
    )


def reconcile(ledger: DataFrame) -> DataFrame:
    """Received against inserted bars of every committed batch."""
    return ledger.groupBy("query_id", "batch_id").agg(
        F.sum("bars").alias("received"), F.sum("inserted").alias("inserted")
    ).withColumn("balanced", F.col("received") == F.col("inserted"))


def newest_snapshots(commits: DataFrame, count: int = 1) -> DataFrame:
    """The newest commits of each table; equal times are ordered by snapshot id where there is one."""
    order = [F.col(c).desc() for c in ("committed_at", "snapshot_id") if c in commits.columns]
    newest = Window.partitionBy("table_id").orderBy(*order)
    return commits.withColumn("newest_rank", F.row_number().over(newest)).filter(
        F.col("newest_rank") <= count
    )
