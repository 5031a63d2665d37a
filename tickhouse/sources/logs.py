"""Exported log entries and journal lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.functions.times import lenient_instant
from tickhouse.schemas import JOURNAL_LINE, LOG_ENTRY


def read_log_export(
    spark: SparkSession, path: str | list[str], pipeline: Column | None = None,
    json_lines: bool = False,
) -> DataFrame:
    """Raw entries from exported JSON: whole documents (an array each) or one entry per line.

    ``json_lines`` exports are splittable; whole-document ones are meant for the bounded reads.
    ``pipeline`` may use ``_metadata.file_path`` to name a pipeline per file.
    """
    raw = spark.read.schema(LOG_ENTRY).option("multiLine", str(not json_lines).lower()).json(path)
    name = F.lit("default") if pipeline is None else pipeline
    return raw.select("*", name.alias("pipeline_id"))


def stream_log_export(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(LOG_ENTRY)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path).withColumn("pipeline_id", F.lit("default"))


def log_entries(raw: DataFrame, now: Column) -> DataFrame:
    """Normalised entries. ``seq`` is the reading order, which breaks ties between equal times."""
    payload = F.col("jsonPayload")
    at = F.coalesce(
        lenient_instant(F.col("timestamp")), lenient_instant(payload["timestamp"]), now
    )
    return raw.select(
        "pipeline_id",
        F.monotonically_increasing_id().alias("seq"),
        at.alias("at"),
        payload["_SYSTEMD_UNIT"].alias("unit"),
        payload["level"].alias("level"),
        payload["severity"].alias("severity"),
        payload["target"].alias("target"),
        payload["MESSAGE"].alias("message"),
        payload["fields"].alias("fields"),
    )


def journal_lines(raw: DataFrame, pipeline: Column, now: Column) -> DataFrame:
    return raw.select(
        pipeline.alias("pipeline_id"),
        F.monotonically_increasing_id().alias("seq"),
        F.coalesce(lenient_instant(F.col("timestamp")), now).alias("at"),
        F.col("_SYSTEMD_UNIT").alias("unit"),
        F.col("SYSLOG_IDENTIFIER").alias("identifier"),
        F.col("MESSAGE").alias("message"),
    )


def read_journal(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(JOURNAL_LINE).json(path)
