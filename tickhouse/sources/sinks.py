"""Overwriting sinks of reports and receipts."""

from __future__ import annotations

import json
import re
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.session import RECEIPT_OBJECT


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON document per pipeline, in a folder named after it."""
    documents.select("pipeline_id", F.col("document").alias("value")).write.mode(
        "overwrite"
    ).partitionBy("pipeline_id").text(path)


def write_snapshot(snapshot: DataFrame, path: str) -> None:
    """Replace the one-row cost snapshot."""
    snapshot.coalesce(1).write.mode("overwrite").parquet(path)


def snapshot_text(snapshot: DataFrame) -> DataFrame:
    """A stored cost snapshot in the text form the cost section validates."""
    def text(name):
        return F.col(name).cast("string").alias(name)

    def items(name, label):
        return F.transform(name, lambda i: F.struct(
            i[label].alias(label), i["net_cost"].cast("string").alias("net_cost")
        )).alias(name)

    return snapshot.select(
        F.col("aggregated_at").cast("string").alias("aggregated_at_utc"),
        F.col("source_exported_at").cast("string").alias("source_exported_at_utc"),
        "currency", text("seven_day_net_cost"), text("month_to_date_net_cost"),
        items("daily_costs", "day_utc"), items("top_services", "service_name"),
    )


def write_receipt(spark: SparkSession, path: str, receipt: dict[str, Any]) -> dict[str, Any]:
    """Replace a receipt, one JSON object in one file, and read it back."""
    if not path.endswith(".json") or (path.startswith("gs:") and not re.match(RECEIPT_OBJECT, path)):
        raise ValueError(f"not a place for a receipt: {path!r}")
    text = json.dumps(receipt, sort_keys=True)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if read_receipt(spark, path) != json.loads(text):
        raise RuntimeError("receipt read-back differs")
    return receipt


def read_receipt(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads(spark.read.text(path).first()["value"])
