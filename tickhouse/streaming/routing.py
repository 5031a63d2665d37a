"""Journal lines into three sinks in one streaming pass.

A micro-batch is routed before anything is parsed and written once, divided by route, into a folder of its
own: a batch that runs again replaces its lines in all three sinks, and a line is in one of them at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickhouse.operators.journal import parse_routed, route_journal
from tickhouse.settings import JournalNames

LINES = "pipeline_id string, seq bigint, at timestamp, unit string, identifier string, message string"
PLAIN, EXTRACTOR, LOADER = "plain", "extractor_json", "loader_health"


def router(folder: str, names: JournalNames = JournalNames()) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` body."""
    def write(lines: DataFrame, batch_id: int) -> None:
        route_journal(lines, names).write.mode("overwrite").partitionBy("route").parquet(
            f"{folder}/batch_id={batch_id}")

    return write


def start_routing(lines: DataFrame, folder: str, checkpoint: str, names: JournalNames = JournalNames(),
                  available_now: bool = True, interval: str = "60 seconds") -> StreamingQuery:
    stream = lines.writeStream.foreachBatch(router(folder, names)).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if available_now else stream.trigger(processingTime=interval)).start()


def sink(spark: SparkSession, folder: str, route: str) -> DataFrame:
    """One sink: plain lines as they came, the two others as parsed log entries. Other routes are not read."""
    rows = spark.read.schema(f"{LINES}, batch_id bigint, route string").option("basePath", folder).parquet(
        folder).where(F.col("route") == route)
    return rows.drop("batch_id", "route") if route == PLAIN else parse_routed(rows.drop("batch_id"))
