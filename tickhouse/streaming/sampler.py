"""A scheduled sampler of table versions, which the quiet window before a compaction is judged by.

A rate source gives the beat; each micro-batch reads the current version of every table and writes one
row per table to a folder of its own, so a batch that runs again replaces its rows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickhouse.plans.compaction import folder_state
from tickhouse.sources.metadata import read_current_metadata

SAMPLE = "table_id string, sampled_at timestamp, metadata_version string, snapshot_id string"


def metadata_sample(spark: SparkSession, folders: dict[str, str], at: datetime) -> DataFrame:
    """Version and current snapshot of tables with a metadata folder; unreadable tables give no sample."""
    return read_current_metadata(spark, folders).where("reason IS NULL").select(
        "table_id", F.lit(at).alias("sampled_at"), "metadata_version",
        F.get_json_object("metadata", "$.current-snapshot-id").alias("snapshot_id"))


def folder_sample(spark: SparkSession, folders: dict[str, str], at: datetime) -> DataFrame:
    """The digest of file names and sizes of bar folders stands for version and snapshot."""
    items = []
    for table, folder in folders.items():
        version = F.lit(folder_state(spark.read.parquet(folder))["version"])
        items.append(F.struct(F.lit(table).alias("table_id"), F.lit(at).alias("sampled_at"),
                              version.alias("metadata_version"), version.alias("snapshot_id")))
    # Literals over a one-row range: no Python worker is started inside the streaming batch.
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*items)))


SAMPLERS: dict[str, Callable[[SparkSession, dict[str, str], datetime], DataFrame]] = {
    "metadata": metadata_sample, "folder": folder_sample,
}


def start_sampler(
    spark: SparkSession, folders: dict[str, str], samples: str, kind: str = "metadata", interval: int = 60,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
) -> StreamingQuery:
    take = SAMPLERS[kind]

    def write(_: DataFrame, batch_id: int) -> None:
        take(spark, folders, clock()).coalesce(1).write.mode("overwrite").parquet(f"{samples}/rows/batch_id={batch_id}")

    beat = spark.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    return beat.writeStream.foreachBatch(write).option("checkpointLocation", f"{samples}/checkpoint").trigger(
        processingTime=f"{interval} seconds").start()


def sample_tables(
    spark: SparkSession, folders: dict[str, str], samples: str, kind: str = "metadata", interval: int = 60,
    count: int | None = None,
) -> None:
    """Sample until stopped, or until ``count`` micro-batches are done."""
    query = start_sampler(spark, folders, samples, kind, interval)
    if count is None:
        query.awaitTermination()
        return
    while query.isActive and not any(p["batchId"] + 1 >= count for p in query.recentProgress):
        query.awaitTermination(1)
    query.stop()


def read_samples(spark: SparkSession, samples: str) -> DataFrame:
    return spark.read.schema(SAMPLE).parquet(f"{samples}/rows").select(*[f.split()[0] for f in SAMPLE.split(", ")])
