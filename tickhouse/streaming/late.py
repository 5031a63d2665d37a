"""Rows that come too late for a watermark, kept and counted instead of dropped.

The splitter is the ``foreachBatch`` body of a first query. It knows the watermark of a micro-batch, the
newest time of all earlier batches less the delay, from the row that the batch before wrote, and stores
the batch once, divided by ``is_late``. The deduplicating view streams the rows that are not late. Its own
watermark follows the same times in batches that are never finer, so it finds none of them late:
kept rows, copies and late rows add up to the input.

Every output of a batch replaces what an earlier attempt of the same batch wrote.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

LEDGER = "input_rows bigint, late_rows bigint, watermark_us bigint, newest_us bigint"


@dataclass(frozen=True)
class LateSplitter:
    folder: str
    time_col: str = "ingested_at"
    delay_seconds: int = 86_400

    def _newest_before(self, spark: SparkSession, batch_id: int) -> int | None:
        if batch_id == 0:
            return None
        return spark.read.schema(LEDGER).parquet(f"{self.folder}/ledger/batch_id={batch_id - 1}").first()["newest_us"]

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        before = self._newest_before(spark, batch_id)
        watermark = None if before is None else before - self.delay_seconds * 1_000_000
        at = F.unix_micros(self.time_col)
        late = F.coalesce(at < F.lit(watermark).cast("long"), F.lit(False))
        counted = Observation()
        rows.withColumn("is_late", late).observe(
            counted, F.count(F.lit(1)).alias("input_rows"), F.count_if("is_late").alias("late_rows"),
            F.max(F.unix_micros(self.time_col)).alias("newest_us"),
        ).write.mode("overwrite").partitionBy("is_late").parquet(f"{self.folder}/rows/batch_id={batch_id}")
        found = counted.get
        newest = max((t for t in (before, found["newest_us"]) if t is not None), default=None)
        values = {"input_rows": found["input_rows"], "late_rows": found["late_rows"],
                  "watermark_us": watermark, "newest_us": newest}
        spark.range(1, numPartitions=1).select(
            *[F.lit(v).cast("long").alias(n) for n, v in values.items()]
        ).write.mode("overwrite").parquet(f"{self.folder}/ledger/batch_id={batch_id}")


def start_split(rows: DataFrame, splitter: LateSplitter, available_now: bool = True,
                interval: str = "60 seconds") -> StreamingQuery:
    stream = rows.writeStream.foreachBatch(splitter).option("checkpointLocation", f"{splitter.folder}/checkpoint")
    return (stream.trigger(availableNow=True) if available_now else stream.trigger(processingTime=interval)).start()


def _stored(spark: SparkSession, splitter: LateSplitter) -> DataFrame:
    rows = spark.read.parquet(f"{splitter.folder}/rows")
    return rows.withColumn("is_late", F.col("is_late").cast("string"))


def stream_on_time(spark: SparkSession, splitter: LateSplitter, max_files: int | None = None) -> DataFrame:
    """The rows that were in time, as a stream for ``stream_deduplicated``."""
    reader = spark.readStream.schema(_stored(spark, splitter).schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{splitter.folder}/rows").where("is_late = 'false'").drop("is_late", "batch_id")


def late_rows(spark: SparkSession, splitter: LateSplitter) -> DataFrame:
    return _stored(spark, splitter).where("is_late = 'true'").drop("is_late")


def late_ledger(spark: SparkSession, splitter: LateSplitter) -> DataFrame:
    """Per micro-batch: rows, late rows and the watermark that they were held against."""
    ledger = spark.read.option("basePath", f"{splitter.folder}/ledger").parquet(f"{splitter.folder}/ledger")
    return ledger.select(
        "batch_id", "input_rows", "late_rows", F.timestamp_micros("watermark_us").alias("watermark"),
        F.timestamp_micros("newest_us").alias("newest_at"))
