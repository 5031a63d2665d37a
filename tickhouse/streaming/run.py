"""Run a stream until its input is read, and read back what it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tickhouse.session import checkpoint_dir

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_state(spark: SparkSession) -> SparkSession:
    """Stateful processors need the RocksDB state store; the setting counts when a query starts."""
    spark.conf.set(PROVIDER, ROCKSDB)
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tickhouse-{name}-{uuid.uuid4().hex}"


def drained(stream: DataFrame, folder: str | None = None, timers: bool = False) -> DataFrame:
    """Append what the stream yields to ``folder``/rows (default: a new one) until its input is read.

    The offsets and the state stay in ``folder``/checkpoint, so a later call with the same folder goes on.
    A stream with processing-time ``timers`` never runs out of work by itself; it is stopped after its
    first micro-batch without input, when all timers that were due have fired.
    """
    spark = with_state(stream.sparkSession)
    folder = folder or shared_path(spark, "stream")
    writer = (stream.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/rows")
              .option("checkpointLocation", f"{folder}/checkpoint"))
    if timers:
        query = writer.trigger(processingTime="0 seconds").start()
        while query.isActive and not any(p["numInputRows"] == 0 for p in query.recentProgress):
            query.awaitTermination(0.2)
        query.stop()
    else:
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")
