"""Frame sources and sinks: message topics when the connector is present, files otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.schemas import BAR_COLUMNS, FRAME

WIRE_TYPE = (
    "array<struct<T:string,S:string,o:double,h:double,l:double,c:double,"
    "v:bigint,t:string,n:bigint,vw:double>>"
)


def topic_options(servers: str, topic: str, max_frames: int | None = None,
                  min_frames: int | None = None, max_delay: str = "300s") -> dict[str, str]:
    """Options of the topic source: earliest first, bounded per trigger.

    ``min_frames`` with ``max_delay`` waits for enough frames or enough time, whichever is first.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    if max_frames is not None:
        options["maxOffsetsPerTrigger"] = str(max_frames)
    if min_frames is not None:
        options["minOffsetsPerTrigger"] = str(min_frames)
        options["maxTriggerDelay"] = max_delay
    return options


def landing_rows(messages: DataFrame) -> DataFrame:
    """Topic messages as landing rows; the payload text is left untouched."""
    return messages.select(
        "topic",
        F.col("partition").alias("part_id"),
        F.col("offset").alias("src_offset"),
        F.col("value").cast("string").alias("raw"),
        F.col("timestamp").alias("received_at"),
    )


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Streaming frames from a topic. Needs the Kafka connector on the classpath."""
    return landing_rows(spark.readStream.format("kafka").options(**options).load())


def read_landed(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.schema(FRAME).format(file_format).load(path)


def stream_landed(spark: SparkSession, path: str, file_format: str = "parquet",
                  max_files: int | None = None) -> DataFrame:
    """Streaming frames from landed files; ``max_files`` bounds one trigger."""
    reader = spark.readStream.schema(FRAME).format(file_format)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def frame_text(bars: Column) -> Column:
    """Array of bar structs (stored column order) as the JSON array sent on the wire."""
    return F.to_json(bars.cast(WIRE_TYPE))


def encode_frames(bars: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One frame per key group with its bars in ``order``; a group is what one message holds."""
    item = F.struct(*order, F.struct(*BAR_COLUMNS).alias("bar"))
    grouped = bars.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    return grouped.select(*keys, frame_text(F.col("_items.bar")).alias("raw"))


def write_topic(frames: DataFrame, servers: str, topic: str) -> None:
    """Publish frames as messages. Needs the Kafka connector on the classpath."""
    (
        frames.select(F.col("raw").alias("value"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
