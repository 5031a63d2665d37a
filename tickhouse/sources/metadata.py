"""Current table metadata: the version hint, then exactly the document it names."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HINT_FILE = "version-hint.text"
VERSION = r"[1-9][0-9]*"


def read_current_metadata(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """``table_id, metadata_version, metadata, reason`` for a metadata folder per table.

    A scan needs its file names when it is planned, so one hint line per listed table comes to the
    driver; the documents stay on the executors. A table whose folder, hint or document is absent,
    or whose hint is malformed, is ``read_failed`` by itself and no other document of it is opened.
    """
    tables = {_bare(folder.rstrip("/")): table for table, folder in folders.items()}
    hints = _texts(spark, [f"{f.rstrip('/')}/{HINT_FILE}" for f in folders.values()])
    versions = {} if hints is None else {
        tables[_bare(row["folder"])]: row["text"].strip()
        for row in hints.select("folder", "text").collect()
    }
    wanted = {
        table: f"{folder.rstrip('/')}/v{versions[table]}.metadata.json"
        for table, folder in folders.items() if re.fullmatch(VERSION, versions.get(table, ""))
    }
    # Literals, so that the read also works inside a streaming batch, where no Python worker should start.
    listed = F.array(*[
        F.struct(F.lit(t).alias("table_id"),
                 F.lit(versions[t] if t in wanted else None).alias("metadata_version"),
                 F.lit(_bare(wanted[t]) if t in wanted else None).alias("document_path"))
        for t in folders
    ]).cast("array<struct<table_id:string,metadata_version:string,document_path:string>>")
    keys = spark.range(1, numPartitions=1).select(F.inline(listed))
    documents = _texts(spark, list(wanted.values()))
    if documents is None:
        read = keys.withColumn("metadata", F.lit(None).cast("string"))
    else:
        bare = F.regexp_replace("path", "^[a-z0-9]+:/+", "/")
        found = documents.select(bare.alias("document_path"), F.col("text").alias("metadata"))
        read = keys.join(found, "document_path", "left")
    failed = F.when(F.col("metadata").isNull(), "read_failed")
    return read.select(
        "table_id", F.when(F.col("metadata").isNotNull(), F.col("metadata_version"))
        .alias("metadata_version"), "metadata", failed.alias("reason"),
    )


def _present(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _texts(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """Whole texts of the files that exist; None if none does."""
    found = [path for path in paths if _present(spark, path)]
    if not found:
        return None
    path = F.col("_metadata.file_path")
    return spark.read.text(found, wholetext=True).select(
        path.alias("path"),
        F.regexp_replace(path, "/[^/]*$", "").alias("folder"),
        F.col("value").alias("text"),
    )


def _bare(path: str) -> str:
    return re.sub(r"^[a-z0-9]+:/+", "/", path)
