"""Files as rows: what lies below a folder, and what a table refers to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.session import table_parts


def bare_path(path: Column) -> Column:
    """A location without scheme and authority, so that listings and references compare."""
    return F.regexp_replace(path, r"^[a-zA-Z][a-zA-Z0-9+.-]*:(?://[^/]*)?", "")


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``file_path, file_size, modified_at`` of all files below a folder, hidden ones left out.

    Spark lists large trees in parallel tasks; the content column is not selected, so no file is read.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", pattern).load(folder)
    return found.select(
        bare_path(F.col("path")).alias("file_path"), F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified_at"))


def referenced_by_table(spark: SparkSession, table: str) -> DataFrame:
    """Data files that any snapshot of an Iceberg table refers to. Needs the Iceberg runtime."""
    name = ".".join(table_parts(table))
    return spark.table(f"{name}.all_data_files").select(bare_path(F.col("file_path")).alias("file_path")).distinct()


def referenced_by_generations(generations: DataFrame) -> DataFrame:
    """Files that any kept generation of a bar folder refers to (``plans.rewrite``)."""
    return generations.select(bare_path(F.col("file_path")).alias("file_path")).distinct()
