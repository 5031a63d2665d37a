"""Catalog configuration, table creation, discovery and registration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.session import dotted_name

CATALOG_TYPES = ("hadoop", "jdbc", "rest")
# Public class names of the table format and the object-store connector.
ICEBERG_EXTENSIONS = "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions"
ICEBERG_CATALOG = "org.apache.iceberg.spark.SparkCatalog"
GS_FILE_SYSTEM = "com.google.cloud.hadoop.fs.gcs.GoogleHadoopFileSystem"
GS_ABSTRACT_FILE_SYSTEM = "com.google.cloud.hadoop.fs.gcs.GoogleHadoopFS"

# Columns of the stored bar table, all required.
BAR_TABLE_DDL = (
    "payload_hash STRING NOT NULL, bar_type STRING NOT NULL, symbol STRING NOT NULL, "
    "open DOUBLE NOT NULL, high DOUBLE NOT NULL, low DOUBLE NOT NULL, close DOUBLE NOT NULL, "
    "volume BIGINT NOT NULL, event_time_text STRING NOT NULL, trade_count BIGINT NOT NULL, "
    "vwap DOUBLE NOT NULL, event_ts TIMESTAMP NOT NULL, ingested_at TIMESTAMP NOT NULL"
)


@dataclass(frozen=True)
class CatalogSettings:
    warehouse: str
    kind: str = "hadoop"
    name: str = "market"
    namespace: str = "market"
    table: str = "bars_raw"
    uri: str = ""
    jdbc_user: str = ""
    jdbc_password: str = ""
    allow_object_store: bool = False
    connector_jar: str = ""
    runtime_package: str = ""

    @property
    def identifier(self) -> str:
        return dotted_name(self.name, self.namespace, self.table)


def catalog_conf(settings: CatalogSettings) -> dict[str, str]:
    """Session configuration of an Iceberg catalog; the table contract is the same for each kind."""
    if settings.kind not in CATALOG_TYPES:
        raise ValueError("catalog type must be hadoop, jdbc, or rest")
    if settings.kind != "hadoop" and not settings.uri.strip():
        raise ValueError(f"a catalog URI is required for {settings.kind}")
    on_gs = settings.warehouse.startswith("gs://")
    if on_gs and not settings.allow_object_store:
        raise ValueError("opening a gs:// warehouse must be allowed explicitly")
    if on_gs and not settings.connector_jar:
        raise ValueError("a gs:// warehouse needs the connector jar")
    prefix = f"spark.sql.catalog.{settings.name}"
    conf = {
        "spark.sql.extensions": ICEBERG_EXTENSIONS,
        prefix: ICEBERG_CATALOG,
        f"{prefix}.type": settings.kind,
        f"{prefix}.warehouse": settings.warehouse,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.caseSensitive": "true",
    }
    if settings.runtime_package:
        conf["spark.jars.packages"] = settings.runtime_package
    if settings.kind != "hadoop":
        conf[f"{prefix}.uri"] = settings.uri
    if settings.kind == "jdbc":
        for key, value in (("user", settings.jdbc_user), ("password", settings.jdbc_password)):
            if value:
                conf[f"{prefix}.jdbc.{key}"] = value
    if on_gs:
        conf |= {
            "spark.jars": settings.connector_jar,
            "spark.hadoop.fs.gs.impl": GS_FILE_SYSTEM,
            "spark.hadoop.fs.AbstractFileSystem.gs.impl": GS_ABSTRACT_FILE_SYSTEM,
            "spark.hadoop.google.cloud.auth.type": "APPLICATION_DEFAULT",
        }
    return conf


def ensure_table(spark: SparkSession, catalog: str, namespace: str, table: str,
                 provider: str = "parquet") -> str:
    """Create namespace and bar table when absent; returns the qualified name."""
    name = dotted_name(catalog, namespace, table)
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {catalog}.{namespace}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({BAR_TABLE_DDL}) USING {provider}")
    return name


def append_bars(bars: DataFrame, table: str) -> None:
    """Atomic append to a catalog table; duplicates are kept for the read views to resolve."""
    bars.select(*bars.sparkSession.table(table).columns).write.insertInto(table)


def describe_namespace(spark: SparkSession, catalog: str, namespace: str) -> DataFrame:
    """Tables of a namespace; an absent namespace is reported as such."""
    qualified = dotted_name(catalog, namespace, "t").rsplit(".", 1)[0]
    try:
        return spark.sql(f"SHOW TABLES IN {qualified}").filter("NOT isTemporary")
    except AnalysisException as error:
        raise LookupError(
            f"namespace {qualified} is absent: ingest bars or create the table first"
        ) from error


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {table}")


def register_location(spark: SparkSession, catalog: str, namespace: str, table: str,
                      location: str) -> str:
    """Register existing Parquet data under a new name without rewriting it."""
    name = dotted_name(catalog, namespace, table)
    if "'" in location:
        raise ValueError("invalid location")
    _refuse_existing(spark, name)
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {catalog}.{namespace}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{location}'")
    return name


def register_metadata(spark: SparkSession, catalog: str, namespace: str, table: str,
                      metadata_file: str) -> str:
    """Register an Iceberg table from its current metadata document. Needs the Iceberg runtime."""
    name = dotted_name(catalog, namespace, table)
    if "'" in metadata_file:
        raise ValueError("invalid metadata file")
    _refuse_existing(spark, name)
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {catalog}.{namespace}")
    spark.sql(
        f"CALL {catalog}.system.register_table(table => '{namespace}.{table}', "
        f"metadata_file => '{metadata_file}')"
    )
    return name


def _refuse_existing(spark: SparkSession, name: str) -> None:
    if spark.catalog.tableExists(name):
        raise ValueError(f"target catalog already contains {name}")


def data_files(data: DataFrame, table_id: str) -> DataFrame:
    """``table_id, file_path, file_size, record_count`` of a file-backed DataFrame.

    Only file metadata is selected, so the scan reads row counts but no columns.
    """
    file = F.col("_metadata")
    return data.select(
        file["file_path"].alias("file_path"), file["file_size"].alias("file_size")
    ).groupBy("file_path", "file_size").agg(F.count(F.lit(1)).alias("record_count")).select(
        F.lit(table_id).alias("table_id"), "file_path", "file_size", "record_count"
    )
