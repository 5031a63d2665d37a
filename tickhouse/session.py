"""Session configuration, checkpoint location and argument checks."""

from __future__ import annotations

import re
import tempfile
from datetime import datetime

from pyspark.sql import SparkSession

# The shapes accepted for names and locations.
IDENTIFIER = r"^[A-Za-z_][A-Za-z0-9_]{0,1023}$"
PROJECT = r"^[a-z][a-z0-9-]{4,61}[a-z0-9]$"
OBJECT_DIRECTORY = r"^gs://[a-z0-9._-]+(/[A-Za-z0-9._/-]+)?/$"
RECEIPT_OBJECT = r"^gs://[a-z0-9._-]+/[A-Za-z0-9._/-]+\.json$"
MIN_TARGET_FILE_BYTES = 8 * 1024 * 1024
DEFAULT_TARGET_FILE_BYTES = 128 * 1024 * 1024

# The engine's own settings; partition counts and memory stay with the cluster.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Sessions of a busy component are merged inside each input task before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator relies on (UTC above all)."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a private one only for local sessions without a setting."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="tickhouse-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


TABLE_NAME = re.compile(r"\.".join([f"({IDENTIFIER.strip('^$')})"] * 3))


def table_parts(name: str) -> tuple[str, str, str]:
    """Catalog, namespace and table of a dotted name that is safe to put into SQL text."""
    match = TABLE_NAME.fullmatch(name)
    if match is None:
        raise ValueError(f"not a catalog.namespace.table name: {name!r}")
    return match.groups()


def dotted_name(*parts: str) -> str:
    """The parts as one name, refused unless it is safe to put into SQL text."""
    return ".".join(table_parts(".".join(parts)))


def target_file_bytes(value: int) -> int:
    if value < MIN_TARGET_FILE_BYTES:
        raise ValueError("target file size must be at least 8 MiB")
    return value


def exactly_one(first: object, second: object, message: str) -> None:
    if (first is None) == (second is None):
        raise ValueError(message)


def at_most_one(first: object, second: object, message: str) -> None:
    if first is not None and second is not None:
        raise ValueError(message)


def aware(value: datetime, label: str = "now") -> datetime:
    if value.tzinfo is None or value.utcoffset() is None:
        raise ValueError(f"{label} must be timezone-aware")
    return value
