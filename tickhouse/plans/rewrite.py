"""Selective compaction of a bar folder: bins of small files are rewritten, all others stay.

The live files of a folder are a *generation*: a Parquet list of paths, sizes and row counts, written
once and never changed. A reader opens the newest finished generation, so the switch is the appearance
of one list and a rewrite in progress, or one that failed, is never seen. Replaced files stay on disk
until no kept generation refers to them; ``upkeep.orphan_plan`` over ``list_files`` names them then.

Files are binned within their day by cumulative size (``tables.bin_plan``). Only files below
``SMALL`` of the target take part, and only bins of two files or more are rewritten, into one file each.
A run takes at most ``max_files`` files, for their paths pass through the driver; the rest is left to
the next run, which goes on from the new generation.
"""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickhouse.operators.tables import bin_plan
from tickhouse.plans.compaction import (
    AFTER,
    BEFORE,
    Clock,
    CompactionRefused,
    _require,
    _text,
    content_digest,
    utc_now,
)
from tickhouse.session import DEFAULT_TARGET_FILE_BYTES, checkpoint_dir, target_file_bytes
from tickhouse.sources.sinks import write_receipt

#: Part of the target size from which a file is left alone.
SMALL = 0.75
LISTED = "file_path string, file_size bigint, record_count bigint, event_date date"


def scan_generation(spark: SparkSession, root: str) -> DataFrame:
    """The files of a partitioned bar folder as a first generation."""
    file = F.col("_metadata")
    return spark.read.parquet(root).select(
        file["file_path"].alias("file_path"), file["file_size"].alias("file_size"), "event_date",
    ).groupBy("file_path", "file_size", "event_date").agg(F.count(F.lit(1)).alias("record_count")).select(
        "file_path", "file_size", "record_count", "event_date")


def generations(spark: SparkSession, manifests: str) -> DataFrame | None:
    """All finished generations with their number; None if there is none yet."""
    try:
        return spark.read.schema(f"{LISTED}, generation bigint").option("basePath", manifests).parquet(manifests)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def live_files(spark: SparkSession, root: str, manifests: str) -> tuple[int, DataFrame]:
    """Number and files of the newest generation; number 0 is the folder as it is."""
    known = generations(spark, manifests)
    newest = None if known is None else known.agg(F.max("generation")).first()[0]
    if newest is None:
        return 0, scan_generation(spark, root)
    return newest, known.where(F.col("generation") == newest).drop("generation")


def read_live(spark: SparkSession, root: str, manifests: str) -> DataFrame:
    """The bars of the newest generation."""
    number, files = live_files(spark, root, manifests)
    if number == 0:
        return _dated(spark.read.option("recursiveFileLookup", "true").parquet(root))
    return _read(spark, [r["file_path"] for r in files.select("file_path").toLocalIterator()])


def _dated(rows: DataFrame) -> DataFrame:
    """Rows of files from any folder with the day that their path names."""
    day = F.regexp_extract(F.col("_metadata.file_path"), "/event_date=([^/]+)/", 1)
    return rows.withColumn("event_date", F.to_date(day))


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    return _dated(spark.read.parquet(*paths))


def generation_state(files: DataFrame) -> dict[str, Any]:
    name = F.xxhash64("file_path", "file_size").cast("decimal(38,0)")
    return files.agg(
        F.sum(name).cast("string").alias("version"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("records"), F.count(F.lit(1)).alias("files"),
    ).first().asDict()


def rewrite_plan(files: DataFrame, target_bytes: int, max_files: int = 10_000) -> DataFrame:
    """Files to rewrite with their ``event_date`` and ``bin_id``; whole bins, the smallest files first."""
    small = files.where(F.col("file_size") < SMALL * target_bytes)
    planned = bin_plan(small.withColumn("table_id", F.col("event_date").cast("string")), target_bytes)
    by_bin = planned.groupBy("event_date", "bin_id").agg(
        F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes")).where("files > 1")
    # Bins that a run can take: ranks and sums over the first ``max_files`` bins only.
    first = by_bin.orderBy(F.col("bytes") / F.col("files"), "event_date", "bin_id").limit(max_files)
    taken = first.withColumn("through", F.sum("files").over(
        Window.orderBy(F.col("bytes") / F.col("files"), "event_date", "bin_id")))
    chosen = taken.where((F.col("through") <= max_files) | (F.col("through") == F.col("files")))
    return planned.join(chosen.select("event_date", "bin_id"), ["event_date", "bin_id"]).select(
        "event_date", "bin_id", "file_path", "file_size", "record_count")


def rewrite_small_files(
    spark: SparkSession, root: str, manifests: str, receipt_path: str, run_id: str, expected: str,
    target_bytes: int = DEFAULT_TARGET_FILE_BYTES, max_files: int = 10_000, clock: Clock = utc_now,
) -> dict[str, Any]:
    """Replace bins of small files by one file each and publish the next generation.

    ``expected`` is the version (``generation_state``) that the run was planned for. New files go to
    ``manifests``-independent names below ``root``'s sibling ``<root>.rewritten/<run_id>``; an existing
    run is refused. Without a bin to rewrite nothing is published and ``rewritten_files`` is 0.
    """
    size, started = target_file_bytes(target_bytes), clock()
    checkpoint_dir(spark)
    number, files = live_files(spark, root, manifests)
    files = files.checkpoint()
    pre = generation_state(files)
    _require(spark, BEFORE, pre=pre, expected=expected)
    plan = rewrite_plan(files, size, max_files).checkpoint()
    paths = [r["file_path"] for r in plan.select("file_path").collect()]
    receipt = {"run_id": run_id, "table": root, "started_at_utc": _text(started), "pre": pre,
               "generation": number, "rewritten_files": len(paths)}
    if not paths:
        return write_receipt(spark, receipt_path, {**receipt, "finished_at_utc": _text(clock()), "post": pre})
    source = _read(spark, paths)
    folder = f"{root.rstrip('/')}.rewritten/{run_id}"
    bins = plan.select("event_date", "bin_id").distinct().count()
    binned = spark.read.parquet(*paths).withColumn("file_path", F.col("_metadata.file_path")).join(
        F.broadcast(plan.select("file_path", "event_date", "bin_id")), "file_path").drop("file_path")
    binned.repartition(bins, "event_date", "bin_id").sortWithinPartitions("event_date", "bin_id").write.mode(
        "errorifexists").partitionBy("event_date", "bin_id").parquet(folder)
    made = scan_generation(spark, folder)
    kept = files.join(F.broadcast(plan.select("file_path")), "file_path", "left_anti")
    following = kept.unionByName(made.select(*kept.columns)).checkpoint()
    post = generation_state(following)
    again = live_files(spark, root, manifests)
    if again[0] != number or generation_state(again[1])["version"] != pre["version"]:
        raise CompactionRefused(["unchanged_since_planned"])
    written = spark.read.parquet(folder).drop("bin_id")
    _require(spark, AFTER, pre=pre, post=post, failed_files=0,
             same_rows=content_digest(source) == content_digest(written.select(*source.columns)))
    following.coalesce(1).write.mode("errorifexists").parquet(f"{manifests}/generation={number + 1}")
    return write_receipt(spark, receipt_path, {
        **receipt, "finished_at_utc": _text(clock()), "generation": number + 1, "post": post})


def kept_generations(spark: SparkSession, manifests: str, now: datetime, keep: int = 2) -> DataFrame:
    """Files of the newest ``keep`` generations, what an orphan plan must not touch."""
    if keep < 1:
        raise ValueError("keep at least the newest generation")
    known = generations(spark, manifests)
    if known is None:
        return spark.createDataFrame([], f"{LISTED}, generation bigint")
    newest = known.agg(F.max("generation")).first()[0]
    return known.where(F.col("generation") > newest - keep)
