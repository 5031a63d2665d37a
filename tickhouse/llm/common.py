"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickhouse.session import checkpoint_dir, configure

ARROW_ROWS = 4096
ARROW_BYTES = 8 * 1024 * 1024


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the corpus operators: bounded Arrow batches and a checkpoint folder."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    checkpoint_dir(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(rows: DataFrame, **columns: str) -> DataFrame:
    """``rid`` (a number of its own for every row, repeated rows included) and the named columns.

    Only the named columns are taken, so further columns of the input cannot clash. ``rid`` follows
    partition and position: join on it only after ``saved``.
    """
    prepare(rows.sparkSession)
    return rows.select(
        F.monotonically_increasing_id().alias("rid"),
        *[F.col(f"`{source}`").alias(name) for name, source in columns.items()],
    )


def saved(rows: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint; it outlives lost executors."""
    checkpoint_dir(rows.sparkSession)
    return rows.checkpoint()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tickhouse-{name}-{uuid.uuid4().hex}"


def by_batch(
    rows: DataFrame, schema: str | StructType, function: Callable[[pa.RecordBatch], dict | None]
) -> DataFrame:
    """Apply a function to each Arrow batch; it returns the output columns by name."""
    prepare(rows.sparkSession)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = function(batch) if batch.num_rows else None
            if columns is not None:
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c)
                     for c in (columns[n] for n in names)],
                    names=names,
                )

    return rows.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null reads as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def stored(rows: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write rows as Parquet below the checkpoint folder and read them back: for wide rows."""
    folder = shared_folder(rows.sparkSession, name)
    rows.write.parquet(folder, compression=compression)
    return rows.sparkSession.read.parquet(folder)


def dropped(*tables: DataFrame) -> None:
    """Delete the folders of ``stored`` tables that nothing reads any more."""
    for rows in tables:
        context = rows.sparkSession.sparkContext
        for folder in {file.rpartition("/")[0] for file in rows.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(folder))
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def released(spark: SparkSession) -> None:
    """Let go of shuffle files and checkpoints of steps that are over. Spark removes them when the driver
    collects its garbage, which it may put off until long after a step that fills the disks."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Rows of a narrow table (a few numbers each) that may be broadcast: about 10 MB.
BROADCAST_ROWS = 200_000


def sized(rows: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for stored rows that were counted and are few; otherwise as they are."""
    return F.broadcast(rows) if rows.limit(limit + 1).count() <= limit else rows


def members_of(rows: DataFrame) -> DataFrame:
    """``bucket`` and ``node`` of one of each kind of buckets that hold the same nodes, if several, with
    their number ``n``. Rows may repeat."""
    # The exchange is the same for both sides, so rows are shuffled once; the join would else add the
    # filter to one of them.
    dealt = rows.where("bucket IS NOT NULL").repartition("bucket")
    stat = dealt.distinct().groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit("member"), "node")).alias("y"))
    chosen = stat.where("n > 1").groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    return saved(dealt.join(chosen.hint("shuffle_hash"), "bucket").distinct())


def identified(docs: DataFrame) -> DataFrame:
    """Add ``rid``, which names a row for good: file and row number of the scan it comes from.

    Unlike a generated id it does not depend on how a later scan is cut into tasks, so two scans of
    the same files agree on it. Rows that do not come straight from Parquet files are stored first.
    Returns ``rid`` and ``row``, a struct of all columns, so nothing can clash.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rid = F.struct(F.xxhash64("_metadata.file_path").alias("file"),
                   F.col("_metadata.row_index").alias("at")).alias("rid")
    try:
        return docs.select(rid, row)
    except AnalysisException:
        return stored(docs.select(row), "rows").select(rid, "row")
