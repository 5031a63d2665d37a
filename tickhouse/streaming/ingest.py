"""Frames to stored bars with a durability ledger, one micro-batch at a time.

Data is written before Spark records the batch's offsets, so a crash replays the batch. Every
output of a micro-batch goes to a folder of its own ``(query_id, batch_id)`` in overwrite mode:
a replay replaces its own files instead of adding to them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickhouse.operators.decode import accepted, decode, explode_bars, quarantine, stored_bars
from tickhouse.schemas import LEDGER
from tickhouse.settings import COMMIT_STARTED, COMMIT_SUCCEEDED
from tickhouse.sources.catalog import append_bars

# What each failure says about durability (data, offsets).
FAILURE_STATUS = {
    "data_file_write_failed": ("not_committed", "not_committed"),
    "iceberg_commit_failed": ("not_committed", "not_committed"),
    "iceberg_commit_state_unknown": ("unknown", "not_committed"),
    "offset_commit_failed": ("committed", "not_committed"),
    "loader_failed": ("unknown", "unknown"),
}


@dataclass(frozen=True)
class IngestPaths:
    """Folders of one raw table; they must be reachable by every executor."""

    bars: str
    quarantine: str
    ledger: str
    checkpoint: str


def commit_failure(error: Exception) -> str:
    """Class of a failed catalog append: when the outcome is unknown the data may be there."""
    if "CommitStateUnknown" in str(error):
        return "iceberg_commit_state_unknown"
    return "iceberg_commit_failed"


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def land_frames(frames: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append frames verbatim to Parquet; the payload text is not touched."""
    return (
        frames.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


class BatchWriter:
    """The ``foreachBatch`` body of an ingest query.

    With ``table`` bars are appended to that catalog table instead of the bars folder, once. The ledger
    notes the start of a batch before the append, and that time is the ``ingested_at`` of all its bars: a
    marker inside the table. A batch that runs again takes its first start from the ledger, and if the table
    already has bars of that time, the (atomic) append was done and only the ledger row is missing.

    ``rebalance`` gathers the rows of a date before writing. A backfill wants it (else it writes a
    file per task and date); a live batch of one date does not need the exchange.
    """

    def __init__(self, paths: IngestPaths, query_id: str, strict: bool = False,
                 max_bars_per_file: int | None = None, table: str | None = None,
                 clock: Callable[[], datetime] = utc_now, rebalance: bool = False):
        self.rebalance = rebalance
        self.paths = paths
        self.query_id = query_id
        self.strict = strict
        self.max_bars_per_file = max_bars_per_file
        self.table = table
        self.clock = clock

    def folder(self, base: str, batch_id: int) -> str:
        return f"{base}/query_id={self.query_id}/batch_id={batch_id}"

    def __call__(self, frames: DataFrame, batch_id: int) -> None:
        started = self.clock()
        failure = "loader_failed"
        counts: dict[str, int] = {}
        spark = frames.sparkSession
        appended = False
        if self.table:
            if self._has_step(spark, batch_id, "finished"):
                return
            if self._has_step(spark, batch_id, "started"):
                started = self._first_start(spark, batch_id)
                appended = spark.table(self.table).where(F.col("ingested_at") == F.lit(started)).limit(1).count() > 0
        try:
            self._log(spark, batch_id, COMMIT_STARTED, started, started, {})
            failure = "data_file_write_failed"
            counts = self._counted(frames, started) if appended else self._write_bars(frames, batch_id, started)
            failure = "offset_commit_failed"
            self._log(spark, batch_id, COMMIT_SUCCEEDED, started, self.clock(), counts)
        except Exception as error:
            if failure == "data_file_write_failed" and self.table:
                failure = commit_failure(error)
            self._log(spark, batch_id, failure, started, self.clock(), counts)
            raise

    def _write_bars(self, frames: DataFrame, batch_id: int, started: datetime) -> dict[str, int]:
        decoded = decode(frames)
        refused = F.col("reject_reason").isNotNull()
        if self.strict:
            problem = F.concat(F.lit("refused frame: "), F.col("reject_reason"))
            decoded = decoded.withColumn(
                "bars", F.when(refused, F.raise_error(problem)).otherwise(F.col("bars"))
            )
        received = Observation()
        observed = decoded.observe(
            received,
            F.coalesce(F.sum(F.when(~refused, F.size("bars"))), F.lit(0)).alias("bars"),
            F.count_if(~refused & (F.size("bars") > 0)).alias("source_records"),
            F.count_if(refused).alias("quarantined_frames"),
        )
        written = Observation()
        rows = stored_bars(explode_bars(accepted(observed)), F.lit(started)).withColumn(
            "event_date", F.to_date("event_ts")
        ).observe(written, F.count(F.lit(1)).alias("inserted"))
        if self.rebalance:
            rows = rows.hint("rebalance", "event_date")
        if self.table:
            append_bars(rows, self.table)
        else:
            writer = rows.write.mode("overwrite").partitionBy("event_date")
            if self.max_bars_per_file:
                writer = writer.option("maxRecordsPerFile", self.max_bars_per_file)
            writer.parquet(self.folder(self.paths.bars, batch_id))
        counts = {**received.get, **written.get}
        if counts["quarantined_frames"]:
            # Parsed a second time, and only when a frame was refused: cheaper than caching all.
            quarantine(decode(frames)).write.mode("overwrite").parquet(
                self.folder(self.paths.quarantine, batch_id)
            )
        return counts

    def _step(self, batch_id: int, step: str) -> str:
        return f"{self.folder(self.paths.ledger, batch_id)}/step={step}"

    def _has_step(self, spark: SparkSession, batch_id: int, step: str) -> bool:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{self._step(batch_id, step)}/_SUCCESS")
        return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)

    def _first_start(self, spark: SparkSession, batch_id: int) -> datetime:
        micros = spark.read.parquet(self._step(batch_id, "started")).select(F.unix_micros("started_at")).first()[0]
        return datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=micros)

    def _counted(self, frames: DataFrame, started: datetime) -> dict[str, int]:
        """The numbers of a batch that is in the table already: from its frames, and from the table."""
        refused = F.col("reject_reason").isNotNull()
        counts = decode(frames).agg(
            F.coalesce(F.sum(F.when(~refused, F.size("bars"))), F.lit(0)).alias("bars"),
            F.count_if(~refused & (F.size("bars") > 0)).alias("source_records"),
            F.count_if(refused).alias("quarantined_frames"),
        ).first().asDict()
        stored = frames.sparkSession.table(self.table).where(F.col("ingested_at") == F.lit(started))
        return {**counts, "inserted": stored.count()}

    def _log(self, spark: SparkSession, batch_id: int, event: str, started: datetime,
             finished: datetime, counts: dict[str, int]) -> None:
        data, offsets = FAILURE_STATUS.get(event, (None, None))
        row = {
            "query_id": self.query_id,
            "batch_id": batch_id,
            "started_at": started,
            "finished_at": finished,
            "event": event,
            "failure_type": event if event in FAILURE_STATUS else None,
            "data_commit_status": "committed" if event == COMMIT_SUCCEEDED else data,
            "offset_commit_status": "committed" if event == COMMIT_SUCCEEDED else offsets,
            "duration_ms": int((finished - started).total_seconds() * 1000),
            **{k: counts.get(k) for k in ("bars", "source_records", "quarantined_frames", "inserted")},
        }
        # Literals over a one-row range: no Python worker is started for a ledger row.
        values = [
            F.lit(row[field.name]).cast(field.dataType).alias(field.name)
            for field in LEDGER.fields
            if field.name not in ("query_id", "batch_id")
        ]
        # Failures keep a step each, so a later success of the same batch does not hide them.
        step = {COMMIT_STARTED: "started", COMMIT_SUCCEEDED: "finished"}.get(
            event, f"failed-{started:%Y%m%dT%H%M%S%f}"
        )
        spark.range(1, numPartitions=1).select(*values).write.mode("overwrite").parquet(
            self._step(batch_id, step))


def start_ingest(frames: DataFrame, writer: BatchWriter, available_now: bool = True,
                 interval: str = "300 seconds") -> StreamingQuery:
    """Run the ingest query: drain what is there, or keep going at a fixed interval.

    The bound per micro-batch is set on the source (frames or files per trigger).
    """
    stream = frames.writeStream.foreachBatch(writer).option(
        "checkpointLocation", writer.paths.checkpoint
    )
    if available_now:
        return stream.trigger(availableNow=True).start()
    return stream.trigger(processingTime=interval).start()


LEDGER_KEY = ("query_id", "batch_id", "step")


def _loose_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        rows = spark.read.option("basePath", path).schema(
            f"{_ddl()}, query_id string, batch_id bigint, step string").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return rows


def _ddl() -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LEDGER.fields
                     if f.name not in ("query_id", "batch_id"))


def _folded_ledger(spark: SparkSession, path: str) -> tuple[int, DataFrame | None]:
    """The newest finished generation of folded rows, 0 and None if there is none."""
    try:
        known = spark.read.option("basePath", f"{path}.folded").schema(
            f"{_ddl()}, query_id string, batch_id bigint, step string, generation bigint").parquet(f"{path}.folded")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return 0, None
        raise
    newest = known.agg(F.max("generation")).first()[0]
    if newest is None:
        return 0, None
    return newest, known.where(F.col("generation") == newest).drop("generation")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All ledger rows, folded and loose. A row that is in both places counts once, by its key."""
    loose, (_, folded) = _loose_ledger(spark, path), _folded_ledger(spark, path)
    if folded is None:
        if loose is None:
            raise LookupError(f"no ledger at {path}")
        return loose
    if loose is None:
        return folded
    return folded.unionByName(loose.join(folded.select(*LEDGER_KEY), list(LEDGER_KEY), "left_anti"))


def fold_ledger(spark: SparkSession, path: str, keep_batches: int = 100) -> int:
    """Write the ledger's rows into one generation and remove the folders of older finished batches.

    The newest ``keep_batches`` of each query stay loose, as replays look for them there. A generation
    appears whole, and only then the loose folders it holds go: a reader finds every row before, during and
    after. A fold that failed half-way is finished by the next one. Returns the generation's number.
    """
    if keep_batches < 1:
        raise ValueError("keep at least the newest batch loose")
    number, _ = _folded_ledger(spark, path)
    rows = read_ledger(spark, path).select(*[f.split()[0] for f in _ddl().split(", ")], *LEDGER_KEY)
    newest = rows.groupBy("query_id").agg(F.max("batch_id").alias("_newest"))
    finished = rows.where(F.col("step") == "finished").select("query_id", "batch_id").distinct()
    old = finished.join(newest, "query_id").where(F.col("batch_id") <= F.col("_newest") - keep_batches)
    target = f"{path}.folded/generation={number + 1}"
    rows.join(old.select("query_id", "batch_id"), ["query_id", "batch_id"], "left_semi").coalesce(1).write.mode(
        "errorifexists").parquet(target)
    written = spark.read.schema("query_id string, batch_id bigint").parquet(target).distinct()
    loose = _loose_ledger(spark, path)
    gone = [] if loose is None else loose.select("query_id", "batch_id").distinct().join(
        written, ["query_id", "batch_id"]).toLocalIterator()
    for row in gone:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/query_id={row['query_id']}/batch_id={row['batch_id']}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return number + 1


def ledger_events(ledger: DataFrame) -> DataFrame:
    """Ledger rows as loader events, ready for pairing and the loader section."""
    started = F.col("event") == COMMIT_STARTED
    number = F.lit(None).cast("long")
    text = F.lit(None).cast("string")
    done = F.col("event") == COMMIT_SUCCEEDED
    finished = F.date_format("finished_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    sizes = ledger.filter(done).select(
        "query_id", "batch_id", F.col("bars").alias("_bars"), F.col("source_records").alias("_sources")
    )
    return ledger.join(sizes, ["query_id", "batch_id"], "left").select(
        F.col("query_id").cast("string").alias("pipeline_id"),
        F.col("query_id").cast("string").alias("process_id"),
        (F.col("batch_id").cast("long") * 2 + F.when(started, 0).otherwise(1)).alias("seq"),
        F.when(started, F.col("started_at")).otherwise(F.col("finished_at")).alias("at"),
        "event",
        text.alias("topic"), F.lit("committing").alias("state"), text.alias("last_input_at_utc"),
        F.when(done, finished).alias("last_commit_at_utc"),
        F.when(done, F.col("duration_ms")).alias("last_commit_duration_ms"),
        F.when(done, F.col("duration_ms")).alias("durable_commit_total_duration_ms"),
        F.when(started, F.col("_bars")).alias("batch_bars"),
        F.when(started, F.col("_sources")).alias("batch_source_records"),
        number.alias("aggregate_lag_records"), number.alias("buffered_bars"),
        number.alias("buffered_source_records"),
        F.lit(None).cast(
            "array<struct<partition:bigint,committed_offset:bigint,end_offset:bigint,lag_records:bigint>>"
        ).alias("partitions"),
    )


def ledger_commits(ledger: DataFrame) -> DataFrame:
    """Successful micro-batches as table commits for the snapshot history."""
    return ledger.filter(F.col("event") == COMMIT_SUCCEEDED).select(
        F.col("query_id").cast("string").alias("table_id"),
        F.col("finished_at").alias("committed_at"),
        F.col("inserted").alias("added_records"),
    )
