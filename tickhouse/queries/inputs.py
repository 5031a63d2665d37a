"""The given tables in the shapes the operators read, in Spark and as SQL views.

Both sides derive the same rows from ``events``, ``orders``, ``lineitem``, ``part`` and
``documents``; every row of a table is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.functions.times import micros_text
from tickhouse.settings import FAILURE_EVENTS
from tickhouse.sources.frames import encode_frames

TOPIC = "bars"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream of its files.

    The path is a pattern that matches the table alone: a stream takes a plain path for a folder, and a
    table may be one file.
    """
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


def events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Events with UTC timestamps and the parsed integer property."""
    source = table_stream if stream else table
    return source(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )


def user_name(user_id: Column) -> Column:
    return F.concat(F.lit("U"), F.lpad(user_id.cast("string"), 3, "0"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per event, placed in frames of up to seven bars over four partitions."""
    source = events(spark, sf_dir)
    cents = F.round(F.col("value") * 100).cast("long") + 10000
    volume = F.col("k") * 100 + F.col("event_id") % 100
    number = F.col("event_id")
    return source.select(
        "event_id",
        F.lit(TOPIC).alias("topic"),
        (F.floor(number / 7) % 4).cast("int").alias("part_id"),
        F.floor(number / 28).alias("src_offset"),
        (number % 7).alias("pos"),
        F.lit("b").alias("bar_type"),
        user_name(F.col("user_id")).alias("symbol"),
        ((cents - 5) / F.lit(100.0)).alias("open"),
        ((cents + 15) / F.lit(100.0)).alias("high"),
        ((cents - 15) / F.lit(100.0)).alias("low"),
        (cents / F.lit(100.0)).alias("close"),
        volume.alias("volume"),
        micros_text(F.col("ts")).alias("event_time_text"),
        F.greatest(F.lit(1).cast("long"), F.floor(volume / 100)).alias("trade_count"),
        (cents / F.lit(100.0)).alias("vwap"),
        F.col("ts").alias("event_ts"),
        F.col("ts").alias("received_at"),
    )


def raw_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bars as JSON frames."""
    return encode_frames(
        bars(spark, sf_dir), ["topic", "part_id", "src_offset"], ["pos"]
    )


def sized_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame sizes and arrival times without the payload."""
    return bars(spark, sf_dir).groupBy("topic", "part_id", "src_offset").agg(
        F.count(F.lit(1)).alias("frame_size"), F.min("received_at").alias("received_at")
    )


def pipeline_name(user_id: Column) -> Column:
    return F.concat(F.lit("pl"), (user_id % 3).cast("string"))


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loader health events of three pipelines with five processes."""
    kind = F.col("event_type")
    failures = F.array(*[F.lit(name) for name in FAILURE_EVENTS])
    failure = F.get(failures, (F.col("event_id") % 5).cast("int"))
    return events(spark, sf_dir).select(
        pipeline_name(F.col("user_id")).alias("pipeline_id"),
        F.concat(F.lit("p"), (F.col("user_id") % 5).cast("string")).alias("process_id"),
        F.col("event_id").alias("seq"),
        F.col("ts").alias("at"),
        F.when(kind == "click", "commit_started")
        .when(kind == "purchase", "commit_succeeded")
        .when(kind == "error", failure)
        .otherwise("heartbeat")
        .alias("event"),
        "k",
        F.round(F.col("value") * 100).cast("long").alias("duration_ms"),
    )


def health_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health events with the columns of recognised loader events."""
    text = F.lit(None).cast("string")
    number = F.lit(None).cast("long")
    start = F.col("event") == "commit_started"
    done = F.col("event") == "commit_succeeded"
    part = F.struct(
        (F.col("k") % 2).alias("partition"), F.col("seq").alias("committed_offset"),
        (F.col("seq") + F.col("k")).alias("end_offset"), F.col("k").alias("lag_records"),
    )
    return health(spark, sf_dir).select(
        "pipeline_id", "process_id", "seq", "at", "event",
        F.lit(TOPIC).alias("topic"),
        F.when(F.col("event") == "heartbeat", F.when(F.col("k") > 90, "stalled").otherwise("idle"))
        .otherwise("committing").alias("state"),
        micros_text(F.col("at")).alias("last_input_at_utc"),
        F.when(done, micros_text(F.col("at"))).otherwise(text).alias("last_commit_at_utc"),
        F.when(done, F.col("duration_ms")).otherwise(number).alias("last_commit_duration_ms"),
        F.when(done, F.col("duration_ms")).otherwise(number).alias("durable_commit_total_duration_ms"),
        F.when(start, F.col("k") * 10).otherwise(number).alias("batch_bars"),
        F.when(start, F.col("k")).otherwise(number).alias("batch_source_records"),
        F.col("k").alias("aggregate_lag_records"),
        (F.col("k") * 2).alias("buffered_bars"),
        F.col("k").alias("buffered_source_records"),
        F.array(part).alias("partitions"),
    )


def log_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised log entries of both units: extractor logs and loader health."""
    kind, k = F.col("event_type"), F.col("k")
    source = events(spark, sf_dir)
    note = F.get(
        F.array(F.lit("delivery failed"), F.lit("Authentication rejected"), F.lit("commit lost"),
                F.lit("socket closed")),
        (F.col("event_id") % 4).cast("int"),
    )
    message = (
        F.when(kind == "view", "metrics").when(kind == "signup", "final metrics")
        .when(kind == "click", "no bar data within idle window; shutting down producer")
        .when(kind == "error", note)
    )
    snapshot = F.when(kind.isin("view", "signup"), F.when(
        F.col("event_id") % 10 == 0, F.lit("{broken")
    ).otherwise(F.to_json(F.struct(
        k.alias("messages_received"), F.greatest(k - 1, F.lit(0)).alias("messages_sent"),
        (k % 3).alias("delivery_failures"), (k % 2).alias("errors"),
        micros_text(F.col("ts")).alias("last_message_ts"),
    ))))
    fields = F.struct(message.alias("message"), snapshot.alias("snapshot"),
                      F.when(kind == "click", F.lit(600).cast("long")).alias("idle_secs"))
    return source.select(
        pipeline_name(F.col("user_id")).alias("pipeline_id"),
        F.col("event_id").alias("seq"),
        F.col("ts").alias("at"),
        F.lit("bar-extractor.service").alias("unit"),
        F.when(kind == "error", F.when(k % 2 == 0, "ERROR").otherwise("WARN"))
        .when(kind == "click", "WARN").otherwise("INFO").alias("level"),
        F.lit(None).cast("string").alias("severity"),
        F.lit(None).cast("string").alias("target"),
        F.lit(None).cast("string").alias("message"),
        fields.alias("fields"),
    )


def offset_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One offset sample per heartbeat; end and committed offsets follow from the row itself."""
    beat = health(spark, sf_dir).filter(F.col("event") == "heartbeat")
    committed = F.col("seq") * 2 - (F.col("k") % 4) * 40
    end = F.col("seq") * 2
    part = F.struct(
        (F.col("k") % 2).alias("part_id"), F.greatest(committed, F.lit(0)).alias("committed_offset"),
        end.alias("end_offset"),
    )
    return beat.select(
        F.col("pipeline_id").alias("topic"), "at", "seq",
        F.array(part).alias("partitions"),
        (F.col("k") % 17 == 0).alias("committing"),
        (F.col("k") % 5).alias("buffered_bars"),
        (F.col("k") % 50).alias("buffered_source_records"),
    )


def billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billing lines from order lines: the part type is the service, the discount a credit."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    cost = F.col("l_extendedprice").cast("decimal(18,2)")
    credit = (-cost * F.col("l_discount").cast("decimal(18,2)")).cast("decimal(28,9)")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_shipdate").alias("usage_start_time"),
        F.col("p_type").alias("service_name"),
        F.lit("project-a").alias("project_id"),
        F.lit("USD").alias("currency"),
        cost.alias("cost"),
        F.array(F.struct(credit.alias("amount"))).alias("credits"),
        F.col("l_shipdate").alias("export_time"),
    )


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table commits: orders of one customer group at one time."""
    return table(spark, sf_dir, "orders").groupBy(
        F.concat(F.lit("t"), (F.col("o_custkey") % 5).cast("string")).alias("table_id"),
        F.col("o_orderdate").alias("committed_at"),
    ).agg(
        F.count(F.lit(1)).alias("added_records"),
        F.sum(F.round("o_totalprice").cast("long")).alias("added_bytes"),
    )


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as data files: source is the table, characters are bytes."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("table_id"),
        F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("file_path"),
        F.col("n_chars").alias("file_size"),
        (F.col("doc_id") % 50 + 1).alias("record_count"),
    )


# The same views as SQL. Names of views used inside a view come first in NEEDS.
VIEWS = {
    "bars": """
        SELECT event_id, 'bars' AS topic, (event_id // 7) % 4 AS part_id, event_id // 28 AS src_offset,
               event_id % 7 AS pos, 'b' AS bar_type, 'U' || lpad(CAST(user_id AS VARCHAR), 3, '0') AS symbol,
               (c - 5) / 100::DOUBLE AS open, (c + 15) / 100::DOUBLE AS high, (c - 15) / 100::DOUBLE AS low,
               c / 100::DOUBLE AS close, k * 100 + event_id % 100 AS volume,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time_text,
               greatest(1, (k * 100 + event_id % 100) // 100) AS trade_count, c / 100::DOUBLE AS vwap,
               ts AS event_ts
        FROM (SELECT *, CAST(round(value * 100) AS BIGINT) + 10000 AS c,
                     CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "framed": """
        SELECT *, count(*) OVER (PARTITION BY part_id, src_offset) AS frame_size FROM bars""",
    "placed": """
        SELECT *, CAST(row_number() OVER (PARTITION BY part_id ORDER BY src_offset, pos) - 1 AS BIGINT) AS place,
               row_number() OVER (PARTITION BY part_id, src_offset ORDER BY pos DESC) = 1 AS is_final,
               CAST(row_number() OVER (PARTITION BY part_id, src_offset ORDER BY pos) - 1 AS BIGINT) AS pos_in_frame
        FROM bars""",
    "ev": """
        SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               'pl' || CAST(user_id % 3 AS VARCHAR) AS pipeline_id FROM events""",
    "health": """
        SELECT event_id AS seq, ts AS seen, pipeline_id, 'p' || CAST(user_id % 5 AS VARCHAR) AS process_id,
               CASE event_type WHEN 'click' THEN 'commit_started' WHEN 'purchase' THEN 'commit_succeeded'
                    WHEN 'error' THEN ['data_file_write_failed', 'iceberg_commit_failed',
                      'iceberg_commit_state_unknown', 'offset_commit_failed', 'loader_failed'][1 + event_id % 5]
                    ELSE 'heartbeat' END AS event,
               k, CAST(round(value * 100) AS BIGINT) AS duration_ms
        FROM ev""",
    "logs": """
        SELECT pipeline_id, event_id AS seq, ts AS seen, event_type, k,
               CASE event_type WHEN 'view' THEN 'metrics' WHEN 'signup' THEN 'final metrics'
                    WHEN 'click' THEN 'no bar data within idle window; shutting down producer'
                    WHEN 'error' THEN ['delivery failed', 'Authentication rejected', 'commit lost',
                                       'socket closed'][1 + event_id % 4] END AS message,
               CASE WHEN event_type = 'error' THEN CASE WHEN k % 2 = 0 THEN 'ERROR' ELSE 'WARN' END
                    WHEN event_type = 'click' THEN 'WARN' ELSE 'INFO' END AS level,
               event_type IN ('view', 'signup') AND event_id % 10 <> 0 AS has_snapshot
        FROM ev""",
    "samples": """
        SELECT pipeline_id AS topic, seen, seq, k % 2 AS part_id,
               greatest(seq * 2 - (k % 4) * 40, 0) AS committed_offset, seq * 2 AS end_offset,
               k % 17 = 0 AS committing, k % 5 AS buffered_bars, k % 50 AS buffered_sources
        FROM health WHERE event = 'heartbeat'""",
    "billing": """
        SELECT l_shipdate AS usage_start_time, p_type AS service_name, 'USD' AS currency,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS cost,
               -CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)) AS credit
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "commits": """
        SELECT 't' || CAST(o_custkey % 5 AS VARCHAR) AS table_id, o_orderdate AS committed_at,
               count(*) AS added_records, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS added_bytes
        FROM orders GROUP BY 1, 2""",
    "files": """
        SELECT source AS table_id, lpad(CAST(doc_id AS VARCHAR), 12, '0') AS file_path,
               n_chars AS file_size, doc_id % 50 + 1 AS record_count FROM documents""",
}
NEEDS = {
    "framed": ["bars"],
    "placed": ["bars"],
    "health": ["ev"],
    "logs": ["ev"],
    "samples": ["ev", "health"],
}


def sql(body: str, *views: str, more: str = "") -> str:
    """``body`` behind the WITH clause of the views it uses and ``more`` named queries."""
    wanted: list[str] = []
    for view in views:
        for name in [*NEEDS.get(view, []), view]:
            if name not in wanted:
                wanted.append(name)
    clauses = [f"{name} AS ({VIEWS[name]})" for name in wanted]
    if more:
        clauses.append(more.strip())
    return f"WITH {', '.join(clauses)}\n{body}" if clauses else body
