"""Row types of the data model. Wire names are only used inside JSON text."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.LongType()) for name in names]


# Wire members in wire order, next to the stored names. ``T`` and ``t`` differ only
# by case, so frames are renamed by position as soon as they are parsed.
WIRE_MEMBERS = ("T", "S", "o", "h", "l", "c", "v", "t", "n", "vw")
BAR_COLUMNS = (
    "bar_type", "symbol", "open", "high", "low", "close",
    "volume", "event_time_text", "trade_count", "vwap",
)

FRAME = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("part_id", T.IntegerType()),
    T.StructField("src_offset", T.LongType()),
    T.StructField("raw", T.StringType()),
    T.StructField("received_at", T.TimestampType()),
])

# Every member is read as text so that quoted numbers survive and bad ones become null.
WIRE_BARS = T.ArrayType(T.StructType(_strings(*WIRE_MEMBERS)))
TEXT_BARS = T.ArrayType(T.StructType(_strings(*BAR_COLUMNS)))

CONTROL = T.ArrayType(T.StructType(
    _strings("T", "msg") + _longs("code") + [T.StructField("bars", T.ArrayType(T.StringType()))]
))

PARTITION_OFFSETS = T.ArrayType(T.StructType(
    _strings("topic")
    + _longs("partition", "committedOffset", "endOffset", "lagRecords",
             "committed_offset", "end_offset", "lag_records")
))

LOG_FIELDS = T.StructType(
    _strings("message", "snapshot")
    + _longs("idle_secs")
    + _strings("event", "state", "topic", "failure_type", "process_started_at_utc",
               "last_input_at_utc", "last_commit_at_utc")
    + _longs("last_commit_duration_ms", "durable_commit_total_duration_ms", "batch_bars",
             "batch_source_records", "aggregate_lag_records", "buffered_bars",
             "buffered_source_records")
    + [T.StructField("partitions", PARTITION_OFFSETS)]
)

HEALTH_PAYLOAD = T.StructType(
    _strings("timestamp", "level", "target") + [T.StructField("fields", LOG_FIELDS)]
)

LOG_PAYLOAD = T.StructType(
    _strings("_SYSTEMD_UNIT", "level", "severity", "target", "MESSAGE", "timestamp")
    + [T.StructField("fields", LOG_FIELDS)]
)

LOG_ENTRY = T.StructType(
    _strings("timestamp") + [T.StructField("jsonPayload", LOG_PAYLOAD)]
)

JOURNAL_LINE = T.StructType(
    _strings("_SYSTEMD_UNIT", "SYSLOG_IDENTIFIER", "MESSAGE", "timestamp")
)

COUNTERS = T.StructType(
    [T.StructField("connection_status", T.BooleanType())]
    + _longs("delivery_failures", "errors", "messages_received", "messages_sent",
             "queue_depth", "queue_capacity")
    + _strings("component", "last_message_ts", "last_delivery_ts")
)

TABLE_METADATA = T.StructType(
    _strings("last-updated-ms", "current-snapshot-id")
    + [
        T.StructField("snapshots", T.ArrayType(T.StructType(
            _strings("snapshot-id", "timestamp-ms")
            + [T.StructField("summary", T.MapType(T.StringType(), T.StringType()))]
        ))),
        T.StructField("metadata-log", T.ArrayType(T.StructType(_strings("metadata-file")))),
    ]
)

DAILY_COST_TEXT = T.ArrayType(T.StructType(_strings("day_utc", "net_cost")))
SERVICE_COST_TEXT = T.ArrayType(T.StructType(_strings("service_name", "net_cost")))

COST_SNAPSHOT_TEXT = T.StructType(
    _strings("aggregated_at_utc", "source_exported_at_utc", "currency",
             "seven_day_net_cost", "month_to_date_net_cost")
    + [
        T.StructField("daily_costs", DAILY_COST_TEXT),
        T.StructField("top_services", SERVICE_COST_TEXT),
    ]
)

BILLING_LINE = T.StructType([
    T.StructField("usage_start_time", T.TimestampType()),
    T.StructField("service", T.StructType(_strings("description"))),
    T.StructField("project", T.StructType(_strings("id"))),
    T.StructField("currency", T.StringType()),
    T.StructField("cost", T.DecimalType(38, 9)),
    T.StructField("credits", T.ArrayType(T.StructType(
        [T.StructField("amount", T.DecimalType(38, 9))]
    ))),
    T.StructField("export_time", T.TimestampType()),
])

LEDGER = T.StructType(
    _strings("query_id")
    + _longs("batch_id")
    + [
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
    ]
    + _strings("event", "failure_type", "data_commit_status", "offset_commit_status")
    + _longs("bars", "source_records", "quarantined_frames", "inserted", "duration_ms")
)
