"""Queries over logs and loader health: routing, sections, offsets, stalls, freshness."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from tickhouse.functions.codes import redacted
from tickhouse.functions.market import freshness, market_state, next_open
from tickhouse.functions.numbers import queue_depth
from tickhouse.functions.times import lenient_instant, millis_or_never, seconds_text
from tickhouse.operators import alerts as alerting
from tickhouse.operators import extractor, journal, loader
from tickhouse.plans.status import document_json, status_documents, with_health
from tickhouse.queries import inputs
from tickhouse.queries.inputs import sql
from tickhouse.queries.registry import query
from tickhouse.schemas import LOG_FIELDS
from tickhouse.settings import FAILURE_EVENTS, LIVE_READ_LIMITS
from tickhouse.streaming import views, watchdog
from tickhouse.streaming.run import drained

FAILURES = ", ".join(f"'{name}'" for name in FAILURE_EVENTS)
SECONDS = "'%Y-%m-%dT%H:%M:%SZ'"
MICROS = "'%Y-%m-%dT%H:%M:%S.%fZ'"


def _ntz(name: str):
    return F.col(name).cast("timestamp_ntz").alias(name)


# ---- journal --------------------------------------------------------------------------------


def _journal(spark, sf_dir):
    """Journal lines: loader health JSON, telemetry noise, extractor JSON, plain and foreign."""
    kind, k = F.col("event_type"), F.col("k")
    payload = F.to_json(F.struct(
        seconds_text(F.col("ts")).alias("timestamp"), F.lit("ERROR").alias("level"),
        F.lit("iceberg_loader::health").alias("target"),
        F.struct(F.lit("heartbeat").alias("event"), k.alias("buffered_bars")).alias("fields"),
    ))
    return inputs.events(spark, sf_dir).select(
        inputs.pipeline_name(F.col("user_id")).alias("pipeline_id"),
        F.col("event_id").alias("seq"),
        F.col("ts").alias("at"),
        F.when(kind == "click", F.lit("bar-loader.service"))
        .when(kind == "view", F.lit("bar-extractor.service"))
        .when(kind == "signup", F.lit("bar-broker.service"))
        .when(kind == "purchase", F.lit("init.scope"))
        .otherwise("cron.service").alias("unit"),
        F.when(kind == "purchase", "systemd").otherwise("app").alias("identifier"),
        F.when(kind == "click", F.when(k % 3 == 0, F.concat(F.lit("LOADER_HEALTH "), payload))
               .when(k % 3 == 1, "ClientTelemetryReporter - Client telemetry registered x")
               .otherwise("plain line"))
        .when(kind == "view", payload)
        .when(kind == "purchase", F.when(k % 2 == 0, "Started bar-loader").otherwise("Started cron"))
        .otherwise("text").alias("message"),
    )


ROUTE_SQL = """CASE event_type WHEN 'click' THEN CASE k % 3 WHEN 0 THEN 'loader_health' WHEN 2 THEN 'plain' END
  WHEN 'view' THEN 'extractor_json' WHEN 'signup' THEN 'plain'
  WHEN 'purchase' THEN CASE WHEN k % 2 = 0 THEN 'plain' END END"""


@query("journal_p18_routes", sql(
    f"SELECT * FROM (SELECT event_id AS seq, pipeline_id, {ROUTE_SQL} AS route FROM ev) WHERE route IS NOT NULL", "ev"))
def journal_routes(spark, sf_dir):
    """Each kept journal line takes exactly one route."""
    return journal.route_journal(_journal(spark, sf_dir)).select("seq", "pipeline_id", "route")


@query("journal_p18_parsed", sql(
    f"""SELECT event_id AS seq, route, CASE WHEN route = 'loader_health' THEN 'ERROR' END AS severity, k AS buffered_bars,
        strftime(ts, {SECONDS}) AS at_utc
        FROM (SELECT *, {ROUTE_SQL} AS route FROM ev) WHERE route IN ('loader_health', 'extractor_json')""", "ev"))
def journal_parsed(spark, sf_dir):
    """Routed JSON lines parsed into entries, loader level promoted to severity."""
    routed = journal.route_journal(_journal(spark, sf_dir))
    route = F.when(F.col("severity").isNotNull(), "loader_health").otherwise("extractor_json")
    return journal.parse_routed(routed).select(
        "seq", route.alias("route"), "severity", F.col("fields.buffered_bars").alias("buffered_bars"),
        seconds_text(F.col("at")).alias("at_utc"),
    )


def _all_entries(spark, sf_dir):
    """Extractor logs and loader health events as one log."""
    def typed(df, values):
        fields = F.struct(*[
            (values[f.name] if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in LOG_FIELDS.fields
        ])
        return df.withColumn("fields", fields).select(
            "pipeline_id", "seq", "at", "unit", "level", "severity", "target", "message", "fields"
        )

    logs = inputs.log_entries(spark, sf_dir)
    first = typed(logs, {"message": F.col("fields.message"), "snapshot": F.col("fields.snapshot")})
    names = ("event", "topic", "state", "last_input_at_utc", "last_commit_at_utc",
             "last_commit_duration_ms", "durable_commit_total_duration_ms", "batch_bars",
             "batch_source_records", "aggregate_lag_records", "buffered_bars", "buffered_source_records")
    rows = inputs.health_rows(spark, sf_dir)
    part = F.transform("partitions", lambda p: F.struct(
        F.lit(inputs.TOPIC), p["partition"], p["committed_offset"], p["end_offset"],
        p["lag_records"], F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(None).cast("long"),
    ))
    lit = F.lit(None).cast("string")
    second = rows.withColumns({
        "unit": F.lit("bar-loader.service"), "level": lit, "severity": lit,
        "target": F.lit("iceberg_loader::health"), "message": lit,
    })
    values = {name: F.col(name) for name in names}
    values |= {"process_started_at_utc": F.col("process_id"), "partitions": part}
    return first.unionByName(typed(second, values))


LOG_CLASS_SQL = f"""SELECT * FROM (
  SELECT pipeline_id, seq, seen, CASE WHEN message IN ('metrics', 'final metrics', 'no bar data within idle window; shutting down producer')
      OR level IN ('WARN', 'ERROR') THEN 'extractor' END AS log_class FROM logs
  UNION ALL SELECT pipeline_id, seq, seen, CASE WHEN event = 'heartbeat' THEN 'loader_heartbeats'
      WHEN event IN ({FAILURES}) THEN 'loader_failures' ELSE 'loader_commits' END FROM health)
  WHERE log_class IS NOT NULL"""


@query("journal_p8_log_class", sql(
    f"SELECT pipeline_id, seq, log_class, count(*) AS n FROM ({LOG_CLASS_SQL}) GROUP BY ALL", "logs", "health"))
def log_classes(spark, sf_dir):
    """Which of the four bounded reads each entry belongs to."""
    return journal.classify_logs(_all_entries(spark, sf_dir)).groupBy(
        "pipeline_id", "seq", "log_class"
    ).agg(F.count(F.lit(1)).alias("n"))


@query("journal_w8_newest", sql(
    f"""SELECT pipeline_id, seq, log_class FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_id, log_class
          ORDER BY seen DESC, seq DESC) AS rn FROM ({LOG_CLASS_SQL}))
        WHERE rn <= CASE log_class WHEN 'extractor' THEN 500 WHEN 'loader_heartbeats' THEN 4
          WHEN 'loader_commits' THEN 100 ELSE 20 END""", "logs", "health"))
def newest_logs(spark, sf_dir):
    """Newest 500/4/100/20 entries per pipeline and class."""
    classified = journal.classify_logs(_all_entries(spark, sf_dir))
    return journal.newest_per_class(classified, LIVE_READ_LIMITS).select("pipeline_id", "seq", "log_class")


# ---- extractor ------------------------------------------------------------------------------


@query("extractor_p9_events", sql(
    f"""SELECT pipeline_id, seq, message, CASE WHEN has_snapshot THEN k END AS messages_received,
          CASE WHEN has_snapshot THEN strftime(seen, {MICROS}) END AS last_message_ts
        FROM logs WHERE message IS NOT NULL""", "logs"))
def extractor_events(spark, sf_dir):
    """Extractor events with the counters parsed out of their JSON string."""
    return extractor.extractor_events(inputs.log_entries(spark, sf_dir)).select(
        "pipeline_id", "seq", "message", "snapshot.messages_received", "snapshot.last_message_ts"
    )


EXTRACTOR_ALERT_SQL = """SELECT pipeline_id, seq, seen, 'extractor' AS component,
  CASE WHEN level = 'ERROR' THEN 'ERROR' ELSE 'WARNING' END AS severity,
  'extractor_' || CASE WHEN lower(message) LIKE '%delivery%' THEN 'delivery_failure'
    WHEN lower(message) LIKE '%authentication%' THEN 'authentication'
    WHEN lower(message) LIKE '%commit%' THEN 'commit_failure' ELSE 'warning' END AS code
  FROM logs WHERE event_type = 'error'"""


@query("extractor_p11_alerts", sql(
    f"SELECT pipeline_id, seq, severity, code FROM ({EXTRACTOR_ALERT_SQL})", "logs"))
def extractor_alerts(spark, sf_dir):
    """Coded extractor alerts."""
    return extractor.extractor_alerts(inputs.log_entries(spark, sf_dir)).select(
        "pipeline_id", "seq", "severity", "code"
    )


def _activity(spark, sf_dir, stream=False):
    kind = F.col("event_type")
    return inputs.events(spark, sf_dir, stream).select(
        F.concat(F.lit("c"), (F.col("user_id") % 4).cast("string")).alias("component"),
        F.col("ts").alias("at"),
        F.when(kind == "view", "received").when(kind == "click", "sent")
        .when(kind == "purchase", "delivery_failure").otherwise("error").alias("kind"),
    )


COUNTERS_SQL = """WITH w AS (SELECT 'c' || CAST(user_id % 4 AS VARCHAR) AS component, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
         count_if(event_type = 'view') AS r, count_if(event_type = 'click') AS s, count_if(event_type = 'purchase') AS d,
         count_if(event_type NOT IN ('view', 'click', 'purchase')) AS e,
         max(CASE WHEN event_type = 'view' THEN ts END) AS m, max(CASE WHEN event_type = 'click' THEN ts END) AS l
       FROM events GROUP BY 1, 2)
       SELECT component, window_start, CAST(sum(r) OVER o AS BIGINT) AS messages_received, CAST(sum(s) OVER o AS BIGINT) AS messages_sent,
         CAST(sum(d) OVER o AS BIGINT) AS delivery_failures, CAST(sum(e) OVER o AS BIGINT) AS errors,
         max(m) OVER o AS last_message_at, max(l) OVER o AS last_delivery_at
       FROM w WINDOW o AS (PARTITION BY component ORDER BY window_start)"""


def _counter_columns(totals):
    return totals.select(
        "component", _ntz("window_start"), "messages_received", "messages_sent",
        "delivery_failures", "errors", _ntz("last_message_at"), _ntz("last_delivery_at"),
    )


@query("extractor_a5_counters", sql(COUNTERS_SQL))
def counters(spark, sf_dir):
    """Cumulative extractor counters at the end of each interval (A5, T5)."""
    return _counter_columns(extractor.counter_windows(_activity(spark, sf_dir), 3600))


@query("extractor_t5_live_counters", sql(COUNTERS_SQL))
def live_counters(spark, sf_dir):
    """The same counters from the stream's closed intervals and the snapshots it owes when drained (T5)."""
    emitted = drained(views.stream_counters(_activity(spark, sf_dir, stream=True), 3600))
    owed = views.final_counters(emitted, _activity(spark, sf_dir), 3600)
    return _counter_columns(emitted.unionByName(owed))


@query("extractor_a8_summary", sql(
    f"""SELECT pipeline_id, CASE WHEN lm = 'final metrics' THEN 'clean_shutdown' ELSE 'observed' END AS status,
          strftime(last_at, {SECONDS}) AS last_event_utc, lk AS messages_received,
          CASE WHEN lm = 'final metrics' THEN strftime(lat, {SECONDS}) END AS final_metrics_at_utc,
          CASE WHEN lm = 'final metrics' AND shut THEN 'idle_window' END AS shutdown_reason
        FROM (SELECT pipeline_id, max(seen) AS last_at, bool_or(event_type = 'click') AS shut,
            arg_max(message, (seen, seq)) FILTER (WHERE event_type IN ('view', 'signup')) AS lm,
            arg_max(seen, (seen, seq)) FILTER (WHERE event_type IN ('view', 'signup')) AS lat,
            arg_max(CASE WHEN has_snapshot THEN k ELSE -1 END, (seen, seq)) FILTER (WHERE event_type IN ('view', 'signup')) AS lk0,
            nullif(lk0, -1) AS lk
          FROM logs WHERE message IS NOT NULL GROUP BY 1)""", "logs"))
def extractor_section(spark, sf_dir):
    """Extractor section per pipeline."""
    events = extractor.extractor_events(inputs.log_entries(spark, sf_dir))
    return extractor.extractor_summary(events).select(
        "pipeline_id", "status", "last_event_utc", "messages_received", "final_metrics_at_utc",
        "shutdown_reason",
    )


@query("extractor_t4_idle_gaps", sql(
    """SELECT * FROM (SELECT 'c' || CAST(user_id % 4 AS VARCHAR) AS component,
          lag(ts) OVER (PARTITION BY user_id % 4 ORDER BY ts) AS last_message_at, ts AS resumed_at,
          epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id % 4 ORDER BY ts)) AS idle_micros FROM events)
       WHERE idle_micros >= 600000000"""))
def idle_gaps(spark, sf_dir):
    """Idle stretches of at least ten minutes per component (T4)."""
    frames = _activity(spark, sf_dir).withColumnRenamed("at", "received_at")
    return extractor.idle_gaps(frames, 600).select(
        "component", _ntz("last_message_at"), _ntz("resumed_at"), "idle_micros"
    )


@query("extractor_t4_idle_now", sql(
    """SELECT 'c' || CAST(user_id % 8 AS VARCHAR) AS component, max(CASE WHEN event_type = 'view' THEN ts END) AS last_message_at,
          coalesce(max(CASE WHEN event_type = 'view' THEN ts END), min(ts)) <= TIMESTAMP '2024-01-30 23:00:00' - INTERVAL 600 SECOND AS is_idle
       FROM events GROUP BY 1"""))
def idle_now(spark, sf_dir):
    """Which components have been idle at a given moment, start time as the baseline (T4)."""
    rows = inputs.events(spark, sf_dir).withColumn(
        "component", F.concat(F.lit("c"), (F.col("user_id") % 8).cast("string"))
    )
    starts = rows.groupBy("component").agg(F.min("ts").alias("started_at"))
    frames = rows.filter(F.col("event_type") == "view").withColumnRenamed("ts", "received_at")
    now = F.lit(datetime(2024, 1, 30, 23, tzinfo=timezone.utc))
    return extractor.idle_now(frames, starts, now, 600).select(
        "component", _ntz("last_message_at"), "is_idle"
    )


@query("extractor_t4_live_watch", sql(
    """WITH a AS (SELECT 'c' || CAST(user_id % 4 AS VARCHAR) AS component, ts, event_type FROM events),
       s AS (SELECT component, max(ts) AS started_at FROM a WHERE event_type = 'signup' GROUP BY 1),
       l AS (SELECT component, max(ts) AS last FROM a WHERE event_type = 'view' GROUP BY 1)
       SELECT component, started_at, CASE WHEN last >= coalesce(started_at, last) THEN last END AS last_message_at,
         greatest(coalesce(started_at, last), coalesce(last, started_at)) + INTERVAL 600 SECOND AS idle_at
       FROM s FULL JOIN l USING (component)"""))
def live_watch(spark, sf_dir):
    """Components that the live watchdog finds silent once the stream has run dry (T4)."""
    kind = F.col("event_type")
    activity = inputs.events(spark, sf_dir, stream=True).select(
        F.concat(F.lit("c"), (F.col("user_id") % 4).cast("string")).alias("component"), F.col("ts").alias("at"),
        F.when(kind == "signup", watchdog.STARTED).when(kind == "view", watchdog.DATA).otherwise("keepalive").alias("kind"))
    found = drained(watchdog.stream_idle(activity, 600), timers=True)
    return found.select("component", _ntz("started_at"), _ntz("last_message_at"), _ntz("idle_at"))


@query("extractor_f9_queue_and_redaction", sql(
    f"""SELECT event_id, CASE WHEN k % 4 = 0 THEN NULL ELSE to_timestamp(k * 1000)::TIMESTAMP END AS last_delivery_at,
          greatest(60 - k, 0) AS queue_depth,
          CASE WHEN length(event_type) <= 4 THEN '<redacted>' ELSE left(event_type, 4) || '…<redacted>' END AS shown_secret
        FROM ev""", "ev"))
def small_extractor_values(spark, sf_dir):
    """Zero-means-never times, queue depth and redaction."""
    k = F.col("k")
    return inputs.events(spark, sf_dir).select(
        "event_id",
        millis_or_never(F.when(k % 4 == 0, F.lit(0)).otherwise(k * 1_000_000))
        .cast("timestamp_ntz").alias("last_delivery_at"),
        queue_depth(F.lit(60).cast("long"), k).alias("queue_depth"),
        redacted(F.col("event_type")).alias("shown_secret"),
    )


# ---- loader ---------------------------------------------------------------------------------


@query("loader_p10_events", sql(
    """SELECT pipeline_id, seq, event, process_id, CASE WHEN event = 'commit_started' THEN k * 10 END AS batch_bars,
          k % 2 AS partition, k AS lag_records FROM health""", "health"))
def loader_events(spark, sf_dir):
    """Recognised loader events out of the mixed log, offsets normalised."""
    return loader.loader_events(_all_entries(spark, sf_dir)).select(
        "pipeline_id", "seq", "event", "process_id", "batch_bars",
        F.get("partitions", F.lit(0))["partition"].alias("partition"),
        F.get("partitions", F.lit(0))["lag_records"].alias("lag_records"),
    )


LOADER_ALERT_SQL = f"""SELECT pipeline_id, seq, seen, 'loader' AS component, 'ERROR' AS severity,
  CASE WHEN event LIKE 'loader\\_%' ESCAPE '\\' THEN event ELSE 'loader_' || event END AS code
  FROM health WHERE event IN ({FAILURES})"""


@query("loader_p12_alerts", sql(
    f"SELECT pipeline_id, seq, severity, code FROM ({LOADER_ALERT_SQL})", "health"))
def loader_alerts(spark, sf_dir):
    """Failures as ERROR alerts."""
    return loader.loader_alerts(inputs.health_rows(spark, sf_dir)).select(
        "pipeline_id", "seq", "severity", "code"
    )


PAIR_SQL = f"""SELECT pipeline_id, process_id, seq, seen, CASE WHEN pe = 'commit_started' THEN pk * 10 END AS bars,
  CASE WHEN pe = 'commit_started' THEN pk END AS source_records, duration_ms, strftime(seen, {SECONDS}) AS at_utc
  FROM (SELECT *, lag(event) OVER w AS pe, lag(k) OVER w AS pk FROM health WHERE event <> 'heartbeat'
        WINDOW w AS (PARTITION BY pipeline_id, process_id ORDER BY seen, seq)) WHERE event = 'commit_succeeded'"""


@query("loader_j2_commit_pairs", sql(
    f"SELECT pipeline_id, process_id, seq, bars, source_records, duration_ms, at_utc FROM ({PAIR_SQL})", "health"))
def commit_pairs(spark, sf_dir):
    """Every successful commit with the sizes its start announced."""
    return loader.pair_commits(inputs.health_rows(spark, sf_dir)).drop("at")


@query("loader_w9_recent_commits", sql(
    f"""SELECT * FROM (SELECT pipeline_id, seq, bars, duration_ms, row_number() OVER (PARTITION BY pipeline_id
          ORDER BY seen DESC, seq DESC) AS newest_rank FROM ({PAIR_SQL})) WHERE newest_rank <= 48""", "health"))
def recent_commits(spark, sf_dir):
    """Last 48 commits per pipeline."""
    pairs = loader.pair_commits(inputs.health_rows(spark, sf_dir))
    return loader.recent(pairs, 48).select(
        "pipeline_id", "seq", "bars", "duration_ms", F.col("newest_rank").cast("long").alias("newest_rank")
    )


@query("loader_a6_failures", sql(
    f"""SELECT pipeline_id, CAST(count_if(event IN ({FAILURES})) AS BIGINT) AS failure_count, FALSE AS failure_count_is_capped,
          max(seen) FILTER (WHERE event IN ({FAILURES})) AS last_failure_at,
          'loader_' || replace(arg_max(event, (seen, seq)) FILTER (WHERE event IN ({FAILURES})), 'loader_', '') AS last_failure_code
        FROM health GROUP BY 1""", "health"))
def failures(spark, sf_dir):
    """Failure count, cap flag, newest failure."""
    return loader.failure_summary(inputs.health_rows(spark, sf_dir)).select(
        "pipeline_id", "failure_count", "failure_count_is_capped", _ntz("last_failure_at"),
        "last_failure_code",
    )


LATEST_SQL = """
l AS (SELECT pipeline_id, arg_max(process_id, (seen, seq)) AS lp, max(seq) AS event_seq FROM health GROUP BY 1),
h AS (SELECT health.pipeline_id, arg_max(seq, (seen, seq)) AS heartbeat_seq FROM health JOIN l ON health.pipeline_id = l.pipeline_id
      AND process_id = lp WHERE event = 'heartbeat' GROUP BY 1),
s AS (SELECT pipeline_id, arg_max(seq, (seen, seq)) AS success_seq FROM health WHERE event = 'commit_succeeded' GROUP BY 1)
"""


@query("loader_a7_latest", sql(
    """SELECT l.pipeline_id, lp AS process_id, event_seq, heartbeat_seq, success_seq
       FROM l LEFT JOIN h USING (pipeline_id) LEFT JOIN s USING (pipeline_id)""", "health", more=LATEST_SQL))
def latest(spark, sf_dir):
    """Newest event, newest heartbeat of its process, newest success of any process."""
    return loader.latest_signals(inputs.health_rows(spark, sf_dir)).select(
        "pipeline_id", "latest_event.process_id", F.col("latest_event.seq").alias("event_seq"),
        F.col("latest_heartbeat.seq").alias("heartbeat_seq"),
        F.col("latest_success.seq").alias("success_seq"),
    )


@query("loader_d4_section", sql(
    f"""SELECT l.pipeline_id, CASE WHEN hb.k > 90 THEN 'stalled' ELSE 'idle' END AS state,
          strftime(hb.seen, {SECONDS}) AS latest_heartbeat_utc, strftime(ok.seen, {SECONDS}) AS last_commit_utc,
          ok.duration_ms AS last_commit_duration_ms, hb.k AS aggregate_lag_records, hb.k * 2 AS buffered_bars,
          CAST(1 AS BIGINT) AS partition_count,
          least(48, (SELECT count(*) FROM health c WHERE c.pipeline_id = l.pipeline_id AND event = 'commit_succeeded')) AS recent_commit_count
        FROM l JOIN h USING (pipeline_id) JOIN s USING (pipeline_id) JOIN health hb ON hb.seq = heartbeat_seq
          JOIN health ok ON ok.seq = success_seq""", "health", more=LATEST_SQL))
def loader_section(spark, sf_dir):
    """Loader section per pipeline."""
    return loader.loader_summary(inputs.health_rows(spark, sf_dir)).select(
        "pipeline_id", "state", "latest_heartbeat_utc", "last_commit_utc", "last_commit_duration_ms",
        "aggregate_lag_records", "buffered_bars", F.size("partitions").cast("long").alias("partition_count"),
        F.size("recent_commits").cast("long").alias("recent_commit_count"),
    )


@query("loader_j1_offsets", sql(
    """SELECT 't' || CAST(user_id AS VARCHAR) AS topic, user_id % 3 AS part_id, c AS committed_offset, e AS end_offset,
          greatest(0, e - c) AS lag_records
       FROM (SELECT user_id, coalesce(max(event_id) FILTER (WHERE event_type = 'purchase'),
               CASE WHEN user_id % 2 = 0 THEN min(event_id) END, 0) AS c,
               coalesce(max(event_id) FILTER (WHERE event_type = 'view'), c) AS e FROM events GROUP BY 1)"""))
def offsets(spark, sf_dir):
    """Committed, end and lag of each assigned partition."""
    keyed = inputs.events(spark, sf_dir).select(
        F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("topic"),
        (F.col("user_id") % 3).alias("part_id"), "user_id", "event_id", "event_type",
    )
    keys = ["topic", "part_id"]

    def newest(kind, name):
        return keyed.filter(F.col("event_type") == kind).groupBy(*keys).agg(F.max("event_id").alias(name))

    beginning = keyed.filter(F.col("user_id") % 2 == 0).groupBy(*keys).agg(
        F.min("event_id").alias("beginning_offset"))
    return loader.resolve_offsets(
        keyed.select(*keys).distinct(), newest("purchase", "committed_offset"), beginning,
        newest("view", "end_offset"),
    )


@query("loader_a3_topic_lag", sql(
    """SELECT topic, CAST(count(*) AS BIGINT) AS partition_count, CAST(min(part_id) AS BIGINT) AS first_part, CAST(sum(greatest(0, e - c)) AS BIGINT) AS aggregate_lag_records
       FROM (SELECT 't' || CAST(user_id % 10 AS VARCHAR) AS topic, user_id AS part_id, max(event_id) AS e,
               coalesce(max(event_id) FILTER (WHERE event_type = 'purchase'), 0) AS c FROM events GROUP BY 1, 2) GROUP BY 1"""))
def topic_lag(spark, sf_dir):
    """Partitions of each topic in order with their summed lag."""
    keyed = inputs.events(spark, sf_dir).select(
        F.concat(F.lit("t"), (F.col("user_id") % 10).cast("string")).alias("topic"),
        F.col("user_id").alias("part_id"), "event_id", "event_type",
    )
    keys = ["topic", "part_id"]
    committed = keyed.filter(F.col("event_type") == "purchase").groupBy(*keys).agg(
        F.max("event_id").alias("committed_offset"))
    none = keyed.filter(F.lit(False)).select(*keys, F.col("event_id").alias("beginning_offset"))
    end = keyed.groupBy(*keys).agg(F.max("event_id").alias("end_offset"))
    resolved = loader.resolve_offsets(end.select(*keys), committed, none, end)
    return loader.partition_arrays(resolved).select(
        "topic", F.size("partitions").cast("long").alias("partition_count"),
        F.get("partitions", F.lit(0))["part_id"].alias("first_part"), "aggregate_lag_records",
    )


TRACK_SQL = """
a AS (SELECT *, greatest(0, end_offset - committed_offset) AS lag_records, lag(part_id) OVER w AS pp, lag(committed_offset) OVER w AS pc
      FROM samples WINDOW w AS (PARTITION BY topic ORDER BY seen, seq)),
b AS (SELECT *, coalesce(pp = part_id AND committed_offset > pc, FALSE) AS progressed,
        count_if(lag_records = 0) OVER (PARTITION BY topic ORDER BY seen, seq) AS island FROM a),
c AS (SELECT *, CASE WHEN lag_records > 0 THEN min(seen) FILTER (WHERE lag_records > 0) OVER (PARTITION BY topic, island) END AS positive_lag_since,
        max(CASE WHEN lag_records = 0 OR progressed THEN seen END) OVER (PARTITION BY topic ORDER BY seen, seq) AS last_progress_at FROM b),
d AS (SELECT *, CASE WHEN committing THEN 'committing'
        WHEN lag_records > 0 AND seen - greatest(positive_lag_since, coalesce(last_progress_at, positive_lag_since)) >= INTERVAL 300 SECOND THEN 'stalled'
        WHEN lag_records > buffered_sources THEN 'catching_up' WHEN buffered_bars > 0 OR buffered_sources > 0 THEN 'buffering' ELSE 'idle' END AS state FROM c)
"""


def _tracked(spark, sf_dir):
    return loader.track_health(inputs.offset_samples(spark, sf_dir), stall_seconds=300)


@query("loader_w4_progress", sql(
    "SELECT topic, seq, lag_records, progressed, positive_lag_since, last_progress_at FROM c",
    "samples", more=TRACK_SQL))
def progress(spark, sf_dir):
    """Lag, progress, start of the lag and last durable progress per sample."""
    return _tracked(spark, sf_dir).select(
        "topic", "seq", "lag_records", "progressed", _ntz("positive_lag_since"), _ntz("last_progress_at")
    )


@query("loader_w7_stalls", sql(
    """SELECT topic, seq, state, state = 'stalled' AND coalesce(lag(state) OVER (PARTITION BY topic
         ORDER BY seen, seq), '') <> 'stalled' AS stall_reported FROM d""", "samples", more=TRACK_SQL))
def stalls(spark, sf_dir):
    """State of every sample; a stall is reported once when it begins."""
    return _tracked(spark, sf_dir).select("topic", "seq", "state", "stall_reported")


# ---- calendar and health --------------------------------------------------------------------

@query("market_f11_state", sql(
    """WITH n AS (SELECT event_id, timezone('America/New_York', timezone('UTC', ts + to_days(CAST(event_id % 300 AS INTEGER)))) AS loc FROM events),
       m AS (SELECT *, isodow(loc) AS d, hour(loc) * 60 + minute(loc) AS mi FROM n)
       SELECT event_id, CASE WHEN d >= 6 THEN 'weekend' WHEN mi < 570 THEN 'pre_open' WHEN mi < 960 THEN 'market_open' WHEN mi < 1020 THEN 'settling' ELSE 'closed' END AS state,
         timezone('UTC', timezone('America/New_York', date_trunc('day', loc) + to_days(CAST(CASE WHEN d >= 6 THEN 8 - d WHEN mi < 570 THEN 0 WHEN d = 5 THEN 3 ELSE 1 END AS INTEGER)) + INTERVAL 570 MINUTE)) AS next_open_at
       FROM m"""))
def market(spark, sf_dir):
    """Market state and next opening across a year, daylight saving included."""
    seen = F.timestamp_micros(F.unix_micros("ts") + (F.col("event_id") % 300) * 86_400_000_000)
    return inputs.events(spark, sf_dir).select(
        "event_id", market_state(seen).alias("state"),
        next_open(seen).cast("timestamp_ntz").alias("next_open_at"),
    )


@query("market_f13_freshness", sql(
    """SELECT event_id, CASE WHEN event_id % 9 = 0 OR k > 60 THEN 'unhealthy' WHEN k > 30 AND event_id % 2 = 0 THEN 'warning'
          WHEN event_id % 2 = 0 THEN 'healthy' ELSE 'unhealthy' END AS status,
          CASE WHEN event_id % 9 = 0 THEN 'missing_bar' WHEN k > 60 THEN 'stale_bar' WHEN k > 30 AND event_id % 2 = 0 THEN 'aging_bar' END AS reason FROM ev""", "ev"))
def fresh(spark, sf_dir):
    """Freshness grade with strict limits."""
    seen = F.timestamp_micros(F.unix_micros("ts") - F.col("k") * 60_000_000)
    status, reason = freshness(
        "bar", F.when(F.col("event_id") % 2 == 0, "healthy").otherwise("unhealthy"),
        F.when(F.col("event_id") % 9 != 0, seen), F.col("ts"), 30, 60,
    )
    return inputs.events(spark, sf_dir).select("event_id", status.alias("status"), reason.alias("reason"))


def _alerts(spark, sf_dir):
    return alerting.all_alerts(
        extractor.extractor_alerts(inputs.log_entries(spark, sf_dir)),
        loader.loader_alerts(inputs.health_rows(spark, sf_dir)),
    )


ALERT_UNION = f"({EXTRACTOR_ALERT_SQL} UNION ALL BY NAME {LOADER_ALERT_SQL})"


@query("status_j3_unresolved", sql(
    f"""SELECT pipeline_id, seq, component, code FROM {ALERT_UNION} LEFT JOIN lc USING (pipeline_id)
        WHERE severity = 'ERROR' AND (component <> 'loader' OR lc IS NULL OR date_trunc('second', seen) > date_trunc('second', lc))""",
    "logs", "health",
    more="lc AS (SELECT pipeline_id, max(seen) AS lc FROM health WHERE event = 'commit_succeeded' GROUP BY 1)"))
def unresolved(spark, sf_dir):
    """ERROR alerts no later commit has resolved."""
    commits = loader.last_commits(inputs.health_rows(spark, sf_dir))
    return alerting.unresolved(_alerts(spark, sf_dir), commits).select(
        "pipeline_id", "seq", "component", "code"
    )


@query("status_o4_newest_alerts", sql(
    f"""SELECT * FROM (SELECT pipeline_id, seq, component, code, row_number() OVER (PARTITION BY pipeline_id
          ORDER BY date_trunc('second', seen) DESC, seq, component) AS alert_rank FROM {ALERT_UNION}) WHERE alert_rank <= 20""", "logs", "health"))
def newest_alerts(spark, sf_dir):
    """Twenty newest alerts per pipeline."""
    return alerting.newest_alerts(_alerts(spark, sf_dir)).select(
        "pipeline_id", "seq", "component", "code", F.col("alert_rank").cast("long").alias("alert_rank")
    )


HEALTH_CTES = """
n AS (SELECT event_id, k, ts AS now, timezone('America/New_York', timezone('UTC', ts)) AS loc,
    CASE WHEN event_id % 6 = 0 THEN NULL ELSE ts - to_minutes(k % 15) END AS bar,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts - to_minutes(k % 20) END AS com,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE ts - to_minutes(k % 12) END AS beat,
    event_id % 4 = 0 AS silent, event_id % 5 = 0 AS no_final, k % 23 = 0 AS stalled, k % 29 = 0 AS err FROM ev),
m AS (SELECT *, isodow(loc) AS d, hour(loc) * 60 + minute(loc) AS mi FROM n),
s AS (SELECT *, CASE WHEN d >= 6 THEN 'weekend' WHEN mi < 570 THEN 'pre_open' WHEN mi < 960 THEN 'market_open' WHEN mi < 1020 THEN 'settling' ELSE 'closed' END AS state FROM m),
t AS (SELECT *, date_trunc('second', bar) AS barx, date_trunc('second', com) AS comx, date_trunc('second', beat) AS beatx FROM s),
r1 AS (SELECT *, CASE WHEN state <> 'market_open' THEN NULL WHEN barx IS NULL THEN 'missing_extractor_bar' WHEN now - barx > INTERVAL 10 MINUTE THEN 'stale_extractor_bar'
   WHEN now - barx > INTERVAL 5 MINUTE THEN 'aging_extractor_bar' END AS x1 FROM t),
r2 AS (SELECT *, CASE WHEN state <> 'market_open' THEN NULL WHEN comx IS NULL THEN 'missing_loader_commit' WHEN now - comx > INTERVAL 15 MINUTE THEN 'stale_loader_commit'
   WHEN now - comx > INTERVAL 10 MINUTE AND coalesce(x1, '') NOT LIKE 'missing%' AND coalesce(x1, '') NOT LIKE 'stale%' THEN 'aging_loader_commit' END AS x2 FROM r1),
r3 AS (SELECT *, CASE WHEN x1 LIKE 'missing%' OR x1 LIKE 'stale%' OR x2 LIKE 'missing%' OR x2 LIKE 'stale%' THEN 'unhealthy'
   WHEN x1 IS NOT NULL OR x2 IS NOT NULL THEN 'warning' WHEN state = 'settling' AND no_final THEN 'warning'
   WHEN state IN ('closed', 'weekend', 'pre_open') AND silent THEN 'unknown' ELSE 'healthy' END AS st1,
   CASE WHEN state = 'settling' AND no_final THEN 'awaiting_clean_shutdown' END AS x3,
   CASE WHEN state IN ('closed', 'weekend', 'pre_open') AND silent THEN 'no_recent_session' END AS x4 FROM r2),
r4 AS (SELECT *, CASE WHEN beatx IS NULL THEN 'missing_loader_heartbeat' WHEN now - beatx > INTERVAL 10 MINUTE THEN 'stale_loader_heartbeat'
   WHEN now - beatx > INTERVAL 5 MINUTE AND st1 <> 'unhealthy' THEN 'aging_loader_heartbeat' END AS x5 FROM r3)"""


@query("status_d2_roll_up", sql(
    """SELECT event_id, CASE WHEN stalled OR err OR x5 LIKE 'missing%' OR x5 LIKE 'stale%' THEN 'unhealthy'
         WHEN x5 IS NOT NULL THEN 'warning' ELSE st1 END AS status,
         concat_ws(',', x1, x2, x3, x4, x5, CASE WHEN stalled THEN 'loader_stalled' END,
           CASE WHEN err THEN 'recent_error' END) AS reasons FROM r4""", "ev", more=HEALTH_CTES))
def health_roll_up(spark, sf_dir):
    """Health status and ordered reasons for many situations."""
    k, number, now = F.col("k"), F.col("event_id"), F.col("ts")

    def ago(minutes, missing):
        seen = F.timestamp_micros(F.unix_micros("ts") - minutes * 60_000_000)
        return F.when(number % missing != 0, seconds_text(seen))

    ex = F.struct(
        ago(k % 15, 6).alias("last_bar_utc"),
        F.when(number % 5 != 0, seconds_text(now)).alias("final_metrics_at_utc"),
        F.when(number % 4 == 0, "no_recent_session").otherwise("observed").alias("status"),
    )
    ld = F.struct(
        ago(k % 20, 11).alias("last_commit_utc"), ago(k % 12, 13).alias("latest_heartbeat_utc"),
        F.when(k % 23 == 0, "stalled").otherwise("idle").alias("state"),
    )
    rows = inputs.events(spark, sf_dir).select(
        "event_id", "ts", ex.alias("extractor"), ld.alias("loader"),
        market_state(now).alias("state"), (k % 29 == 0).alias("open_error"),
    )
    return with_health(rows, now).select(
        "event_id", "health.status", F.concat_ws(",", "health.reasons").alias("reasons")
    )


DOCUMENT_NOW = datetime(2024, 1, 30, 20, 30, tzinfo=timezone.utc)
DOCUMENT_CTES = f"""
e1 AS (SELECT pipeline_id, arg_max(message, (seen, seq)) FILTER (WHERE event_type IN ('view', 'signup')) AS lm FROM logs GROUP BY 1),
h1 AS (SELECT pipeline_id, max(seen) FILTER (WHERE event = 'commit_succeeded') AS lc,
         count(*) FILTER (WHERE event IN ({FAILURES})) AS nf FROM health GROUP BY 1),
c1 AS (SELECT pipeline_id, string_agg(at_utc || '/' || coalesce(CAST(bars AS VARCHAR), '-') || '/' || CAST(duration_ms AS VARCHAR), ',' ORDER BY seen, seq) AS commits
       FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_id ORDER BY seen DESC, seq DESC) AS rn FROM ({PAIR_SQL})) WHERE rn <= 48 GROUP BY 1),
a1 AS (SELECT pipeline_id, string_agg(strftime(seen, {SECONDS}) || '/' || component || '/' || severity || '/' || code, ',' ORDER BY rn) AS alerts
       FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_id ORDER BY date_trunc('second', seen) DESC, seq, component) AS rn
             FROM {ALERT_UNION}) WHERE rn <= 20 GROUP BY 1)"""


def _document_inputs(entries):
    """A metadata document for every pipeline but the third, a cost snapshot for every one but the second."""
    names = entries.select("pipeline_id").distinct()
    size = F.length("pipeline_id")
    metadata = names.filter(~F.col("pipeline_id").endswith("2")).select("pipeline_id", F.format_string(
        '{"current-snapshot-id":5,"snapshots":[{"snapshot-id":5,"timestamp-ms":86400000,"summary":'
        '{"operation":"append","total-records":"%d","total-data-files":"4"}}],"metadata-log":[]}',
        size * 100).alias("metadata"))
    money = lambda n: (size * n).cast("string")
    costs = names.filter(~F.col("pipeline_id").endswith("1")).select(
        "pipeline_id", F.lit("2024-01-30T06:07:00Z").alias("aggregated_at_utc"),
        F.lit("2024-01-30T05:00:00Z").alias("source_exported_at_utc"), F.lit("USD").alias("currency"),
        money(3).alias("seven_day_net_cost"), money(5).alias("month_to_date_net_cost"),
        F.array(F.struct(F.lit("2024-01-30").alias("day_utc"), money(1).alias("net_cost"))).alias("daily_costs"),
        F.array(F.struct(F.lit("Storage").alias("service_name"), money(2).alias("net_cost"))).alias("top_services"),
    )
    return metadata, costs


@query("status_d1_documents", sql(
    f"""SELECT pipeline_id, 'market_open' AS market_state, '2024-01-31T14:30:00Z' AS next_open,
          CASE lm WHEN 'final metrics' THEN 'clean_shutdown' WHEN 'metrics' THEN 'observed' ELSE 'no_recent_session' END AS extractor_status,
          strftime(lc, {SECONDS}) AS last_commit_utc, coalesce(commits, '') AS recent_commits, nf AS failure_count, FALSE AS capped,
          coalesce(alerts, '') AS alerts
        FROM h1 LEFT JOIN e1 USING (pipeline_id) LEFT JOIN c1 USING (pipeline_id) LEFT JOIN a1 USING (pipeline_id)""",
    "logs", "health", more=DOCUMENT_CTES))
def documents(spark, sf_dir):
    """Whole status documents over every entry, read back from their JSON text."""
    texts = document_json(status_documents(_all_entries(spark, sf_dir), DOCUMENT_NOW))

    def at(path):
        return F.get_json_object("document", path)

    def listed(path, kind, *names):
        items = F.from_json(at(path), f"array<struct<{kind}>>")
        return F.array_join(F.transform(items, lambda i: F.concat_ws(
            "/", *[F.coalesce(i[n].cast("string"), F.lit("-")) for n in names])), ",")

    return texts.select(
        "pipeline_id",
        at("$.market.state").alias("market_state"),
        at("$.market.next_expected_open_utc").alias("next_open"),
        at("$.extractor.status").alias("extractor_status"),
        at("$.loader.last_commit_utc").alias("last_commit_utc"),
        listed("$.loader.recent_commits", "at_utc:string,bars:bigint,duration_ms:bigint",
               "at_utc", "bars", "duration_ms").alias("recent_commits"),
        at("$.loader.failure_count").cast("long").alias("failure_count"),
        at("$.loader.failure_count_is_capped").cast("boolean").alias("capped"),
        listed("$.alerts", "at_utc:string,component:string,severity:string,code:string",
               "at_utc", "component", "severity", "code").alias("alerts"),
    )


@query("status_d1_sections", sql(
    """SELECT pipeline_id, CASE WHEN t THEN 'available' ELSE 'unavailable' END AS table_status, CASE WHEN NOT t THEN 'not_configured' END AS table_reason,
         CASE WHEN t THEN length(pipeline_id) * 100 END AS total_records, CASE WHEN t THEN '1970-01-02T00:00:00Z' END AS committed,
         CASE WHEN c THEN 'available' ELSE 'unavailable' END AS cost_status, CASE WHEN NOT c THEN 'not_configured' END AS cost_reason,
         CASE WHEN c THEN (length(pipeline_id) * 3)::DOUBLE END AS seven_day, CASE WHEN c THEN length(pipeline_id)::DOUBLE END AS today,
         CASE WHEN c THEN 'Storage' END AS service
       FROM (SELECT DISTINCT pipeline_id, pipeline_id NOT LIKE '%2' AS t, pipeline_id NOT LIKE '%1' AS c FROM health)""", "health"))
def document_sections(spark, sf_dir):
    """Table and cost sections of the documents, one absent for one pipeline and the other for another."""
    entries = _all_entries(spark, sf_dir)
    metadata, costs = _document_inputs(entries)
    texts = document_json(status_documents(entries, DOCUMENT_NOW, None, metadata, costs))

    def at(path, kind="string"):
        return F.get_json_object("document", path).cast(kind)

    return texts.select(
        "pipeline_id", at("$.table.status").alias("table_status"), at("$.table.reason").alias("table_reason"),
        at("$.table.total_records", "bigint").alias("total_records"),
        at("$.table.current_snapshot_commit_utc").alias("committed"),
        at("$.costs.status").alias("cost_status"), at("$.costs.reason").alias("cost_reason"),
        at("$.costs.seven_day_net_cost", "double").alias("seven_day"),
        at("$.costs.today_net_cost", "double").alias("today"),
        at("$.costs.top_services[0].service_name").alias("service"),
    )


@query("status_f6_lenient_times", sql(
    f"""SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, {SECONDS}) WHEN 1 THEN strftime(ts - INTERVAL 330 MINUTE, {SECONDS})
          WHEN 2 THEN strftime(date_trunc('day', ts), {SECONDS}) END AS seen_utc FROM events"""))
def lenient_times(spark, sf_dir):
    """Strictly and loosely written times to UTC seconds, unreadable ones to null."""
    local = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(F.col("event_id") % 4 == 0, F.concat(local, F.lit("Z")))
        .when(F.col("event_id") % 4 == 1, F.concat(local, F.lit("+05:30")))
        .when(F.col("event_id") % 4 == 2, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise("not a time")
    )
    return inputs.events(spark, sf_dir).select(
        "event_id", seconds_text(lenient_instant(text)).alias("seen_utc")
    )
