"""Queries over costs, table history, maintenance plans and display texts."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickhouse.functions import display
from tickhouse.functions.codes import cost_read_failure, safe_operation
from tickhouse.functions.numbers import count_value, money, ratio
from tickhouse.functions.times import epoch_or_iso_text, millis_text, two_zone_text
from tickhouse.operators import costs, loader, tables, upkeep
from tickhouse.queries import inputs
from tickhouse.queries.health import PAIR_SQL
from tickhouse.queries.inputs import sql
from tickhouse.queries.registry import query

AS_OF = datetime(2001, 6, 20, 12, tzinfo=timezone.utc)
FIRST_DAY = "DATE '2001-06-01'"
WEEK_START = "DATE '2001-06-14'"
RECENT = f"""recent AS (SELECT *, CAST(usage_start_time AS DATE) AS usage_day, CAST(cost + credit AS DECIMAL(28,9)) AS net
  FROM billing WHERE usage_start_time >= {FIRST_DAY} AND usage_start_time < DATE '2001-06-21')"""


def _day():
    return F.to_date(F.lit(AS_OF))


def _double(name: str):
    return F.col(name).cast("double").alias(name)


def _recent(spark, sf_dir):
    return costs.lines_in_lookback(inputs.billing(spark, sf_dir), _day(), "project-a")


@query("costs_s10_lines", sql(
    "SELECT usage_day, service_name, CAST(cost AS DOUBLE) AS cost, CAST(net AS DOUBLE) AS net_cost FROM recent",
    "billing", more=RECENT))
def cost_lines(spark, sf_dir):
    """Billing lines in the look-back with their net cost."""
    return _recent(spark, sf_dir).select(
        "usage_day", "service_name", _double("cost"), _double("net_cost")
    )


@query("costs_a10_daily", sql(
    f"SELECT usage_day, currency, CAST(sum(net) AS DOUBLE) AS net_cost FROM recent WHERE usage_day >= {WEEK_START} GROUP BY 1, 2",
    "billing", more=RECENT))
def daily(spark, sf_dir):
    """Net cost of the last seven days (A10)."""
    return costs.daily_costs(_recent(spark, sf_dir), _day()).select("usage_day", "currency", _double("net_cost"))


@query("costs_a11_services", sql(
    f"SELECT service_name, currency, CAST(sum(net) AS DOUBLE) AS net_cost FROM recent WHERE usage_day >= {FIRST_DAY} GROUP BY 1, 2",
    "billing", more=RECENT))
def services(spark, sf_dir):
    """Month-to-date net cost per service."""
    return costs.monthly_services(_recent(spark, sf_dir), _day()).select(
        "service_name", "currency", _double("net_cost")
    )


SNAPSHOT_SQL = f"""
d AS (SELECT usage_day, sum(net) AS n FROM recent WHERE usage_day >= {WEEK_START} GROUP BY 1),
s AS (SELECT service_name, sum(net) AS n FROM recent GROUP BY 1),
t AS (SELECT *, row_number() OVER (ORDER BY n DESC, service_name) AS rn FROM s)"""


@query("costs_d7_snapshot", sql(
    """SELECT 'total' AS part, '' AS label, (SELECT CAST(coalesce(sum(n), 0) AS DOUBLE) FROM d) AS seven_day_net_cost,
         (SELECT CAST(coalesce(sum(n), 0) AS DOUBLE) FROM s) AS month_to_date_net_cost, (SELECT min(currency) FROM recent) AS currency,
         (SELECT max(usage_start_time) FROM recent) AS source_exported_at, CAST(NULL AS DOUBLE) AS net_cost
       UNION ALL SELECT 'day', strftime(usage_day, '%Y-%m-%d'), NULL, NULL, NULL, NULL, CAST(n AS DOUBLE) FROM d
       UNION ALL SELECT 'service', service_name, NULL, NULL, NULL, NULL, CAST(n AS DOUBLE) FROM t WHERE rn <= 3""",
    "billing", more=RECENT + "," + SNAPSHOT_SQL))
def cost_snapshot(spark, sf_dir):
    """The whole cost snapshot in one scan, flattened for comparison."""
    one = costs.cost_snapshot(inputs.billing(spark, sf_dir), F.lit(AS_OF), "project-a")
    nothing = F.lit(None)
    total = F.struct(
        F.lit("total").alias("part"), F.lit("").alias("label"),
        F.col("seven_day_net_cost").cast("double").alias("seven_day_net_cost"),
        F.col("month_to_date_net_cost").cast("double").alias("month_to_date_net_cost"),
        F.col("currency").alias("currency"),
        F.col("source_exported_at").cast("timestamp_ntz").alias("source_exported_at"),
        nothing.cast("double").alias("net_cost"),
    )

    def item(part, label, value):
        return F.struct(
            F.lit(part).alias("part"), label.alias("label"),
            nothing.cast("double").alias("seven_day_net_cost"),
            nothing.cast("double").alias("month_to_date_net_cost"),
            nothing.cast("string").alias("currency"),
            nothing.cast("timestamp_ntz").alias("source_exported_at"),
            value.cast("double").alias("net_cost"),
        )

    days = F.transform("daily_costs", lambda d: item("day", d["day_utc"], d["net_cost"]))
    best = F.transform("top_services", lambda s: item("service", s["service_name"], s["net_cost"]))
    return one.select(F.inline(F.concat(F.array(total), days, best)))


def _text_snapshots(spark, sf_dir):
    """One text snapshot per supplier group: daily costs and services with some bad entries."""
    rows = inputs.table(spark, sf_dir, "supplier").join(
        inputs.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    key = F.col("s_suppkey")
    days = F.transform(F.sequence(F.lit(1), (key % 12 + 1).cast("int")), lambda i: F.struct(
        F.when((key + i) % 9 == 0, F.lit("bad day")).otherwise(
            F.format_string("2001-06-%02d", F.lit(21) - i)).alias("day_utc"),
        F.when((key + i) % 7 == 0, F.lit("NaN")).otherwise(
            (key * i).cast("string")).alias("net_cost"),
    ))
    names = F.array(F.col("n_name"), F.lit("Cloud/Storage"), F.lit("bad;name"), F.lit("Fourth"))
    top = F.transform(names, lambda n, i: F.struct(
        n.alias("service_name"), (key * (i + 1)).cast("string").alias("net_cost")
    ))
    return rows.select(
        key.alias("pipeline_id"),
        F.when(key % 6 == 0, "20010620").when(key % 6 == 1, (key * 1_000_000).cast("string"))
        .when(key % 6 == 2, "2001-06-20 06:07:00").when(key % 6 == 3, "yesterday")
        .otherwise("2001-06-20T06:07:00Z").alias("aggregated_at_utc"),
        F.lit("2001-06-20 05:00:00").alias("source_exported_at_utc"),
        F.when(key % 10 == 0, "usd").otherwise("USD").alias("currency"),
        (key * 3).cast("string").alias("seven_day_net_cost"),
        F.when(key % 14 == 0, "x").otherwise((key * 5).cast("string")).alias("month_to_date_net_cost"),
        days.alias("daily_costs"),
        top.alias("top_services"),
    )


SECTION_CTES = """
x AS (SELECT s_suppkey AS key, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey),
d0 AS (SELECT key, unnest(range(1, CAST(key % 12 + 2 AS BIGINT))) AS i FROM x),
d1 AS (SELECT key, '2001-06-' || lpad(CAST(21 - i AS VARCHAR), 2, '0') AS day_utc, CAST(key * i AS DOUBLE) AS net_cost,
         row_number() OVER (PARTITION BY key ORDER BY 21 - i DESC) AS rn FROM d0 WHERE (key + i) % 9 <> 0 AND (key + i) % 7 <> 0),
ok AS (SELECT *, key % 6 <> 3 AND key % 10 <> 0 AND key % 14 <> 0 AS fine FROM x)"""


@query("costs_p16_daily_clean", sql(
    "SELECT key AS pipeline_id, day_utc, net_cost FROM d1 JOIN ok USING (key) WHERE rn <= 7 AND fine", more=SECTION_CTES))
def clean_daily(spark, sf_dir):
    """Readable daily costs of usable snapshots, last seven."""
    section = costs.cost_section(_text_snapshots(spark, sf_dir), F.lit(AS_OF))
    return section.select("pipeline_id", F.inline("daily_costs"))


@query("costs_p17_services", sql(
    """SELECT key AS pipeline_id, n_name AS service_name, CAST(key AS DOUBLE) AS net_cost FROM ok WHERE fine
       UNION ALL SELECT key, 'Cloud/Storage', CAST(key * 2 AS DOUBLE) FROM ok WHERE fine""", more=SECTION_CTES))
def clean_services(spark, sf_dir):
    """First three services, then only plainly named ones."""
    section = costs.cost_section(_text_snapshots(spark, sf_dir), F.lit(AS_OF))
    return section.select("pipeline_id", F.inline("top_services"))


@query("costs_d6_section", sql(
    """SELECT ok.key AS pipeline_id, CASE WHEN fine THEN 'available' ELSE 'unavailable' END AS status,
         CASE WHEN NOT fine THEN 'invalid_snapshot' END AS reason,
         CASE WHEN fine THEN CASE WHEN ok.key % 6 = 0 THEN '1970-08-20T14:30:20Z'
           WHEN ok.key % 6 = 1 THEN strftime(make_timestamp(ok.key * 1000000000000), '%Y-%m-%dT%H:%M:%SZ')
           ELSE '2001-06-20T06:07:00Z' END END AS aggregated_at_utc,
         CASE WHEN fine THEN d1.net_cost END AS today_net_cost, CASE WHEN fine THEN CAST(ok.key * 3 AS DOUBLE) END AS seven_day_net_cost
       FROM ok LEFT JOIN d1 ON d1.key = ok.key AND day_utc = '2001-06-20'""", more=SECTION_CTES))
def cost_section(spark, sf_dir):
    """Validated cost section with today's cost looked up."""
    return costs.cost_section(_text_snapshots(spark, sf_dir), F.lit(AS_OF)).select(
        "pipeline_id", "status", "reason", "aggregated_at_utc", "today_net_cost", "seven_day_net_cost"
    )


@query("costs_s12_row_payload", sql(
    """SELECT s_suppkey, CASE WHEN s_suppkey % 5 <> 0 AND s_suppkey % 7 <> 0 THEN 'USD' END AS currency,
         CASE WHEN s_suppkey % 5 <> 0 AND s_suppkey % 7 <> 0 THEN CAST(s_suppkey AS VARCHAR) END AS seven_day_net_cost,
         CASE WHEN s_suppkey % 5 <> 0 AND s_suppkey % 7 <> 0 THEN '2001-06-20' END AS first_day,
         CASE WHEN s_suppkey % 5 <> 0 AND s_suppkey % 7 <> 0 THEN s_name END AS first_service FROM supplier"""))
def row_payloads(spark, sf_dir):
    """Row-encoded snapshots decoded; wrongly shaped ones give nothing."""
    key = F.col("s_suppkey")

    def cells(*values):
        return F.concat(F.lit('{"f":['), F.concat_ws(",", *[
            F.concat(F.lit('{"v":'), value, F.lit("}")) for value in values]), F.lit("]}"))

    def text(value):
        return F.concat(F.lit('"'), value, F.lit('"'))

    def nested(*values):
        return F.concat(F.lit('[{"v":'), cells(*values), F.lit("}]"))

    day = F.when(key % 5 == 0, nested(text(F.lit("2001-06-20")))).otherwise(
        nested(text(F.lit("2001-06-20")), text(F.lit("1.5"))))
    row = cells(text(F.lit("2001-06-20 06:00:00")), text(F.lit("2001-06-20 05:00:00")), text(F.lit("USD")),
                text(key.cast("string")), text(F.lit("9")), day, nested(text(F.col("s_name")), text(F.lit("2"))))
    rows = F.when(key % 7 == 0, F.concat_ws(",", row, row)).otherwise(row)
    payload = F.concat(F.lit('{"rows":['), rows, F.lit("]}"))
    found = inputs.table(spark, sf_dir, "supplier").select(
        "s_suppkey", costs.decode_row_payload(payload).alias("s"))
    return found.select(
        "s_suppkey", "s.currency", "s.seven_day_net_cost",
        F.get("s.daily_costs", F.lit(0))["day_utc"].alias("first_day"),
        F.get("s.top_services", F.lit(0))["service_name"].alias("first_service"),
    )


@query("costs_f8_scalars", sql(
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(to_timestamp(k * 1000003)::TIMESTAMP, '%Y-%m-%dT%H:%M:%SZ')
           WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS seen_utc,
         CASE WHEN event_id % 5 <> 0 THEN round(value, 2) END AS amount,
         CASE event_id % 3 WHEN 0 THEN 'permission_denied' WHEN 1 THEN 'not_found' ELSE 'command_failed' END AS failure,
         least(CAST(ts AS DATE) - 6, CAST(date_trunc('month', ts) AS DATE)) AS lookback_start
       FROM ev""", "ev"))
def cost_scalars(spark, sf_dir):
    """Times, amounts, failure codes and the look-back bound."""
    kind = F.col("event_id") % 3
    text = F.when(kind == 0, (F.col("k") * 1_000_003).cast("string")).when(
        kind == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")
    ).otherwise("soon")
    detail = F.when(kind == 0, "Access Denied: x").when(kind == 1, "table Not found").otherwise("boom")
    amount = F.when(F.col("event_id") % 5 == 0, "inf").otherwise(F.col("value").cast("string"))
    return inputs.events(spark, sf_dir).select(
        "event_id", epoch_or_iso_text(text).alias("seen_utc"), money(amount).alias("amount"),
        cost_read_failure(detail).alias("failure"),
        costs.lookback_start(F.to_date("ts")).alias("lookback_start"),
    )


# ---- tables ---------------------------------------------------------------------------------


@query("tables_a15_latest", sql(
    """SELECT table_id, max(committed_at) AS committed_at, arg_max(added_records, committed_at) AS latest_added_records,
         CAST(sum(added_records) AS BIGINT) AS total_records, CAST(sum(added_bytes) AS BIGINT) AS total_bytes, count(*) AS snapshot_count
       FROM commits GROUP BY 1""", "commits"))
def latest_snapshots(spark, sf_dir):
    """Newest snapshot and totals of each table."""
    return tables.latest_snapshot(inputs.commits(spark, sf_dir))


@query("tables_o2_newest_first", sql(
    """SELECT * FROM (SELECT table_id, committed_at, row_number() OVER (PARTITION BY table_id ORDER BY committed_at DESC) AS newest_rank
       FROM commits) WHERE newest_rank <= 5""", "commits"))
def newest_snapshots(spark, sf_dir):
    """Five newest snapshots per table (O2)."""
    return tables.newest_snapshots(inputs.commits(spark, sf_dir), 5).select(
        "table_id", "committed_at", F.col("newest_rank").cast("long").alias("newest_rank")
    )


@query("tables_a16_records", sql(
    """SELECT t.table_id, CAST(coalesce(sum(added_records), 0) AS BIGINT) AS record_count
       FROM (SELECT DISTINCT 't' || CAST(c_custkey % 9 AS VARCHAR) AS table_id FROM customer) t LEFT JOIN commits USING (table_id) GROUP BY 1""",
    "commits"))
def record_counts(spark, sf_dir):
    """Records of every table, zero without a snapshot."""
    known = inputs.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("t"), (F.col("c_custkey") % 9).cast("string")).alias("table_id")
    ).distinct()
    return tables.record_counts(known, inputs.commits(spark, sf_dir))


@query("tables_w10_running_totals", sql(
    """SELECT table_id, committed_at, CAST(sum(added_records) OVER w AS BIGINT) AS total_records, CAST(sum(added_bytes) OVER w AS BIGINT) AS total_bytes
       FROM commits WINDOW w AS (PARTITION BY table_id ORDER BY committed_at)""", "commits"))
def running_totals(spark, sf_dir):
    """Snapshot totals after each commit."""
    return tables.running_totals(inputs.commits(spark, sf_dir)).select(
        "table_id", "committed_at", "total_records", "total_bytes"
    )


@query("tables_f18_metadata_values", sql(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN NULL ELSE o_orderkey END AS count_value,
         CASE WHEN o_orderkey % 4 = 2 THEN strftime(make_timestamp(o_orderkey * 86400000000), '%Y-%m-%dT%H:%M:%SZ') END AS updated_utc,
         CASE o_orderstatus WHEN 'F' THEN 'append' WHEN 'O' THEN 'replace' ELSE 'other' END AS operation,
         CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE round(o_orderkey / (o_custkey % 3), 2) END AS average
       FROM orders"""))
def metadata_values(spark, sf_dir):
    """Defensive counts, times, operations and ratios of table metadata."""
    key = F.col("o_orderkey")
    text = F.when(key % 4 == 0, F.concat(F.lit("-"), key.cast("string"))).when(
        key % 4 == 1, F.concat(key.cast("string"), F.lit(".5"))
    ).otherwise(key.cast("string"))
    status = F.col("o_orderstatus")
    return inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", count_value(text).alias("count_value"),
        millis_text(F.when(key % 4 == 2, (key * 86_400_000).cast("string")).otherwise("x")).alias("updated_utc"),
        safe_operation(F.when(status == "F", "APPEND").when(status == "O", "Replace").otherwise(status)).alias("operation"),
        ratio(key, F.col("o_custkey") % 3).alias("average"),
    )


@query("tables_p14_section", sql(
    """SELECT o_orderkey AS table_id, CASE WHEN r IS NULL THEN 'available' ELSE 'unavailable' END AS status, r AS reason,
         CASE WHEN r IS NULL THEN o_custkey * 100 END AS total_records, CASE WHEN r IS NULL THEN o_custkey END AS total_data_files,
         CASE WHEN r IS NULL AND o_custkey > 0 THEN 100.0::DOUBLE END AS average_rows_per_data_file,
         CASE WHEN r IS NULL THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS current_snapshot_commit_utc,
         CASE WHEN r IS NULL THEN CASE WHEN o_orderstatus = 'F' THEN 'append' ELSE 'other' END END AS latest_operation,
         CASE WHEN r IS NULL THEN CAST(2 AS BIGINT) END AS snapshot_history_count, CASE WHEN r IS NULL THEN CAST(1 AS BIGINT) END AS metadata_history_count
       FROM (SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN 'not_configured' WHEN o_orderkey % 11 = 1 THEN 'read_failed' WHEN o_orderkey % 11 = 2 THEN 'invalid_metadata'
               WHEN o_orderkey % 11 = 3 THEN 'missing_current_snapshot' WHEN o_orderkey % 11 = 4 THEN 'missing_snapshot_summary' END AS r FROM orders)"""))
def table_sections(spark, sf_dir):
    """Table sections from one metadata document per order, some unusable."""
    key, kind = F.col("o_orderkey"), F.col("o_orderkey") % 11
    committed = F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string")
    summary = F.when(kind == 4, F.lit("null")).otherwise(F.format_string(
        '{"operation":"%s","total-records":"%d","total-data-files":"%d"}',
        F.when(F.col("o_orderstatus") == "F", "Append").otherwise("vacuum"),
        F.col("o_custkey") * 100, F.col("o_custkey")))
    current = F.when(kind == 3, key + 5).otherwise(key).cast("string")
    snapshots = F.concat(
        F.lit('[{"snapshot-id":-1,"timestamp-ms":1},{"snapshot-id":'), key.cast("string"),
        F.lit(',"timestamp-ms":'), committed, F.lit(',"summary":'), summary, F.lit("}]"))
    document = F.concat(F.lit('{"current-snapshot-id":'), current, F.lit(',"snapshots":'), snapshots,
                        F.lit(',"metadata-log":[{"metadata-file":"a"}]}'))
    metadata = F.when(kind == 0, F.lit(None)).when(kind == 1, "[]").when(kind == 2, "{}").otherwise(document)
    rows = inputs.table(spark, sf_dir, "orders").select(key.alias("table_id"), metadata.alias("metadata"))
    return tables.table_section(rows).select(
        "table_id", "status", "reason", "total_records", "total_data_files", "average_rows_per_data_file",
        "current_snapshot_commit_utc", "latest_operation", "snapshot_history_count", "metadata_history_count",
    )


TARGET = 100_000


@query("tables_m7_file_report", sql(
    f"""SELECT table_id, count(*) AS data_files, CAST(sum(file_size) AS BIGINT) AS total_bytes, CAST(sum(record_count) AS BIGINT) AS total_records,
          CAST(count_if(file_size < {TARGET}) AS BIGINT) AS small_files, round(sum(record_count) / count(*), 2) AS average_rows_per_data_file,
          round(sum(file_size) / count(*), 2) AS average_data_file_size_bytes FROM files GROUP BY 1""", "files"))
def file_report(spark, sf_dir):
    """Small-file report per table."""
    return tables.file_report(inputs.files(spark, sf_dir), TARGET)


@query("tables_m7_bin_plan", sql(
    f"""SELECT table_id, bin_id, count(*) AS files, CAST(sum(file_size) AS BIGINT) AS bytes FROM (
          SELECT *, CAST((sum(file_size) OVER (PARTITION BY table_id ORDER BY file_path) - file_size) // {TARGET} AS BIGINT) AS bin_id FROM files)
        GROUP BY 1, 2""", "files"))
def bin_plan(spark, sf_dir):
    """Rewrite bins by cumulative size (M7)."""
    return tables.bins(tables.bin_plan(inputs.files(spark, sf_dir), TARGET))


# ---- maintenance ----------------------------------------------------------------------------


@query("upkeep_w11_quiet", sql(
    """WITH q AS (SELECT 't' || CAST(o_custkey AS VARCHAR) AS table_id, o_orderdate::TIMESTAMP AS seen_at, max(o_orderstatus) AS s FROM orders GROUP BY 1, 2),
       w AS (SELECT TIMESTAMP '1998-08-03' - INTERVAL 730 DAY AS low, TIMESTAMP '1998-08-03' AS high, INTERVAL 400 DAY AS gap),
       k AS (SELECT *, lag(seen_at) OVER (PARTITION BY table_id ORDER BY seen_at) AS prev_at, lag(s) OVER (PARTITION BY table_id ORDER BY seen_at) AS was,
               lead(seen_at) OVER (PARTITION BY table_id ORDER BY seen_at) AS next_at FROM q, w WHERE seen_at <= high AND seen_at >= low - gap),
       g AS (SELECT table_id, count(*) AS samples, min(seen_at) AS first_at, max(seen_at) AS last_at, max(seen_at - prev_at) AS widest,
               min(CASE WHEN was <> s AND seen_at >= low THEN seen_at END) AS changed_at
             FROM k WHERE seen_at >= low OR coalesce(next_at, high) > low GROUP BY 1),
       n AS (SELECT table_id, arg_max(s, seen_at) AS snapshot_id FROM q, w WHERE seen_at <= high GROUP BY 1),
       r AS (SELECT table_id, low AS window_start, snapshot_id, coalesce(samples, 0) AS samples, changed_at,
               CASE WHEN changed_at IS NOT NULL THEN 'changed'
                    WHEN first_at <= low AND high - last_at <= gap AND coalesce(widest, INTERVAL 0 DAY) <= gap THEN 'quiet' ELSE 'not_covered' END AS reason
             FROM n CROSS JOIN w LEFT JOIN g USING (table_id))
       SELECT *, reason = 'quiet' AS is_quiet FROM r"""))
def quiet(spark, sf_dir):
    """Tables unchanged through the last two years, seen every 400 days; the order status plays the snapshot."""
    samples = inputs.table(spark, sf_dir, "orders").groupBy(
        F.concat(F.lit("t"), F.col("o_custkey").cast("string")).alias("table_id"),
        F.col("o_orderdate").cast("timestamp").alias("sampled_at"),
    ).agg(F.max("o_orderstatus").alias("snapshot_id")).withColumn("metadata_version", F.col("snapshot_id"))
    end = datetime(1998, 8, 3, tzinfo=timezone.utc)
    return upkeep.quiet_tables(samples, end, 730 * 86400, 400 * 86400).select(
        "table_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "snapshot_id",
        "samples", F.col("changed_at").cast("timestamp_ntz").alias("changed_at"), "reason", "is_quiet",
    )


@query("upkeep_j6_fence", sql(
    """SELECT table_id, expected_id, observed_id, coalesce(expected_id = observed_id, FALSE) AS may_rewrite FROM (
         SELECT 't' || CAST(o_custkey AS VARCHAR) AS table_id, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS expected_id,
           arg_max(o_orderkey, (o_orderdate, o_orderkey)) FILTER (WHERE o_orderstatus <> 'F') AS observed_id FROM orders GROUP BY 1)"""))
def fenced(spark, sf_dir):
    """Expected against observed snapshot of each table."""
    orders = inputs.table(spark, sf_dir, "orders").withColumn(
        "table_id", F.concat(F.lit("t"), F.col("o_custkey").cast("string")))

    def newest(rows):
        return rows.groupBy("table_id").agg(
            F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("snapshot_id"))

    return upkeep.fence(newest(orders), newest(orders.filter(F.col("o_orderstatus") != "F")))


NOW = datetime(2001, 8, 1, tzinfo=timezone.utc)


@query("upkeep_m8_expiry", sql(
    """SELECT table_id, committed_at FROM (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY committed_at DESC) AS rn FROM commits)
       WHERE rn > 100 AND committed_at < TIMESTAMP '2001-07-25'""", "commits"))
def expiry(spark, sf_dir):
    """Snapshots a cleanup may expire: old and beyond the newest hundred (M8, dry run)."""
    snapshots = inputs.commits(spark, sf_dir).withColumn("snapshot_id", F.unix_micros(F.col("committed_at").cast("timestamp")))
    typed = snapshots.withColumn("committed_at", F.col("committed_at").cast("timestamp"))
    return upkeep.expiry_plan(typed, NOW).select(
        "table_id", F.col("committed_at").cast("timestamp_ntz").alias("committed_at")
    )


@query("upkeep_m9_orphans", sql(
    """SELECT CAST(o_orderkey AS VARCHAR) AS file_path FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-29'
       AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber > 2)"""))
def orphans(spark, sf_dir):
    """Old files nothing refers to (M9, dry run): orders listed, long orders referenced."""
    listing = inputs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("file_path"),
        F.col("o_orderdate").cast("timestamp").alias("modified_at"),
    )
    referenced = inputs.table(spark, sf_dir, "lineitem").filter(F.col("l_linenumber") > 2).select(
        F.col("l_orderkey").cast("string").alias("file_path"))
    return upkeep.orphan_plan(listing, referenced, NOW).select("file_path")


@query("upkeep_f21_name_faults", sql(
    """SELECT p_partkey, concat_ws(',', CASE WHEN p_partkey % 3 = 0 THEN 'identifier' END, CASE WHEN p_partkey % 5 = 0 THEN 'project' END,
         CASE WHEN p_partkey % 7 = 0 THEN 'directory' END, CASE WHEN p_partkey % 2 = 0 THEN 'receipt' END) AS faults FROM part"""))
def name_faults(spark, sf_dir):
    """Malformed table names, projects and locations."""
    key = F.col("p_partkey")
    text = key.cast("string")
    faults = upkeep.name_faults(
        F.when(key % 3 == 0, F.concat(text, F.lit("_t"))).otherwise(F.concat(F.lit("t_"), text)),
        F.when(key % 5 == 0, F.lit("Bad-project")).otherwise(F.concat(F.lit("project-"), text, F.lit("a"))),
        F.when(key % 7 == 0, F.lit("gs://bucket/dir")).otherwise(F.concat(F.lit("gs://bucket/"), text, F.lit("/"))),
        F.when(key % 2 == 0, F.lit("gs://bucket/receipt.txt")).otherwise(F.concat(F.lit("gs://bucket/"), text, F.lit(".json"))),
    )
    return inputs.table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(",", faults).alias("faults"))


# ---- display --------------------------------------------------------------------------------


@query("display_f22_bytes", sql(
    """WITH z AS (SELECT doc_id, n_chars * (CASE doc_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 100 WHEN 2 THEN 100000 WHEN 3 THEN 100000000 ELSE 200000000000 END) AS b FROM documents),
       y AS (SELECT *, least(4, CASE WHEN b < 1024 THEN 0 WHEN b < 1048576 THEN 1 WHEN b < 1073741824 THEN 2 WHEN b < 1099511627776 THEN 3 ELSE 4 END) AS u FROM z),
       x AS (SELECT *, b / pow(1024, u) AS s FROM y)
       SELECT doc_id, CASE WHEN u = 0 OR s >= 10 THEN CAST(CAST(floor(s + 0.5) AS BIGINT) AS VARCHAR) ELSE printf('%.1f', floor(s * 10 + 0.5) / 10) END
         || ' ' || ['B', 'KiB', 'MiB', 'GiB', 'TiB'][u + 1] AS shown FROM x"""))
def byte_texts(spark, sf_dir):
    """Binary-unit sizes."""
    number = F.col("doc_id") % 5
    scale = F.when(number == 0, F.lit(1)).when(number == 1, F.lit(100)).when(
        number == 2, F.lit(100_000)).when(number == 3, F.lit(100_000_000)).otherwise(F.lit(200_000_000_000))
    return inputs.table(spark, sf_dir, "documents").select(
        "doc_id", display.bytes_text(F.col("n_chars") * scale).alias("shown")
    )


@query("display_f23_texts", sql(
    """SELECT event_id, CASE WHEN d < 1000 THEN CAST(d AS VARCHAR) || ' ms' ELSE printf('%.1f', floor(d / 100.0 + 0.5) / 10) || ' s' END AS duration,
         upper(left(event_type, 1)) || substr(event_type, 2) || ' Failed' AS title,
         strftime(ts, '%-d %b %Y, %H:%M UTC') || ' · ' || strftime(ts + INTERVAL 330 MINUTE, '%-d %b %Y, %H:%M IST') AS seen
       FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS d FROM events)"""))
def display_texts(spark, sf_dir):
    """Durations, titles and two-zone times."""
    return inputs.events(spark, sf_dir).select(
        "event_id", display.duration_text(F.round(F.col("value") * 100).cast("long")).alias("duration"),
        display.title_text(F.concat("event_type", F.lit("_failed"))).alias("title"),
        two_zone_text(F.col("ts")).alias("seen"),
    )


@query("display_f24_money", sql(
    """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN printf('%.2f', c_acctbal) || ' us'
         ELSE CASE WHEN c_acctbal < 0 THEN '-' ELSE '' END || CASE WHEN c_custkey % 4 = 1 THEN '$' WHEN c_custkey % 4 = 2 THEN '€' ELSE 'CHF' || chr(160) END
           || format('{:,}', CAST(floor(abs(c_acctbal)) AS BIGINT)) || substr(printf('%.2f', abs(c_acctbal) - floor(abs(c_acctbal))), 2) END AS shown FROM customer"""))
def money_texts(spark, sf_dir):
    """Amounts with their currency."""
    number = F.col("c_custkey") % 4
    currency = F.when(number == 0, "us").when(number == 1, "USD").when(number == 2, "EUR").otherwise("CHF")
    return inputs.table(spark, sf_dir, "customer").select(
        "c_custkey", display.money_text(F.col("c_acctbal"), currency).alias("shown")
    )


@query("display_w12_heights", sql(
    f"""SELECT pipeline_id, seq, greatest(8, coalesce(duration_ms, 0) / greatest(max(coalesce(duration_ms, 0)) OVER (PARTITION BY pipeline_id), 1) * 100)::DOUBLE AS height
        FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_id ORDER BY seen DESC, seq DESC) AS rn FROM ({PAIR_SQL})) WHERE rn <= 48
        QUALIFY rn <= 24""", "health"))
def heights(spark, sf_dir):
    """Chart heights of the last 24 commits against the longest of the last 48."""
    recent = loader.recent(loader.pair_commits(inputs.health_rows(spark, sf_dir)), 48)
    largest = F.max("duration_ms").over(Window.partitionBy("pipeline_id"))
    return recent.withColumn("largest", largest).filter(F.col("newest_rank") <= 24).select(
        "pipeline_id", "seq", display.bar_height(F.col("duration_ms"), F.col("largest"), 1.0).alias("height")
    )


@query("display_w12_cost_heights", sql(
    """WITH r AS (SELECT l_returnflag AS account, CAST(l_shipdate AS DATE) AS day_utc,
         CAST(sum(CAST(l_extendedprice * (CASE WHEN l_linestatus = 'O' THEN -1 ELSE 1 END) AS DECIMAL(18,2))) AS DOUBLE) AS net_cost FROM lineitem GROUP BY 1, 2),
       n AS (SELECT *, row_number() OVER (PARTITION BY account ORDER BY day_utc DESC) AS rn FROM r)
       SELECT account, strftime(day_utc, '%Y-%m-%d') AS day_utc,
         greatest(8, abs(net_cost) / greatest(max(abs(net_cost)) OVER (PARTITION BY account), 0.01) * 100)::DOUBLE AS height
       FROM n WHERE rn <= 7"""))
def cost_heights(spark, sf_dir):
    """Chart heights of the last seven days' costs by absolute value; credits can exceed costs."""
    lines = inputs.table(spark, sf_dir, "lineitem")
    sign = F.when(F.col("l_linestatus") == "O", -1).otherwise(1)
    daily = lines.groupBy(F.col("l_returnflag").alias("account"), F.to_date("l_shipdate").alias("day_utc")).agg(
        F.sum((F.col("l_extendedprice") * sign).cast("decimal(18,2)")).alias("net_cost"))
    newest = Window.partitionBy("account").orderBy(F.col("day_utc").desc())
    week = daily.withColumn("rn", F.row_number().over(newest)).where("rn <= 7")
    largest = F.max(F.abs("net_cost")).over(Window.partitionBy("account"))
    return week.select("account", F.col("day_utc").cast("string").alias("day_utc"),
                       display.cost_bar_height(F.col("net_cost"), largest).alias("height"))
