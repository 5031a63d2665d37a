from __future__ import annotations

import json
from datetime import datetime, timezone

import duckdb
import pytest
from pyspark.sql import functions as F

from tickhouse.functions import codes, display, market, numbers, times
from tickhouse.operators import costs, journal
from tickhouse.queries import catalogue
from tickhouse.sources.logs import journal_lines, read_journal
from tickhouse.sources.sinks import snapshot_text, write_snapshot


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


@pytest.mark.parametrize("value, text", [
    (None, "—"), (0, "0 B"), (999, "999 B"), (1023, "1023 B"), (1024, "1.0 KiB"), (1280, "1.3 KiB"),
    (10240, "10 KiB"), (899223658, "858 MiB"), (5 * 1024**3, "5.0 GiB"), (3 * 1024**5, "3072 TiB"),
])
def test_bytes(spark, value, text):
    assert one(spark, display.bytes_text(F.lit(value).cast("long"))) == text


@pytest.mark.parametrize("value, text", [(None, "—"), (999, "999 ms"), (1000, "1.0 s"), (17000, "17.0 s")])
def test_duration(spark, value, text):
    assert one(spark, display.duration_text(F.lit(value).cast("long"))) == text


@pytest.mark.parametrize("value, currency, text", [
    (1234.5, "USD", "$1,234.50"), (-2.57, "USD", "-$2.57"), (3.0, "INR", "₹3.00"),
    (8.0, "CHF", "CHF 8.00"), (8.0, "us", "8.00 us"), (None, "USD", "—"), (1.0, None, "—"),
])
def test_money_text(spark, value, currency, text):
    assert one(spark, display.money_text(F.lit(value).cast("double"), F.lit(currency).cast("string"))) == text


def test_small_texts(spark):
    assert one(spark, display.title_text(F.lit("stale_loader_heartbeat"))) == "Stale Loader Heartbeat"
    seen = times.two_zone_text(F.lit(utc(2026, 8, 27, 21, 20)))
    assert one(spark, seen) == "27 Aug 2026, 21:20 UTC · 28 Aug 2026, 02:50 IST"
    assert one(spark, display.bar_height(F.lit(1), F.lit(1000), 1.0)) == 8.0
    assert one(spark, display.bar_height(F.lit(500), F.lit(1000), 1.0)) == 50.0
    assert one(spark, display.bar_height(F.lit(None), F.lit(None), 1.0)) == 8.0
    assert one(spark, codes.redacted(F.lit("abc"))) == "<redacted>"
    assert one(spark, codes.redacted(F.lit("ZQ9X-77"))) == "ZQ9X…<redacted>"


@pytest.mark.parametrize("at, state, opening", [
    (utc(2026, 8, 27, 13, 29), "pre_open", "2026-08-27T13:30:00Z"),
    (utc(2026, 8, 27, 13, 30), "market_open", "2026-08-28T13:30:00Z"),
    (utc(2026, 8, 27, 20, 0), "settling", "2026-08-28T13:30:00Z"),
    (utc(2026, 8, 28, 21, 0), "closed", "2026-08-31T13:30:00Z"),
    (utc(2026, 8, 29, 12, 0), "weekend", "2026-08-31T13:30:00Z"),
    (utc(2026, 10, 30, 21, 0), "closed", "2026-11-02T14:30:00Z"),
    (utc(2026, 3, 6, 23, 0), "closed", "2026-03-09T13:30:00Z"),
])
def test_market(spark, at, state, opening):
    assert one(spark, market.market_state(F.lit(at))) == state
    assert one(spark, times.seconds_text(market.next_open(F.lit(at)))) == opening


@pytest.mark.parametrize("text, seen", [
    ("1788210047", "2026-08-31T21:00:47Z"), ("-1.5", "1969-12-31T23:59:58Z"),
    ("2026-09-03 06:07:00", "2026-09-03T06:07:00Z"), ("2026-09-03T06:07:00+05:30", "2026-09-03T00:37:00Z"),
    ("soon", None), ("2026-13-03", None), ("99999999999999999999999999", None),
])
def test_epoch_or_iso(spark, text, seen):
    assert one(spark, times.epoch_or_iso_text(F.lit(text))) == seen


@pytest.mark.parametrize("text, amount", [
    ("0.30", 0.3), (" 1.005 ", 1.0), ("-2", -2.0), ("1e2", 100.0), ("nan", None), ("inf", None), ("true", None),
])
def test_money(spark, text, amount):
    assert one(spark, numbers.money(F.lit(text))) == amount


def test_counts_and_codes(spark):
    assert one(spark, numbers.count_value(F.lit("42"))) == 42
    assert one(spark, numbers.count_value(F.lit("-1"))) is None
    assert one(spark, numbers.ratio(F.lit(10), F.lit(0))) is None
    assert one(spark, codes.failure_code(F.lit("loader_failed"))) == "loader_failed"
    assert one(spark, codes.normal_event(F.lit("commit_failed"), F.lit("offset_commit_failed"))) == "offset_commit_failed"
    assert one(spark, codes.normal_event(F.lit("commit_failed"), F.lit("x"), strict=True)) == "commit_failed"
    assert one(spark, codes.cost_read_failure(F.lit("Access Denied"))) == "permission_denied"


def test_journal_routes_do_not_overlap(spark, tmp_path):
    health = {"timestamp": "2026-08-27T21:15:02Z", "level": "ERROR", "target": "iceberg_loader::health",
              "fields": {"event": "stalled", "state": "stalled"}}
    rows = [
        ("bar-loader.service", "java", "LOADER_HEALTH " + json.dumps(health), "loader_health"),
        ("bar-loader.service", "java", "LOADER_HEALTH truncated", "loader_health"),
        ("bar-loader.service", "java", "x ClientTelemetryReporter - Client telemetry registered y", None),
        ("bar-loader.service", "java", "committed_at=now", "plain"),
        ("bar-extractor.service", "app", json.dumps({"level": "INFO", "fields": {"message": "metrics"}}), "extractor_json"),
        ("bar-replayer.service", "app", "not json", "extractor_json"),
        ("bar-extractor.timer", "systemd", "x", "plain"),
        ("init.scope", "systemd", "Started bar-extractor.service", "plain"),
        ("init.scope", "systemd", "Started cron.service", None),
        ("ssh.service", "sshd", "bar-loader", None),
    ]
    path = tmp_path / "journal.json"
    path.write_text("\n".join(json.dumps(
        {"_SYSTEMD_UNIT": u, "SYSLOG_IDENTIFIER": i, "MESSAGE": m}) for u, i, m, _ in rows))
    lines = journal_lines(read_journal(spark, str(path)), F.lit("p"), F.lit(utc(2026, 8, 27)))
    routed = journal.route_journal(lines)
    found = {r["message"]: r["route"] for r in routed.collect()}
    assert found == {m: route for _, _, m, route in rows if route}
    parsed = {r["message"]: r for r in journal.parse_routed(routed).collect()}
    event = parsed[rows[0][2]]
    assert (event["severity"], event["fields"]["event"]) == ("ERROR", "stalled")
    assert event["at"] == datetime(2026, 8, 27, 21, 15, 2)
    assert parsed[rows[1][2]]["fields"] is None
    assert parsed[rows[4][2]]["fields"]["message"] == "metrics" and parsed[rows[4][2]]["severity"] is None


def billing(spark):
    def line(day, service, cost, credit, project="p", currency="USD"):
        return (utc(*day), (service,), (project,), currency, float(cost), [(credit,)] if credit else None, utc(*day))

    rows = [line((2026, 9, 3, 1), "A", 1, None), line((2026, 9, 2), "A", 2, -0.5), line((2026, 9, 1), "B", 3, None),
            line((2026, 8, 28), "C", 4, None), line((2026, 8, 27), "C", 100, None), line((2026, 9, 3), "A", 50, None, "q"),
            line((2026, 9, 4), "A", 70, None), line((2026, 9, 2), "D", 1, None), line((2026, 9, 2), "E", 1, None)]
    schema = ("usage_start_time timestamp, service struct<description:string>, project struct<id:string>, currency string,"
              "cost double, credits array<struct<amount:double>>, export_time timestamp")
    return costs.flat_lines(spark.createDataFrame(rows, schema))


def test_cost_snapshot_to_section(spark, tmp_path):
    as_of = F.lit(utc(2026, 9, 3, 12))
    snapshot = costs.cost_snapshot(billing(spark), as_of, "p")
    row = snapshot.first()
    assert [(d["day_utc"], float(d["net_cost"])) for d in row["daily_costs"]] == [
        ("2026-08-28", 4.0), ("2026-09-01", 3.0), ("2026-09-02", 3.5), ("2026-09-03", 1.0)]
    assert [(s["service_name"], float(s["net_cost"])) for s in row["top_services"]] == [("B", 3.0), ("A", 2.5), ("D", 1.0)]
    assert (float(row["seven_day_net_cost"]), float(row["month_to_date_net_cost"]), row["currency_count"]) == (11.5, 7.5, 1)
    write_snapshot(snapshot, str(tmp_path / "s"))
    write_snapshot(snapshot, str(tmp_path / "s"))
    section = costs.cost_section(snapshot_text(spark.read.parquet(str(tmp_path / "s"))), as_of).first()
    assert (section["status"], section["today_net_cost"], section["seven_day_net_cost"]) == ("available", 1.0, 11.5)
    assert section["aggregated_at_utc"] == "2026-09-03T12:00:00Z"


def test_cost_snapshot_of_nothing(spark):
    row = costs.cost_snapshot(billing(spark), F.lit(utc(2027, 1, 1)), "p").first()
    assert float(row["seven_day_net_cost"]) == 0.0 and row["daily_costs"] == [] and row["top_services"] == []
    assert row["currency"] is None


def test_whole_cost_snapshot_reads_the_lines_once(spark):
    plan_of = costs.cost_snapshot(billing(spark), F.lit(utc(2026, 9, 3)), "p")
    plan_of.collect()
    plan = plan_of._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("text, number", [("5", 5), ("5.5", None), ('"5"', None), ("true", None), ("null", None)])
def test_counters_are_whole_numbers(spark, text, number):
    from tickhouse.schemas import COUNTERS

    snapshot = f'{{"messages_received":{text},"messages_sent":7}}'
    row = spark.range(1).select(F.from_json(F.lit(snapshot), COUNTERS).alias("c")).first()["c"]
    assert (row["messages_received"], row["messages_sent"]) == (number, 7)


@pytest.mark.parametrize("nulls", ["", "orders", "lineitem"])
@pytest.mark.parametrize("name", ["upkeep_m8_expiry", "upkeep_m9_orphans"])
def test_cleanup_plans_against_their_sql(spark, tmp_path, name, nulls):
    """The smallest tables, and again with keys that are null."""
    source, db = "/root/testdata/sf0.001", duckdb.connect()
    for table, keys in (("orders", ["o_orderkey", "o_custkey"]), ("lineitem", ["l_orderkey"])):
        lost = ", ".join(f"CASE WHEN i % 7 = {k} THEN NULL ELSE {key} END AS {key}" for k, key in enumerate(keys))
        rows = f"(SELECT *, row_number() OVER () AS i FROM '{source}/{table}.parquet')"
        star = f"* EXCLUDE (i) REPLACE ({lost})" if nulls == table else "* EXCLUDE (i)"
        db.execute(f"COPY (SELECT {star} FROM {rows}) TO '{tmp_path}/{table}.parquet' (FORMAT parquet)")
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet'")
    want = db.execute(catalogue.ORACLES[name]).fetchall()
    got = [tuple(r) for r in catalogue.QUERIES[name](spark, str(tmp_path)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert want or nulls == "lineitem"
