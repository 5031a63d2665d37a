from __future__ import annotations

import json
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tickhouse.operators import tables, upkeep
from tickhouse.plans import compaction
from tickhouse.session import dotted_name, exactly_one, table_parts
from tickhouse.sources import catalog
from tickhouse.sources.metadata import read_current_metadata
from tickhouse.sources.sinks import read_receipt, write_receipt

NOW = datetime(2026, 9, 1, tzinfo=timezone.utc)
SNAPSHOT = 77
METADATA = {
    "format-version": 2, "table-uuid": "hidden", "location": "gs://hidden/table",
    "last-updated-ms": 1_000_000_000_000, "current-snapshot-id": SNAPSHOT,
    "snapshots": [
        {"snapshot-id": 76, "timestamp-ms": 1, "summary": {"operation": "append"}},
        {"snapshot-id": SNAPSHOT, "timestamp-ms": 999_999_900_000, "manifest-list": "gs://hidden/m",
         "summary": {"operation": "append", "added-data-files": "3", "added-records": "450",
                     "added-files-size": "9000", "total-records": "12000", "total-files-size": "250000",
                     "total-data-files": "80", "total-delete-files": "4", "total-position-deletes": "6",
                     "total-equality-deletes": "5"}}],
    "metadata-log": [{"metadata-file": n} for n in "abc"],
}


def section(spark, text):
    frame = spark.createDataFrame([(text,)], "metadata string")
    return tables.table_section(frame).first().asDict()


def test_table_section(spark):
    assert section(spark, json.dumps(METADATA)) == {
        "status": "available", "reason": None, "last_metadata_update_utc": "2001-09-09T01:46:40Z",
        "current_snapshot_commit_utc": "2001-09-09T01:45:00Z", "latest_operation": "append",
        "latest_added_records": 450, "latest_added_data_files": 3, "latest_added_files_size_bytes": 9000,
        "total_records": 12000, "total_data_files": 80, "total_files_size_bytes": 250000,
        "average_rows_per_data_file": 150.0, "average_data_file_size_bytes": 3125.0,
        "total_delete_files": 4, "total_position_deletes": 6, "total_equality_deletes": 5,
        "snapshot_history_count": 2, "metadata_history_count": 3,
    }


@pytest.mark.parametrize("text, reason", [
    (None, "not_configured"), ("[1]", "read_failed"), ("oops", "read_failed"), ("{}", "invalid_metadata"),
    (json.dumps({"current-snapshot-id": 1, "snapshots": []}), "missing_current_snapshot"),
    (json.dumps({"current-snapshot-id": 1, "snapshots": [{"snapshot-id": 1}]}), "missing_snapshot_summary"),
])
def test_unavailable_table(spark, text, reason):
    found = section(spark, text)
    assert (found["status"], found["reason"], found["total_records"]) == ("unavailable", reason, None)


def test_current_metadata_follows_the_hint_only(spark, tmp_path):
    for name, hint in (("good", "12\n"), ("bad", "v12\n"), ("gone", "7")):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "version-hint.text").write_text(hint)
        (folder / "v12.metadata.json").write_text(json.dumps(METADATA, indent=2))
        (folder / "v11.metadata.json").write_text("{}")
    (tmp_path / "empty").mkdir()
    folders = {name: str(tmp_path / name) for name in ("good", "bad", "gone", "empty")}
    rows = {r["table_id"]: r for r in read_current_metadata(spark, folders).collect()}
    assert json.loads(rows["good"]["metadata"]) == METADATA and rows["good"]["reason"] is None
    assert rows["good"]["metadata_version"] == "12"
    for name in ("bad", "gone", "empty"):
        assert (rows[name]["metadata"], rows[name]["reason"]) == (None, "read_failed")


SAMPLES = "table_id string, sampled_at timestamp, metadata_version string, snapshot_id string"


def test_quiet_window(spark):
    def seen(table, *steps):
        return [(table, NOW + timedelta(seconds=t), version, version + "s") for t, version in steps]

    rows = [
        *seen("still", (-960, "42"), (-890, "42"), (-600, "42"), (-300, "42"), (-10, "42")),
        *seen("old_change", (-2000, "41"), (-910, "42"), (-600, "42"), (-300, "42"), (0, "42")),
        *seen("moved", (-960, "42"), (-600, "42"), (-300, "43"), (0, "43")),
        *seen("moved_back", (-960, "42"), (-600, "43"), (-300, "42"), (0, "42")),
        *seen("once", (0, "42")),
        *seen("long_ago", (-86400, "42"), (-86000, "42")),
        *seen("gap", (-960, "42"), (-100, "42"), (0, "42")),
        *seen("no_start", (-890, "42"), (-600, "42"), (-300, "42"), (0, "42")),
        *seen("no_end", (-960, "42"), (-700, "42"), (-400, "42")),
        *seen("future", (-960, "42"), (-600, "42"), (-300, "42"), (-1, "42"), (5, "43")),
    ]
    samples = spark.createDataFrame(rows, SAMPLES)
    got = {r["table_id"]: r for r in upkeep.quiet_tables(samples, NOW, 900, 360).collect()}
    assert {t: r["reason"] for t, r in got.items()} == {
        "still": "quiet", "old_change": "quiet", "moved": "changed", "moved_back": "changed", "once": "not_covered",
        "long_ago": "not_covered", "gap": "not_covered", "no_start": "not_covered", "no_end": "not_covered",
        "future": "quiet"}
    assert all(r["is_quiet"] == (r["reason"] == "quiet") for r in got.values())
    assert got["moved"]["changed_at"].replace(tzinfo=timezone.utc) == NOW - timedelta(seconds=300)
    assert got["still"]["snapshot_id"] == "42s" and got["moved"]["metadata_version"] == "43"
    now = {r["table_id"]: r["is_quiet"] for r in upkeep.quiet_tables(samples, NOW, 900, 360, run_now=True).collect()}
    assert set(now.values()) == {True}
    for bad in (0, 60), (60, 0):
        with pytest.raises(ValueError):
            upkeep.quiet_tables(samples, NOW, *bad)


def test_newest_snapshots_break_ties_by_id(spark):
    rows = spark.createDataFrame([("t", NOW, 3), ("t", NOW, 7), ("t", NOW, 5)], "table_id string, committed_at timestamp, snapshot_id long")
    assert [r["snapshot_id"] for r in tables.newest_snapshots(rows, 2).orderBy("newest_rank").collect()] == [7, 5]


def test_expiry_keeps_recent_current_and_protected(spark):
    days = [(f"s{i}", NOW - timedelta(days=i)) for i in range(30)]
    rows = spark.createDataFrame([("t", s, at) for s, at in days], "table_id string, snapshot_id string, committed_at timestamp")
    protected = spark.createDataFrame([("t", "s20")], "table_id string, snapshot_id string")
    plan = upkeep.expiry_plan(rows, NOW, days=7, keep=3, protected=protected)
    assert {r["snapshot_id"] for r in plan.collect()} == {f"s{i}" for i in range(8, 30)} - {"s20"}
    plan = upkeep.expiry_plan(rows, NOW, days=7, keep=25)
    assert {r["snapshot_id"] for r in plan.collect()} == {f"s{i}" for i in range(25, 30)}
    with pytest.raises(ValueError):
        upkeep.expiry_plan(rows, NOW, keep=0)


def test_orphans_are_never_younger_than_a_day(spark):
    files = spark.createDataFrame(
        [("a", NOW - timedelta(days=4)), ("b", NOW - timedelta(days=4)), ("c", NOW - timedelta(days=2))],
        "file_path string, modified_at timestamp")
    used = spark.createDataFrame([("a",)], "file_path string")
    assert [r["file_path"] for r in upkeep.orphan_plan(files, used, NOW).collect()] == ["b"]
    with pytest.raises(ValueError):
        upkeep.orphan_plan(files, used, NOW, timedelta(hours=23))


@pytest.fixture
def table(spark, tmp_path):
    """A bar folder as ingest lays it out: a folder per batch, and one per date below it."""
    root = str(tmp_path / "bars")
    for batch in range(4):
        rows = spark.range(batch * 500, batch * 500 + 500).select(
            "id", F.concat(F.lit("S"), (F.col("id") % 7).cast("string")).alias("symbol"),
            F.date_add(F.lit("2025-03-10"), F.when(F.col("id") % 10 < 8, 0).otherwise(1)).alias("event_date"))
        rows.repartition(3).write.partitionBy("event_date").parquet(f"{root}/query_id=q/batch_id={batch}")
    return root


def test_compaction_of_a_bar_folder(spark, table, tmp_path):
    before = compaction.read_days(spark, table)
    planned = compaction.folder_state(before)
    assert (planned["records"], planned["files"]) == (2000, 24)
    place = str(tmp_path / "receipt.json")
    target = str(tmp_path / "compact")
    receipt = compaction.compact_days(spark, table, target, place, "r", expected=planned["version"], clock=lambda: NOW)
    after = spark.read.parquet(target)
    assert compaction.content_digest(after) == compaction.content_digest(before)
    assert set(after.columns) == set(before.columns) and receipt["post"]["files"] <= 4
    assert receipt == read_receipt(spark, place) and (tmp_path / "receipt.json").is_file()
    one = str(tmp_path / "one-day")
    compaction.compact_days(spark, table, one, place, "r", days=[date(2025, 3, 11)],
                            expected=compaction.folder_state(compaction.read_days(spark, table, [date(2025, 3, 11)]))["version"])
    assert spark.read.parquet(one).count() == 400
    spark.range(1).select("id", F.lit("S").alias("symbol"), F.lit("2025-03-10").cast("date").alias("event_date")
                          ).write.partitionBy("event_date").parquet(f"{table}/query_id=q/batch_id=9")
    with pytest.raises(compaction.CompactionRefused, match="unchanged_since_planned"):
        compaction.compact_days(spark, table, str(tmp_path / "late"), place, "r", expected=planned["version"])
    with pytest.raises(compaction.CompactionRefused, match="fewer_files"):
        compaction.compact_days(spark, target, str(tmp_path / "again"), place, "r", expected=compaction.folder_state(after)["version"])
    with pytest.raises(ValueError):
        compaction.compact_days(spark, table, str(tmp_path / "x"), place, "r", expected="1", target_bytes=1024)


def test_large_days_are_split_and_small_ones_share_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(compaction, "target_file_bytes", lambda size: size)
    root, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.range(60_000).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("symbol"),
        F.date_add(F.lit("2025-03-01"), F.greatest(F.lit(0), F.col("id").cast("int") % 1000 - 980)).alias("event_date"))
    rows.repartition(40).write.partitionBy("event_date").parquet(root)
    compaction.compact_days(spark, root, target, str(tmp_path / "r.json"), "r",
                            expected=compaction.folder_state(spark.read.parquet(root))["version"], target_bytes=500_000)
    files = {r["event_date"]: r["n"] for r in spark.read.parquet(target).select(
        "event_date", "_metadata.file_path").distinct().groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert max(files.values()) > 3 and sorted(files.values())[:15] == [1] * 15


@pytest.mark.parametrize("change, check", [
    ({"version": "1"}, "has_new_version"), ({"records": 11}, "same_record_count"), ({"files": 5}, "fewer_files"),
    ({"records": None}, "same_record_count"), ("failed", "no_failed_files"), ("rows", "same_rows")])
def test_each_broken_promise_has_its_name(spark, change, check):
    good = {"pre": {"version": "1", "records": 10, "files": 5}, "post": {"version": "2", "records": 10, "files": 4},
            "failed_files": 0, "same_rows": True}
    assert compaction.broken(spark, compaction.AFTER, **good) == []
    bad = dict(good)
    if change == "failed":
        bad["failed_files"] = 2
    elif change == "rows":
        bad["same_rows"] = False
    else:
        bad["post"] = {**good["post"], **change}
    assert compaction.broken(spark, compaction.AFTER, **bad) == [check]


def test_content_digest_sees_duplicates_and_changes(spark):
    rows = spark.range(50).withColumn("v", F.col("id") % 3)
    assert compaction.content_digest(rows) == compaction.content_digest(rows.repartition(5).select("v", "id"))
    assert compaction.content_digest(rows) != compaction.content_digest(rows.unionByName(rows.limit(1)))
    assert compaction.content_digest(rows) != compaction.content_digest(rows.withColumn("v", F.lit(1)))


def test_bins_and_files(spark, table):
    files = catalog.data_files(compaction.read_days(spark, table), "bars")
    assert files.count() == 24 and files.agg(F.sum("record_count")).first()[0] == 2000
    report = tables.file_report(files, 1 << 20).first()
    assert report["small_files"] == 24 and report["average_rows_per_data_file"] == 83.33
    sized = spark.createDataFrame([("t", f"f{i}", 40, 1) for i in range(10)],
                                  "table_id string, file_path string, file_size long, record_count long")
    found = tables.bins(tables.bin_plan(sized, 100)).orderBy("bin_id").collect()
    assert [(r["bin_id"], r["files"]) for r in found] == [(0, 3), (1, 2), (2, 3), (3, 2)]


def test_tables_are_created_listed_and_registered(spark, tmp_path):
    name = catalog.ensure_table(spark, "spark_catalog", "market", "bars_raw")
    assert catalog.ensure_table(spark, "spark_catalog", "market", "bars_raw") == name
    assert [r["tableName"] for r in catalog.describe_namespace(spark, "spark_catalog", "market").collect()] == ["bars_raw"]
    assert catalog.describe_table(spark, name).count() == 13
    with pytest.raises(LookupError, match="absent"):
        catalog.describe_namespace(spark, "spark_catalog", "nowhere")
    location = str(tmp_path / "data")
    spark.range(5).write.parquet(location)
    moved = catalog.register_location(spark, "spark_catalog", "market", "moved", location)
    assert spark.table(moved).count() == 5
    with pytest.raises(ValueError, match="already contains"):
        catalog.register_location(spark, "spark_catalog", "market", "moved", location)


def test_catalog_configuration():
    conf = catalog.catalog_conf(catalog.CatalogSettings("file:///tmp/warehouse"))
    assert conf["spark.sql.catalog.market.type"] == "hadoop"
    assert conf["spark.sql.session.timeZone"] == "UTC" and conf["spark.sql.caseSensitive"] == "true"
    rest = catalog.catalog_conf(catalog.CatalogSettings("w", "rest", uri="http://c"))
    assert rest["spark.sql.catalog.market.uri"] == "http://c"
    for bad in [dict(kind="other"), dict(kind="jdbc"), dict(warehouse="gs://b/w"),
                dict(warehouse="gs://b/w", allow_object_store=True)]:
        with pytest.raises(ValueError):
            catalog.catalog_conf(catalog.CatalogSettings(**{"warehouse": "w", **bad}))
    gs = catalog.catalog_conf(catalog.CatalogSettings(
        "gs://b/w", allow_object_store=True, connector_jar="/opt/connector.jar"))
    assert gs["spark.jars"] == "/opt/connector.jar" and gs["spark.hadoop.fs.gs.impl"].endswith("GoogleHadoopFileSystem")


def test_arguments(spark, tmp_path):
    assert table_parts("a.b.c_1") == ("a", "b", "c_1")
    for bad in ("1a", "a-b", "", "a;b", "a.b"):
        with pytest.raises(ValueError):
            dotted_name("a", bad, "c")
    with pytest.raises(ValueError):
        exactly_one(1, 2, "one only")
    with pytest.raises(ValueError):
        write_receipt(spark, str(tmp_path / "receipt.txt"), {})
    with pytest.raises(ValueError):
        write_receipt(spark, "gs://bucket/bad name.json", {})


class FakeIceberg:
    """Snapshot and file tables from memory, procedures that record their call."""

    def __init__(self, spark, states, rewritten):
        self.spark, self.states, self.rewritten, self.calls, self.step = spark, states, rewritten, [], 0

    def table(self, name):
        snapshot, records, files = self.states[self.step]
        if name.endswith(".snapshots"):
            schema = "snapshot_id long, committed_at timestamp, summary map<string,string>"
            rows = [(1, NOW - timedelta(days=1), {"total-records": "1"}), (snapshot, NOW, {"total-records": records})]
            return self.spark.createDataFrame(rows, schema)
        return self.spark.range(files)

    def sql(self, text):
        self.calls.append(text)
        if "rewrite_data_files" in text:
            self.step = 1
            return self.spark.createDataFrame([self.rewritten], "rewritten_data_files_count int, failed_data_files_count int")
        return self.spark.range(1)

    def __getattr__(self, name):
        return getattr(self.spark, name)


def test_iceberg_compaction_calls_and_receipt(spark, tmp_path):
    place = str(tmp_path / "receipt.json")
    fake = FakeIceberg(spark, [(5, "90", 8), (6, "90", 2)], (8, 0))
    receipt = compaction.compact_iceberg(fake, "lake.market.bars", "5", place, "r", clock=lambda: NOW)
    assert receipt["pre"] == {"version": "5", "records": 90, "files": 8}
    assert receipt["post"] == {"version": "6", "records": 90, "files": 2}
    assert receipt["data_files"]["rewritten_data_files_count"] == 8
    assert "target-file-size-bytes', '134217728'" in fake.calls[0] and "rewrite_manifests" in fake.calls[1]
    assert read_receipt(spark, place) == receipt
    for states, counts, check in [
            ([(7, "90", 8)], (0, 0), "unchanged_since_planned"), ([(5, None, 8)], (0, 0), "has_record_count"),
            ([(5, "90", 8), (6, "90", 2)], (8, 2), "no_failed_files"),
            ([(5, "90", 8), (6, "91", 2)], (8, 0), "same_record_count")]:
        fake = FakeIceberg(spark, states, counts)
        with pytest.raises(compaction.CompactionRefused, match=check):
            compaction.compact_iceberg(fake, "lake.market.bars", "5", place, "r")
        assert bool(fake.calls) == (len(states) == 2)
    with pytest.raises(ValueError):
        compaction.compact_iceberg(fake, "lake.market", "5", place, "r")
