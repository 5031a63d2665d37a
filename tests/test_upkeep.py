"""Selective rewriting, file listings, ledger folding, exactly-once appends, live routing, plans as rows."""

from __future__ import annotations

import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import test_streaming
from tickhouse.operators import upkeep
from tickhouse.operators.tables import bin_plan
from tickhouse.plans import compaction, inspect, rewrite
from tickhouse.plans.status import leaks
from tickhouse.sources import catalog, listing
from tickhouse.sources.frames import read_landed
from tickhouse.streaming import ingest, routing

NOW = datetime(2026, 9, 1, tzinfo=timezone.utc)


def write_day(spark, folder, first, rows, files):
    spark.range(first, first + rows).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("symbol"), F.lit("2025-03-10").cast("date").alias("event_date")
    ).repartition(files).write.mode("append").partitionBy("event_date").parquet(folder)


@pytest.fixture
def bars(spark, tmp_path, monkeypatch):
    """Six small files and one of target size."""
    monkeypatch.setattr(rewrite, "target_file_bytes", lambda size: size)
    root = str(tmp_path / "bars")
    write_day(spark, f"{root}/query_id=q/batch_id=0", 0, 600, 6)
    write_day(spark, f"{root}/query_id=q/batch_id=1", 1000, 4000, 1)
    return root


def state(spark, root, manifests):
    return rewrite.generation_state(rewrite.live_files(spark, root, manifests)[1])


def test_only_bins_of_small_files_are_rewritten(spark, bars, tmp_path):
    manifests, receipt = str(tmp_path / "generations"), str(tmp_path / "r.json")
    before = rewrite.live_files(spark, bars, manifests)[1].collect()
    small = sorted((r["file_path"] for r in before if r["record_count"] < 4000))
    large = [r for r in before if r["record_count"] == 4000]
    target = large[0]["file_size"]
    rows = compaction.content_digest(rewrite.read_live(spark, bars, manifests))
    planned = rewrite.rewrite_plan(rewrite.live_files(spark, bars, manifests)[1], target).collect()
    assert sorted(r["file_path"] for r in planned) == small
    done = rewrite.rewrite_small_files(spark, bars, manifests, receipt, "one", state(spark, bars, manifests)["version"], target)
    assert (done["rewritten_files"], done["generation"]) == (6, 1)
    after = {r["file_path"]: r for r in rewrite.live_files(spark, bars, manifests)[1].collect()}
    assert large[0]["file_path"] in after and not set(small) & set(after)
    # One file per bin, and it holds what the plan put into the bin.
    by_bin = {}
    for r in planned:
        by_bin[r["bin_id"]] = by_bin.get(r["bin_id"], 0) + r["record_count"]
    made = [r["record_count"] for p, r in after.items() if p != large[0]["file_path"]]
    assert sorted(made) == sorted(by_bin.values())
    assert compaction.content_digest(rewrite.read_live(spark, bars, manifests)) == rows
    with pytest.raises(compaction.CompactionRefused, match="unchanged_since_planned"):
        rewrite.rewrite_small_files(spark, bars, manifests, receipt, "two", "1", target)
    # The rest of one run is the next one's input; in the end nothing is left to do.
    again = rewrite.rewrite_small_files(spark, bars, manifests, receipt, "three", state(spark, bars, manifests)["version"], 10)
    assert (again["rewritten_files"], again["generation"]) == (0, 1)


def test_a_run_takes_whole_bins_up_to_its_bound(spark, bars, tmp_path):
    files = rewrite.live_files(spark, bars, str(tmp_path / "none"))[1]
    target = files.agg(F.max("file_size")).first()[0]
    small = files.where("record_count < 4000")
    size = small.agg(F.sum("file_size")).first()[0]
    two = bin_plan(small.withColumn("table_id", F.lit("d")), size // 2 + 1).groupBy("bin_id").count().collect()
    assert len(two) >= 2
    assert rewrite.rewrite_plan(files, int(size // 2 + 1) if size // 2 + 1 < target else target, 3).count() in (2, 3)


def test_orphans_of_real_folders(spark, bars, tmp_path):
    manifests = str(tmp_path / "generations")
    target = rewrite.live_files(spark, bars, manifests)[1].agg(F.max("file_size")).first()[0]
    old = listing.list_files(spark, bars, "*.parquet")
    assert old.count() == 7 and old.where("file_size <= 0 OR modified_at IS NULL").count() == 0
    small = {r["file_path"] for r in listing.referenced_by_generations(
        rewrite.live_files(spark, bars, manifests)[1].where("record_count < 4000")).collect()}
    version = state(spark, bars, manifests)["version"]
    rewrite.rewrite_small_files(spark, bars, manifests, str(tmp_path / "r.json"), "one", version, target)
    used = listing.referenced_by_generations(rewrite.kept_generations(spark, manifests, NOW, 1))
    later = datetime.now(timezone.utc) + timedelta(days=4)
    both = old.unionByName(listing.list_files(spark, f"{bars}.rewritten", "*.parquet"))
    assert {r["file_path"] for r in upkeep.orphan_plan(both, used, later).collect()} == small
    assert upkeep.orphan_plan(both, used, datetime.now(timezone.utc)).count() == 0
    assert all(os.path.exists(path) for path in small)  # a plan removes nothing
    assert rewrite.kept_generations(spark, str(tmp_path / "nowhere"), NOW).count() == 0


@pytest.fixture
def place(tmp_path):
    names = ("bars", "quarantine", "ledger", "checkpoint")
    return str(tmp_path / "landed"), ingest.IngestPaths(**{n: str(tmp_path / n) for n in names})


def test_a_crash_between_append_and_ledger_adds_nothing_twice(spark, place, monkeypatch):
    landed, paths = place
    test_streaming.drop_file(spark, landed, [
        test_streaming.frame(0, [test_streaming.bar(0), test_streaming.bar(1)]), ("bars", 0, 1, "{}", NOW)])
    table = catalog.ensure_table(spark, "spark_catalog", "once", "bars_raw")
    writer, rows = ingest.BatchWriter(paths, "q", table=table), read_landed(spark, landed)
    log = ingest.BatchWriter._log

    def crash(self, session, batch_id, event, *rest):
        if event == "commit_succeeded":
            raise KeyboardInterrupt  # not an Exception: nothing more is logged, as in a crash
        log(self, session, batch_id, event, *rest)

    monkeypatch.setattr(ingest.BatchWriter, "_log", crash)
    with pytest.raises(KeyboardInterrupt):
        writer(rows, 0)
    assert spark.table(table).count() == 2
    monkeypatch.setattr(ingest.BatchWriter, "_log", log)
    ingest.BatchWriter(paths, "q", table=table)(rows, 0)
    assert spark.table(table).count() == 2
    done = ingest.read_ledger(spark, paths.ledger).where("event = 'commit_succeeded'").collect()
    assert [(r["bars"], r["inserted"], r["source_records"], r["quarantined_frames"]) for r in done] == [(2, 2, 1, 1)]
    # A crash before the append leaves a start only; then the batch is appended.
    append = ingest.append_bars
    monkeypatch.setattr(ingest, "append_bars", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        writer(rows, 1)
    monkeypatch.setattr(ingest, "append_bars", append)
    writer(rows, 1)
    assert spark.table(table).count() == 4


def test_a_folded_ledger_reads_the_same(spark, place, monkeypatch):
    landed, paths = place
    test_streaming.drop_file(spark, landed, [test_streaming.frame(0, [test_streaming.bar(0)])])
    writer, rows = ingest.BatchWriter(paths, "q"), read_landed(spark, landed)
    for batch in range(5):
        writer(rows, batch)

    def read():
        names = ["query_id", "batch_id", "step", "event", "started_at", "bars", "inserted"]
        return sorted(map(tuple, ingest.read_ledger(spark, paths.ledger).select(*names).collect()))

    before = read()
    assert len(before) == 10
    # While the fold runs, the generation and the loose folders both hold the rows.
    during = []
    loose = ingest._loose_ledger
    monkeypatch.setattr(ingest, "_loose_ledger", lambda *a: (
        monkeypatch.setattr(ingest, "_loose_ledger", loose), loose(*a))[1])
    assert ingest.fold_ledger(spark, paths.ledger, keep_batches=2) == 1
    during.append(read())
    assert during == [before]
    left = sorted(os.listdir(f"{paths.ledger}/query_id=q"))
    assert left == ["batch_id=3", "batch_id=4"]
    writer(rows, 5)
    whole = read()
    assert ingest.fold_ledger(spark, paths.ledger, keep_batches=2) == 2 and read() == whole
    spark.createDataFrame([], "x int").write.parquet(f"{paths.ledger}.folded/generation=9/_temporary/part")
    assert read() == whole  # an unfinished generation does not count
    with pytest.raises(ValueError):
        ingest.fold_ledger(spark, paths.ledger, 0)


def test_live_routing_replaces_a_replayed_batch(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    health = 'LOADER_HEALTH {"timestamp":"2026-01-02T15:00:00Z","level":"ERROR","target":"t","fields":{"event":"heartbeat"}}'
    snapshot = '{"timestamp":"2026-01-02T15:00:01Z","level":"INFO","fields":{"message":"metrics"}}'
    lines = [
        ("p", 1, NOW, "bar-loader.service", "app", health), ("p", 2, NOW, "bar-loader.service", "app", "plain line"),
        ("p", 3, NOW, "bar-extractor.service", "app", snapshot), ("p", 4, NOW, "cron.service", "app", "foreign"),
        ("p", 5, NOW, "bar-loader.service", "app", "ClientTelemetryReporter - Client telemetry registered x"),
    ]
    spark.createDataFrame(lines, routing.LINES).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(routing.LINES).parquet(source)
    routing.start_routing(stream, folder, str(tmp_path / "c")).awaitTermination()

    def read():
        return {r: sorted(x["seq"] for x in routing.sink(spark, folder, r).collect())
                for r in (routing.PLAIN, routing.EXTRACTOR, routing.LOADER)}

    assert read() == {"plain": [2], "extractor_json": [3], "loader_health": [1]}
    routing.router(folder)(spark.read.parquet(source), 0)
    assert read() == {"plain": [2], "extractor_json": [3], "loader_health": [1]}
    assert routing.sink(spark, folder, routing.LOADER).first()["severity"] == "ERROR"


@pytest.mark.parametrize(("text", "kind"), [
    ("see gs://bucket/x", "location"), ('"/home/user/x"', "local_path"),
    ("id 123e4567-e89b-12d3-a456-426614174000", "uuid"), ("java.lang.IllegalStateException: x", "exception"),
    ("at a.b.C.run(C.java:12)", "stack_frame"), ("secret-topic", "secret-topic"), ("delivery_failure 12/31", None)])
def test_private_kinds_are_found_without_a_list(spark, text, kind):
    documents = spark.createDataFrame([("p", f'{{"x": "{text}"}}'.replace('""', '"'))], "pipeline_id string, document string")
    found = leaks(documents, ["secret-topic"]).collect()
    assert [r["tokens"] for r in found] == ([] if kind is None else [[kind]])


def test_plans_as_rows(spark, tmp_path):
    folder = str(tmp_path / "p")
    spark.range(100).select("id", (F.col("id") % 3).alias("k"), F.lit("x").alias("wide")).write.parquet(folder)
    rows = inspect.plan_rows(spark.read.parquet(folder).where("id > 5").groupBy("k").count()).collect()
    kinds = [r["kind"] for r in rows]
    assert kinds.count("exchange") == 1 and kinds.count("scan") == 1 and kinds.count("aggregate") == 2
    scan = next(r for r in rows if r["kind"] == "scan")
    assert "GreaterThan(id,5)" in scan["pushed_filters"] and "wide" not in scan["read_schema"]
    assert not {"python", "window"} & set(kinds)
