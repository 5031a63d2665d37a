from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import test_frames
from tickhouse.operators import decode, loader, readviews
from tickhouse.operators.tables import reconcile
from tickhouse.schemas import FRAME
from tickhouse.sources import catalog
from tickhouse.sources.frames import read_landed, stream_landed
from tickhouse.streaming import ingest, views

NOW = datetime(2026, 1, 2, 15, tzinfo=timezone.utc)


def bar(i, **values):
    at = (NOW + timedelta(minutes=i)).strftime("%Y-%m-%dT%H:%M:%SZ")
    return {**test_frames.GOOD, "t": at, "v": i, **values}


def frame(offset, bars, part=0):
    return ("bars", part, offset, json.dumps(bars), NOW + timedelta(seconds=offset))


def drop_file(spark, folder, rows):
    spark.createDataFrame(rows, FRAME).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def place(tmp_path):
    names = ("bars", "quarantine", "ledger", "checkpoint")
    return str(tmp_path / "landed"), ingest.IngestPaths(**{n: str(tmp_path / n) for n in names})


def run(spark, landed, writer, max_files=1):
    query = ingest.start_ingest(stream_landed(spark, landed, max_files=max_files), writer)
    query.awaitTermination()


def test_ingest_restart_and_ledger(spark, place):
    landed, paths = place
    drop_file(spark, landed, [frame(0, [bar(0), bar(1)]), frame(1, []), frame(2, [bar(2)])])
    drop_file(spark, landed, [frame(3, [bar(3)]), ("bars", 0, 4, "{}", NOW), frame(0, [bar(0)], 1)])
    writer = ingest.BatchWriter(paths, "q")
    run(spark, landed, writer)
    drop_file(spark, landed, [frame(5, [bar(5), bar(6)])])
    run(spark, landed, writer)

    bars = spark.read.parquet(paths.bars)
    assert sorted(r["volume"] for r in bars.collect()) == [0, 0, 1, 2, 3, 5, 6]
    batch = decode.accepted(decode.decode(read_landed(spark, landed)))
    assert bars.count() == decode.explode_bars(batch).count()
    assert readviews.deduplicated(bars).count() == 6
    refused = spark.read.parquet(paths.quarantine).collect()
    assert [(r["src_offset"], r["reject_reason"]) for r in refused] == [(4, "not_an_array")]

    ledger = ingest.read_ledger(spark, paths.ledger)
    done = ledger.filter("event = 'commit_succeeded'").orderBy("batch_id").collect()
    assert sum(r["bars"] for r in done) == 7 and sum(r["quarantined_frames"] for r in done) == 1
    assert sorted((r["bars"], r["source_records"]) for r in done) == [(2, 1), (2, 2), (3, 2)]
    assert all(r["balanced"] for r in reconcile(ledger.filter("event = 'commit_succeeded'")).collect())

    pairs = loader.pair_commits(ingest.ledger_events(ledger)).collect()
    assert sorted(r["bars"] for r in pairs) == [2, 2, 3]
    section = loader.loader_summary(ingest.ledger_events(ledger)).first()
    assert section["state"] == "committing" and len(section["recent_commits"]) == 3


def test_replayed_batch_replaces_its_own_files(spark, place):
    landed, paths = place
    drop_file(spark, landed, [frame(0, [bar(0), bar(1)])])
    writer = ingest.BatchWriter(paths, "q")
    rows = read_landed(spark, landed)
    writer(rows, 0)
    writer(rows, 0)
    assert spark.read.parquet(paths.bars).count() == 2
    assert ingest.read_ledger(spark, paths.ledger).count() == 2


def test_strict_ingest_stops_at_a_poison_frame_and_recovers(spark, place):
    landed, paths = place
    drop_file(spark, landed, [frame(0, [bar(0)])])
    drop_file(spark, landed, [frame(1, [bar(1)]), ("bars", 0, 2, "oops", NOW)])
    with pytest.raises(Exception, match="refused frame"):
        run(spark, landed, ingest.BatchWriter(paths, "q", strict=True))
    ledger = ingest.read_ledger(spark, paths.ledger)
    failed = ledger.filter("failure_type is not null").collect()
    assert [(r["failure_type"], r["data_commit_status"]) for r in failed] == [("data_file_write_failed", "not_committed")]
    run(spark, landed, ingest.BatchWriter(paths, "q"))
    assert sorted(r["volume"] for r in spark.read.parquet(paths.bars).collect()) == [0, 1]
    summary = loader.failure_summary(ingest.ledger_events(ingest.read_ledger(spark, paths.ledger))).first()
    assert (summary["failure_count"], summary["last_failure_code"]) == (1, "loader_data_file_write_failed")


def test_ingest_into_a_catalog_table(spark, place):
    landed, paths = place
    drop_file(spark, landed, [frame(0, [bar(0), bar(1)])])
    table = catalog.ensure_table(spark, "spark_catalog", "stream", "bars_raw")
    writer = ingest.BatchWriter(paths, "q", table=table)
    rows = read_landed(spark, landed)
    writer(rows, 0)
    writer(rows, 0)
    assert spark.table(table).count() == 2  # the replayed batch was not appended again
    writer(rows, 1)
    assert spark.table(table).count() == 4
    assert spark.table(table).select("payload_hash").distinct().count() == 2
    with pytest.raises(Exception):
        ingest.BatchWriter(paths, "q", table="spark_catalog.stream.absent")(rows, 2)
    failed = ingest.read_ledger(spark, paths.ledger).filter("failure_type is not null").first()
    assert (failed["failure_type"], failed["data_commit_status"]) == ("iceberg_commit_failed", "not_committed")
    assert ingest.commit_failure(RuntimeError("x.CommitStateUnknownException")) == "iceberg_commit_state_unknown"


def test_landing_keeps_the_payload_untouched(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    odd = ' [ {"T" : "b"} ]\n'
    drop_file(spark, source, [("bars", 0, 0, odd, NOW)])
    ingest.land_frames(stream_landed(spark, source), target, str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(target).first()["raw"] == odd


def collect_stream(spark, frame, name):
    query = (frame.writeStream.format("memory").queryName(name).outputMode("append")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.table(name).collect()


def test_streaming_dedup(spark, tmp_path):
    rows = [("h1", NOW), ("h2", NOW), ("h1", NOW + timedelta(minutes=1)), ("h3", NOW)]
    folder = str(tmp_path / "bars")
    schema = "payload_hash string, ingested_at timestamp"
    for part in (rows[:2], rows[2:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    for salts in (1, 4):
        got = collect_stream(spark, views.stream_deduplicated(stream, salts=salts), f"dedup{salts}")
        assert sorted(r["payload_hash"] for r in got) == ["h1", "h2", "h3"]


def test_streaming_sessions(spark, tmp_path):
    at = [NOW, NOW + timedelta(minutes=5), NOW + timedelta(minutes=30), NOW + timedelta(hours=3)]
    folder, schema = str(tmp_path / "f"), "component string, at timestamp, received_at timestamp, kind string"
    spark.createDataFrame([("c", t, t, "received") for t in at], schema).coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema(schema).parquet(folder)
    closed = collect_stream(spark, views.stream_sessions(stream), "sessions")
    assert sorted((r["frames"], r["idle_at"]) for r in closed) == [
        (1, at[2].replace(tzinfo=None) + timedelta(minutes=10)), (2, at[1].replace(tzinfo=None) + timedelta(minutes=10))]
    with pytest.raises(ValueError):
        views.stream_sessions(stream, 0)
