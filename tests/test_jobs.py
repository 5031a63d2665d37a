from __future__ import annotations

import json
from datetime import timedelta, timezone

import pytest
from pyspark.sql import functions as F

import logs
import test_reports
import test_streaming
from test_status import COSTS, NOW, payload
from test_tables import METADATA
from tickhouse import jobs
from tickhouse.plans import compaction
from tickhouse.streaming import sampler
from tickhouse.plans.report import export_status

COSTS = {**COSTS, "currency": "USD"}


@pytest.fixture
def saved(tmp_path):
    def save(name, value):
        path = tmp_path / name
        path.write_text(value if isinstance(value, str) else json.dumps(value))
        return str(path)

    return save


def only(documents):
    return json.loads(documents.first()["document"])


def test_optional_inputs_degrade_to_a_reason(spark, saved, tmp_path):
    entries = saved("entries.json", logs.session())
    out = str(tmp_path / "out")
    found = only(export_status(spark, out, NOW, entries, metadata_document=str(tmp_path / "absent"),
                               cost_document=saved("broken.json", "nope")))
    assert found["table"]["reason"] == "read_failed" and found["costs"]["reason"] == "read_failed"
    assert found["health"]["status"] == "healthy"
    found = only(export_status(spark, out, NOW, entries, metadata_document=saved("m.json", json.dumps(METADATA, indent=2)),
                               cost_document=saved("c.json", json.dumps(COSTS, indent=2))))
    assert found["table"]["total_records"] == 12000 and found["costs"]["seven_day_net_cost"] == 12.5
    rows = saved("rows.json", payload([("2025-03-11", "0.75")], []).replace("EUR", "USD"))
    found = only(export_status(spark, out, NOW, entries, cost_rows=rows,
                               metadata_folders={"default": str(tmp_path / "absent")}))
    assert found["costs"]["today_net_cost"] == 0.75 and found["table"]["reason"] == "read_failed"


def test_export_arguments(spark, tmp_path):
    for bad in [dict(), dict(saved_entries="a", live_entries=spark.range(1)),
                dict(saved_entries="a", metadata_document="m", metadata_folders={}),
                dict(saved_entries="a", cost_document="c", cost_rows="r")]:
        with pytest.raises(ValueError):
            export_status(spark, str(tmp_path / "o"), NOW, **bad)


def test_jobs_end_to_end(spark, saved, tmp_path):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "raw")
    test_streaming.drop_file(spark, landed, [test_streaming.frame(0, [test_streaming.bar(0)])])
    jobs.run(spark, ["ingest", "--landed", landed, "--root", root, "--drain"])
    assert spark.read.parquet(f"{root}/bars").count() == 1

    out = str(tmp_path / "status")
    jobs.run(spark, ["status", "--input", saved("e.jsonl", "\n".join(map(json.dumps, logs.session()))), "--output", out,
                     "--now", "2025-03-11T20:16:00Z", "--json-lines", "--forbid", logs.TOPIC])
    assert json.loads(spark.read.text(out, wholetext=True).first()["value"])["schema_version"] == 3

    bill = str(tmp_path / "bill")
    test_reports.billing(spark).select(
        "usage_start_time", F.struct(F.col("service_name").alias("description")).alias("service"),
        F.struct(F.col("project_id").alias("id")).alias("project"), "currency", "cost", "credits", "export_time",
    ).write.parquet(bill)
    jobs.run(spark, ["costs", "--billing", bill, "--project", "p", "--output", str(tmp_path / "snap"),
                     "--now", "2026-09-03T12:00:00Z"])
    assert float(spark.read.parquet(str(tmp_path / "snap")).first()["seven_day_net_cost"]) == 11.5

    test_streaming.drop_file(spark, landed, [test_streaming.frame(1, [test_streaming.bar(1), test_streaming.bar(2)])])
    jobs.run(spark, ["ingest", "--landed", landed, "--root", root, "--drain", "--backfill"])
    bars, target = f"{root}/bars", str(tmp_path / "compacted")
    samples = str(tmp_path / "samples")
    jobs.run(spark, ["sample", "--table", f"{bars}={bars}", "--kind", "folder", "--samples", samples, "--interval", "1", "--count", "1"])
    version = compaction.folder_state(spark.read.parquet(bars))["version"]
    taken = sampler.read_samples(spark, samples).collect()
    assert {(r["table_id"], r["metadata_version"]) for r in taken} == {(bars, version)}
    compact = ["compact", "--root", bars, "--target", target, "--receipt", str(tmp_path / "r.json"), "--run-id", "x",
               "--expected", version]
    with pytest.raises(compaction.CompactionRefused, match="quiet_window"):  # one sample covers no window
        jobs.run(spark, [*compact, "--samples", samples])
    with pytest.raises(ValueError, match="quiet window"):
        jobs.run(spark, compact)
    with pytest.raises(SystemExit):
        jobs.run(spark, ["compact", "--root", bars, "--receipt", "r.json", "--run-id", "x", "--run-now"])
    at = taken[0]["sampled_at"].replace(tzinfo=timezone.utc)
    more = spark.createDataFrame([(bars, at + timedelta(seconds=60 * i), version, version) for i in range(16)], sampler.SAMPLE)
    more.write.parquet(f"{samples}/rows/batch_id=900")
    jobs.run(spark, [*compact, "--samples", samples, "--now", (at + timedelta(seconds=930)).isoformat()])
    stored, after = spark.read.parquet(bars), spark.read.parquet(target)
    assert compaction.content_digest(stored) == compaction.content_digest(after) and after.count() == 3
    assert compaction.folder_state(after)["files"] < compaction.folder_state(stored)["files"]
