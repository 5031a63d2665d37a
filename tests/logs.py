"""Log entries of an invented session: bars stop before the close, the loader drains and idles."""

from __future__ import annotations

import json

EXTRACTOR, LOADER = "bar-extractor.service", "bar-loader.service"
TOPIC, PROCESS = "minute-bars", "2025-03-11T12:05:00Z"


def extractor(at, message, level="INFO", counters=None, **fields):
    body = {"message": message, **fields}
    if counters is not None:
        body["snapshot"] = json.dumps(counters)
    return {"timestamp": at, "jsonPayload": {"_SYSTEMD_UNIT": EXTRACTOR, "level": level, "fields": body}}


def loader(at, event, process=PROCESS, topic=TOPIC, **fields):
    body = {"event": event, "topic": topic, "process_started_at_utc": process, **fields}
    return {"timestamp": at, "jsonPayload": {
        "_SYSTEMD_UNIT": LOADER, "target": "iceberg_loader::health", "fields": body}}


def counters(received, sent, last):
    return {"connection_status": False, "delivery_failures": received - sent, "errors": 2,
            "last_message_ts": last, "messages_received": received, "messages_sent": sent}


def session():
    """A Tuesday. The extractor shuts down in order at 20:14:42; the last heartbeat is 20:15:30."""
    idle = "no bar data within idle window; shutting down producer"
    durable = {"last_commit_at_utc": "2025-03-11T20:05:09Z", "last_input_at_utc": "2025-03-11T20:04:31Z"}
    return [
        extractor("2025-03-11T18:20:10Z", "metrics", counters=counters(812, 812, "2025-03-11T18:20:00Z")),
        extractor("2025-03-11T20:14:41Z", idle, "WARN", idle_secs=610),
        extractor("2025-03-11T20:14:42Z", "final metrics", counters=counters(905, 903, "2025-03-11T20:04:30Z")),
        loader("2025-03-11T20:05:02Z", "commit_started", state="committing", batch_bars=640,
               batch_source_records=11),
        loader("2025-03-11T20:05:09Z", "commit_succeeded", state="committing",
               durable_commit_total_duration_ms=6500, **durable),
        loader("2025-03-11T20:15:30Z", "heartbeat", state="buffering", aggregate_lag_records=3,
               buffered_bars=18, buffered_source_records=3, partitions=[
                   {"topic": TOPIC, "partition": 1, "committedOffset": 77, "endOffset": 80, "lagRecords": 3}],
               **durable),
    ]
