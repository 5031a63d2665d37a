from __future__ import annotations

import hashlib
import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tickhouse.functions.bars import symbol_list
from tickhouse.operators import control, decode, readviews
from tickhouse.sources.frames import encode_frames, topic_options
from tickhouse.sources.synthetic import synthetic_bars

GOOD = {"T": "b", "S": "ACME", "o": 132.65, "h": 136.0, "l": 132.12, "c": 134.65, "v": 205,
        "t": "2026-01-02T14:30:00Z", "n": 16, "vw": 133.7}
GOOD_HASH = "a0b43edf8de06bca93e5d543d2e45c58a3e22d8b333e36727c9c581adbbf90a6"
NOW = datetime(2026, 1, 2, 15, tzinfo=timezone.utc)


def frames(spark, *texts):
    rows = [("bars", 0, i, text, NOW) for i, text in enumerate(texts)]
    return spark.createDataFrame(
        rows, "topic string, part_id int, src_offset long, raw string, received_at timestamp"
    )


def without(name):
    return json.dumps([{k: v for k, v in GOOD.items() if k != name}])


def changed(**values):
    return json.dumps([{**GOOD, **values}])


def test_contract_frame_decodes_and_hashes(spark):
    bars = decode.explode_bars(decode.accepted(decode.decode(frames(spark, json.dumps([GOOD])))))
    row = decode.stored_bars(bars, F.lit(NOW)).first()
    text = "b|ACME|132.65|136.0|132.12|134.65|205|2026-01-02T14:30:00Z|16|133.7"
    assert hashlib.sha256(text.encode()).hexdigest() == GOOD_HASH
    assert row["payload_hash"] == GOOD_HASH
    assert (row["symbol"], row["volume"], row["trade_count"], row["vwap"]) == ("ACME", 205, 16, 133.7)


@pytest.mark.parametrize("text, reason", [
    (json.dumps([GOOD]), None),
    (json.dumps(GOOD), "not_an_array"),
    ("[]", None),
    ("nonsense", "not_an_array"),
    ('[{"T":"b",', "not_an_array"),
    ("[1,2]", "not_an_array"),
    ("[null]", "missing_member"),
    (changed(T="q"), "not_a_bar"),
    (changed(S="  "), "blank_symbol"),
    (changed(S="\t\u2003"), "blank_symbol"),
    (changed(S="[X"), None),
    (changed(S="[1]"), None),
    (changed(S="{}"), None),
    (changed(S=["X"]), "blank_symbol"),
    (changed(c="NaN"), "missing_member"),
    (changed(c="Infinity"), "missing_member"),
    (changed(c="1e999"), "missing_member"),
    (changed(c="1d"), "missing_member"),
    (json.dumps([GOOD]) * 2, "not_an_array"),
    (json.dumps([GOOD]) + " xyz", "not_an_array"),
    (json.dumps([GOOD]) + "," + json.dumps([GOOD]), "not_an_array"),
    (json.dumps([GOOD]) + "]", "not_an_array"),
    (json.dumps([GOOD]) + ',[{"T":"b"}]]', "not_an_array"),
    (" \n" + json.dumps([GOOD]) + "\t ", None),
    (changed(S={"x": 1}), "blank_symbol"),
    (changed(t="2026-01-02T14:30:00"), "bad_event_time"),
    (changed(t="2026-01-02 14:30"), "bad_event_time"),
    (changed(t="2026-13-02T14:30:00Z"), "bad_event_time"),
    (changed(t="2026-01-02T20:00:00+05:30"), None),
    (changed(o="1.5"), None),
    (changed(o="abc"), "missing_member"),
    (changed(v=205.0), None),
    (changed(v=205.7), "missing_member"),
    (changed(v="205.7"), "missing_member"),
    (changed(extra={"a": 1}), None),
    ('[{"T":"success","msg":"connected"}]', "missing_member"),
])
def test_frame_acceptance(spark, text, reason):
    assert decode.decode(frames(spark, text)).first()["reject_reason"] == reason


@pytest.mark.parametrize("member", list(GOOD))
def test_every_member_is_required(spark, member):
    assert decode.decode(frames(spark, without(member))).first()["reject_reason"] == "missing_member"


def test_one_bad_bar_refuses_the_whole_frame_and_loses_nothing(spark):
    mixed = json.dumps([GOOD, {**GOOD, "T": "q"}, GOOD])
    decoded = decode.decode(frames(spark, json.dumps([GOOD, GOOD]), mixed, "[]"))
    assert decode.explode_bars(decode.accepted(decoded)).count() == 2
    refused = decode.quarantine(decoded).collect()
    assert [(r["src_offset"], r["raw"], r["reject_reason"]) for r in refused] == [(1, mixed, "not_a_bar")]


def test_strict_mode_fails_on_a_poison_frame(spark):
    clean = decode.require_clean(decode.decode(frames(spark, json.dumps([GOOD]), "{}")))
    with pytest.raises(Exception, match="refused frame bars/0/1: not_an_array"):
        decode.explode_bars(clean).collect()


@pytest.mark.parametrize("text, want, outcome, detail", [
    ('[{"T":"success","msg":"ready"}]', ("success", "ready"), "match", None),
    ('[{"T":"subscription","bars":["QQ","ZZZ"]}]', ("subscription", None), "match", None),
    ('[{"T":"success","msg":"ready"},{"T":"error","msg":"later"}]', ("success", None), "match", None),
    ('[{"T":"error","code":418,"msg":"teapot"}]', ("success", "ready"), "fatal", "server error 418: teapot"),
    ('[{"T":"error","msg":"none"}]', ("subscription", None), "fatal", "server error -1: none"),
    ('[{"T":"notice"}]', ("success", "ready"), "mismatch", "expected T=success, got T=notice"),
    ('[{"T":"success","msg":"wait"}]', ("success", "ready"), "mismatch", "expected msg=ready, got msg=wait"),
    ('[{"T":"b","S":"QQ","v":3}]', ("subscription", None), "mismatch", "expected T=subscription, got T=b"),
    ("[]", ("success", "ready"), "malformed", None),
    ('{"T":"notice"}', ("notice", None), "malformed", None),
])
def test_control_messages(spark, text, want, outcome, detail):
    message = control.first_message(F.col("raw"))
    row = frames(spark, text).select(control.classify(message, *want).alias("c")).first()["c"]
    assert (row["outcome"], row["detail"]) == (outcome, detail)


def test_routes(spark):
    routed = control.route_frames(frames(spark, json.dumps([GOOD]), '[{"T":"error"}]', "x", "[ ]"))
    assert [r["frame_route"] for r in routed.orderBy("src_offset").collect()] == [
        "bars", "control", "malformed", "bars"]


def test_first_synthetic_bar_and_identity(spark):
    start = datetime(2026, 1, 2, 14, 30, tzinfo=timezone.utc)
    rows = synthetic_bars(spark, start, 3, ["AAPL", "MSFT"]).orderBy("period", "symbol_index").collect()
    first = rows[0]
    assert len(rows) == 6 and len({r["event_id"] for r in rows}) == 6
    assert (first["open"], first["high"], first["low"], first["close"]) == (174.95, 175.15, 174.85, 175.0)
    assert (first["volume"], first["trade_count"], first["vwap"]) == (1000, 10, 175.0)
    assert first["event_time_text"] == "2026-01-02T14:30:00.000000Z"
    expected = hashlib.sha256(b"AAPL|2026-01-02T14:30:00.000000Z").hexdigest()
    assert first["event_id"] == expected


@pytest.mark.parametrize("arguments", [
    {"periods": 0}, {"periods": 1, "symbols": []}, {"periods": 1, "interval": timedelta(0)},
    {"periods": 1, "start": datetime(2026, 1, 2)},
])
def test_synthetic_arguments(spark, arguments):
    with pytest.raises(ValueError):
        synthetic_bars(spark, **{"start": NOW, **arguments})


def test_encode_then_decode_is_identity(spark):
    bars = synthetic_bars(spark, NOW, 5, ["AAPL", "MSFT", "X"])
    keyed = bars.select("*", F.lit("bars").alias("topic"), F.lit(0).alias("part_id"),
                        F.col("period").alias("src_offset"))
    encoded = encode_frames(keyed, ["topic", "part_id", "src_offset"], ["symbol_index"])
    assert json.loads(encoded.filter("src_offset = 0").first()["raw"])[0]["S"] == "AAPL"
    back = decode.explode_bars(decode.accepted(decode.decode(encoded)))
    names = ["symbol", "open", "high", "low", "close", "volume", "event_time_text", "trade_count", "vwap"]
    assert back.select(names).exceptAll(bars.select(names)).count() == 0
    assert back.count() == 15


def test_replays_are_kept_and_the_view_dedupes(spark):
    texts = frames(spark, json.dumps([GOOD]), json.dumps([GOOD]))
    bars = decode.stored_bars(decode.explode_bars(decode.accepted(decode.decode(texts))), F.lit(NOW))
    assert bars.count() == 2
    view = readviews.deduplicated(bars).collect()
    assert [(r["src_offset"], r["delivery_count"]) for r in view] == [(0, 2)]


def test_text_bound_drops_the_microsecond_form(spark):
    texts = frames(spark, changed(t="2026-01-02T14:30:00Z"), changed(t="2026-01-02T14:30:00.000000Z"))
    bars = decode.stored_bars(decode.explode_bars(decode.accepted(decode.decode(texts))), F.lit(NOW))
    start = datetime(2026, 1, 2, 14, 30, tzinfo=timezone.utc)
    assert readviews.bounded(bars, start, NOW, 10).count() == 2
    assert readviews.bounded(bars, start, NOW, 10, text_compare=True).count() == 1
    with pytest.raises(ValueError):
        readviews.bounded(bars, start, NOW, 0)


def test_symbol_list(spark):
    row = spark.range(1).select(symbol_list(F.lit(" QQ,ZZZ , ,Y")).alias("s")).first()
    assert row["s"] == ["QQ", "ZZZ", "Y"]


def test_topic_options():
    options = topic_options("host:9092", "bars", max_frames=1000, min_frames=100)
    assert options["startingOffsets"] == "earliest"
    assert options["maxTriggerDelay"] == "300s"
