"""Queries over frames and bars: decoding, validation, hashing, batching, read views."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tickhouse.functions.bars import (
    event_id,
    producer_fault,
    subscribed,
    trade_count,
    typical_price,
)
from tickhouse.functions.times import micros_text
from tickhouse.operators import batching, control, cuts, decode, readviews
from tickhouse.operators.tables import reconcile
from tickhouse.queries import inputs
from tickhouse.queries.inputs import sql
from tickhouse.queries.registry import query
from tickhouse.session import checkpoint_dir
from tickhouse.sources.synthetic import expand_periods
from tickhouse.streaming import cuts as live_cuts
from tickhouse.streaming.run import drained, shared_path

BAR_OUTPUT = [
    "bar_type", "symbol", "open", "high", "low", "close", "volume", "event_time_text",
    "trade_count", "vwap",
]
BAR_SQL = ", ".join(BAR_OUTPUT)


def _long(name: str):
    return F.col(name).cast("long").alias(name)


@query("frames_p1_decode", sql(
    f"""SELECT part_id, src_offset, CAST(row_number() OVER (PARTITION BY part_id, src_offset ORDER BY pos) - 1 AS BIGINT) AS pos,
        event_ts, {BAR_SQL} FROM bars""", "bars"))
def decode_frames(spark, sf_dir):
    """JSON frames decoded back into bars, array order kept."""
    decoded = decode.accepted(decode.decode(inputs.raw_frames(spark, sf_dir)))
    return decode.explode_bars(decoded).select(
        _long("part_id"), "src_offset", _long("pos"),
        F.col("event_ts").cast("timestamp_ntz").alias("event_ts"), *BAR_OUTPUT,
    )


@query("frames_s3_encode", sql(
    """SELECT part_id, src_offset, '[' || string_agg('{"T":"b","S":"' || symbol || '","o":' || CAST(open AS VARCHAR) || ',"h":' || CAST(high AS VARCHAR)
         || ',"l":' || CAST(low AS VARCHAR) || ',"c":' || CAST(close AS VARCHAR) || ',"v":' || CAST(volume AS VARCHAR) || ',"t":"' || event_time_text
         || '","n":' || CAST(trade_count AS VARCHAR) || ',"vw":' || CAST(vwap AS VARCHAR) || '}', ',' ORDER BY pos) || ']' AS raw
       FROM bars GROUP BY 1, 2""", "bars"))
def encode(spark, sf_dir):
    """Bars as the JSON array messages a producer sends (S3)."""
    return inputs.raw_frames(spark, sf_dir).select(_long("part_id"), "src_offset", "raw")


def _damaged(spark, sf_dir):
    """Bars with some wrong types, blank symbols and times without a zone."""
    number = F.col("event_id")
    return (
        inputs.bars(spark, sf_dir)
        .withColumn("bar_type", F.when(number % 11 == 0, "q").otherwise(F.col("bar_type")))
        .withColumn("symbol", F.when(number % 13 == 0, F.when(number % 2 == 0, "  ").otherwise("\t"))
                    .when(number % 19 == 0, "[X").otherwise(F.col("symbol")))
        .withColumn("event_time_text", F.when(
            number % 17 == 0, F.replace(F.col("event_time_text"), F.lit("Z"), F.lit(""))
        ).otherwise(F.col("event_time_text")))
    )


FAULT_SQL = """CASE WHEN event_id % 11 = 0 THEN 'not_a_bar' WHEN event_id % 13 = 0 THEN 'blank_symbol'
               WHEN event_id % 17 = 0 THEN 'bad_event_time' END"""


@query("frames_p3_bar_faults", sql(
    f"""SELECT part_id, src_offset, CAST(row_number() OVER (PARTITION BY part_id, src_offset ORDER BY pos) - 1 AS BIGINT) AS pos,
        {FAULT_SQL} AS fault FROM bars""", "bars"))
def bar_faults(spark, sf_dir):
    """Fault of every bar after damaging some of them."""
    frames = inputs.encode_frames(
        _damaged(spark, sf_dir), ["topic", "part_id", "src_offset"], ["pos"]
    )
    return decode.decode(frames).select(
        _long("part_id"), "src_offset", F.posexplode("bar_faults").alias("pos", "fault")
    ).withColumn("pos", F.col("pos").cast("long"))


@query("frames_p4_quarantine", sql(
    """SELECT part_id, src_offset, CASE WHEN src_offset % 12 IN (0, 1) THEN 'missing_member' WHEN src_offset % 12 = 2 THEN 'not_a_bar'
              WHEN src_offset % 12 IN (3, 4) THEN 'blank_symbol' WHEN src_offset % 12 = 5 THEN 'bad_event_time' ELSE 'not_an_array' END AS reject_reason,
              TRUE AS has_raw FROM bars WHERE src_offset % 12 < 10 GROUP BY 1, 2""", "bars"))
def quarantined_frames(spark, sf_dir):
    """Damaged frames are refused whole and kept with the reason of their first bad bar."""
    kind, raw = F.col("src_offset") % 12, F.col("raw")
    first = lambda pattern, text: F.regexp_replace(
        "raw", "^(.*?)" + pattern, "$1" + text)
    damaged = (
        F.when(kind == 0, F.regexp_replace("raw", '"vw":[0-9.]+\\}\\]$', '"x":1}]'))
        .when(kind == 1, first('"o":[0-9.]+', '"o":"NaN"'))
        .when(kind == 2, first('"T":"b"', '"T":"q"'))
        .when(kind == 3, first('"S":"[^"]*"', '"S":"\\\\t"'))
        .when(kind == 4, first('"S":"[^"]*"', '"S":["X"]'))
        .when(kind == 5, first('Z"', '"'))
        .when(kind == 6, F.concat(raw, raw))
        .when(kind == 7, F.concat(raw, F.lit(" xyz")))
        .when(kind == 8, F.concat(raw, F.lit("]")))
        .when(kind == 9, F.regexp_extract("raw", "^\\[(.*)\\]$", 1))
        .when(kind == 10, F.concat(F.lit(" \n"), raw, F.lit("\t ")))
        .otherwise(raw)
    )
    frames = inputs.raw_frames(spark, sf_dir).withColumn("raw", damaged)
    return decode.quarantine(decode.decode(frames)).select(
        _long("part_id"), "src_offset", "reject_reason", F.col("raw").isNotNull().alias("has_raw")
    )


CONTROL_SQL = """
SELECT event_id, CASE event_type
    WHEN 'click' THEN 'match' WHEN 'view' THEN CASE WHEN k % 2 = 0 THEN 'match' ELSE 'mismatch' END
    WHEN 'signup' THEN 'mismatch' WHEN 'purchase' THEN 'malformed' ELSE 'fatal' END AS outcome,
  CASE event_type
    WHEN 'view' THEN CASE WHEN k % 2 = 1 THEN 'expected msg=connected, got msg=authenticated' END
    WHEN 'signup' THEN 'expected T=success, got T=subscription'
    WHEN 'error' THEN CASE WHEN k % 3 = 0 THEN 'server error -1: bad' ELSE 'server error ' || CAST(400 + k AS VARCHAR) || ': bad' END
  END AS detail,
  CASE WHEN event_type = 'purchase' THEN 'malformed' ELSE 'control' END AS frame_route
FROM ev"""


@query("frames_p5_control", sql(CONTROL_SQL, "ev"))
def control_frames(spark, sf_dir):
    """Control messages classified against an expected greeting (P5)."""
    kind, k = F.col("event_type"), F.col("k")
    raw = (
        F.when(kind == "click", '[{"T":"success","msg":"connected"}]')
        .when(kind == "view", F.when(k % 2 == 0, '[{"T":"success","msg":"connected"}]').otherwise(
            '[{"T":"success","msg":"authenticated"}]'))
        .when(kind == "signup", '[{"T":"subscription","bars":["AAPL"]}]')
        .when(kind == "purchase", '{"T":"success"}')
        .otherwise(F.when(k % 3 == 0, '[{"T":"error","msg":"bad"}]').otherwise(
            F.format_string('[{"T":"error","code":%d,"msg":"bad"}]', k + 400)))
    )
    frames = control.route_frames(inputs.events(spark, sf_dir).withColumn("raw", raw))
    outcome = control.classify(control.first_message(F.col("raw")), "success", "connected")
    return frames.select("event_id", outcome.alias("c"), "frame_route").select(
        "event_id", "c.outcome", "c.detail", "frame_route"
    )


@query("frames_p6_stored_rows", sql(
    f"""SELECT sha256(concat_ws('|', bar_type, symbol, CAST(open AS VARCHAR), CAST(high AS VARCHAR), CAST(low AS VARCHAR),
          CAST(close AS VARCHAR), CAST(volume AS VARCHAR), event_time_text, CAST(trade_count AS VARCHAR),
          CAST(vwap AS VARCHAR))) AS payload_hash, {BAR_SQL}, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at,
        part_id, src_offset FROM bars""", "bars"))
def stored_rows(spark, sf_dir):
    """Storage projection with payload hash and one ingest time per batch."""
    ingested = F.lit(datetime(2024, 2, 1, tzinfo=timezone.utc))
    return decode.stored_bars(inputs.bars(spark, sf_dir), ingested).select(
        "payload_hash", *BAR_OUTPUT, F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"),
        _long("part_id"), "src_offset",
    )


@query("frames_f2_event_ids", sql(
    """SELECT event_id AS source_id, event_time_text, sha256(symbol || '|' || event_time_text) AS event_id FROM bars""",
    "bars"))
def event_ids(spark, sf_dir):
    """Deterministic event id and microsecond UTC text."""
    return inputs.bars(spark, sf_dir).select(
        F.col("event_id").alias("source_id"),
        micros_text(F.col("event_ts")).alias("event_time_text"),
        event_id(F.col("symbol"), F.col("event_ts")).alias("event_id"),
    )


@query("frames_f10_typical_price", sql(
    """SELECT event_id, (2 * s + 300) // 600 / 100::DOUBLE AS typical_price, greatest(1, volume // 100) AS trade_count
       FROM (SELECT *, 300 * CAST(round(close * 100) AS BIGINT) + event_id % 500 + event_id % 97 AS s FROM bars)""", "bars"))
def typical_prices(spark, sf_dir):
    """Typical price and trade count a producer derives, from prices of a hundredth of a cent."""
    part = lambda n: F.col("close") + (F.col("event_id") % n) / F.lit(10000.0)
    return inputs.bars(spark, sf_dir).select(
        "event_id", typical_price(part(500), F.col("close"), part(97)).alias("typical_price"),
        trade_count(F.col("volume")).alias("trade_count"),
    )


@query("frames_p20_producer_faults", sql(
    """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'symbol_required'
              WHEN k < 20 THEN 'negative_volume' END AS fault FROM ev""", "ev"))
def producer_faults(spark, sf_dir):
    """Producer-side bar constraints (P20)."""
    return inputs.events(spark, sf_dir).select("event_id", producer_fault(
        F.when(F.col("event_id") % 7 == 0, "").otherwise(inputs.user_name(F.col("user_id"))),
        F.col("ts"), F.col("k") - 20,
    ).alias("fault"))


@query("frames_p21_subscription", sql(
    "SELECT event_id, symbol FROM bars WHERE symbol IN ('U001', 'U007', 'U042')", "bars"))
def subscription(spark, sf_dir):
    """Bars of a comma-separated subscription list."""
    return inputs.bars(spark, sf_dir).filter(
        subscribed(F.col("symbol"), "U001, U007 , ,U042")
    ).select("event_id", "symbol")


SYNTHETIC_SQL = """
SELECT event_id AS period, s.symbol, (s.base + event_id * 25 - 5) / 100::DOUBLE AS open,
       (s.base + event_id * 25 + 15) / 100::DOUBLE AS high, (s.base + event_id * 25 - 15) / 100::DOUBLE AS low,
       (s.base + event_id * 25) / 100::DOUBLE AS close, 1000 + event_id * 10 + s.i AS volume,
       greatest(1, (1000 + event_id * 10 + s.i) // 100) AS trade_count, (s.base + event_id * 25) / 100::DOUBLE AS vwap,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time_text,
       sha256(s.symbol || '|' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')) AS event_id
FROM events CROSS JOIN (VALUES ('AAPL', 0, 17500), ('MSFT', 1, 38010), ('QQQ', 2, 10220)) AS s(symbol, i, base)"""


def _synthetic(spark, sf_dir):
    periods = inputs.events(spark, sf_dir).select(
        F.col("event_id").alias("period"), F.col("ts").alias("event_ts")
    )
    return expand_periods(periods, ["AAPL", "MSFT", "QQQ"])


@query("synthetic_s4_bars", sql(SYNTHETIC_SQL))
def synthetic(spark, sf_dir):
    """Deterministic bars, one period per event crossed with three symbols."""
    return _synthetic(spark, sf_dir).select(
        "period", "symbol", "open", "high", "low", "close", "volume", "trade_count", "vwap",
        "event_time_text", "event_id",
    )


@query("synthetic_u4_uniqueness", sql(
    f"""SELECT count(*) AS row_count, count(DISTINCT event_id) AS distinct_count,
        count(*) = count(DISTINCT event_id) AS is_unique FROM ({SYNTHETIC_SQL})"""))
def synthetic_uniqueness(spark, sf_dir):
    """Are the produced event ids unique? (U4)"""
    return readviews.uniqueness(_synthetic(spark, sf_dir), "event_id")


LIMIT = 100


@query("batching_w1_batch_ids", sql(
    f"""SELECT part_id, src_offset, pos_in_frame AS pos, place // {LIMIT} AS batch_id, is_final FROM placed""", "placed"))
def batch_ids(spark, sf_dir):
    """Batch of every decoded bar and whether it ends its frame."""
    frames = decode.accepted(decode.decode(inputs.raw_frames(spark, sf_dir)))
    bars = batching.batched_bars(decode.explode_bars(frames).select(
        "topic", "part_id", "src_offset", "frame_size", "pos", "is_final"), LIMIT, span=64)
    return bars.select(_long("part_id"), "src_offset", _long("pos"), "batch_id", "is_final")


@query("batching_a1_batch_sizes", sql(
    f"""SELECT part_id, place // {LIMIT} AS batch_id, count(*) AS bars, count(DISTINCT src_offset) AS source_records,
        count(*) < {LIMIT} AS is_partial FROM placed GROUP BY 1, 2""", "placed"))
def batch_sizes(spark, sf_dir):
    """Bars and distinct source records of each batch, partial remainder flagged."""
    placed = batching.place_frames(inputs.sized_frames(spark, sf_dir))
    return batching.batch_summary(placed, LIMIT).select(
        _long("part_id"), "batch_id", "bars", "source_records", "is_partial"
    )


@query("batching_a2_committable_offsets", sql(
    f"""SELECT part_id, place // {LIMIT} AS batch_id, max(CASE WHEN is_final THEN src_offset + 1 END) AS commit_offset
        FROM placed GROUP BY 1, 2""", "placed"))
def committable_offsets(spark, sf_dir):
    """The offset each partition may commit after each batch, from the JSON frames (A2)."""
    decoded = decode.decode(inputs.raw_frames(spark, sf_dir))
    placed = batching.place_frames(batching.frame_index(decoded))
    return batching.batch_summary(placed, LIMIT).select(_long("part_id"), "batch_id", "commit_offset")


@query("batching_t1_replay_ages", sql(
    f"""SELECT part_id, batch_id, count(*) AS bars, epoch(max(fr) - min(fr))::DOUBLE AS age_seconds,
          max(fr) - min(fr) >= INTERVAL 30 MINUTE AS over_age
        FROM (SELECT part_id, place // {LIMIT} AS batch_id, min(event_ts) OVER (PARTITION BY part_id, src_offset) AS fr FROM placed)
        GROUP BY 1, 2""", "placed"))
def replay_ages(spark, sf_dir):
    """Age of each batch of a landed log and whether the time rule would have cut it."""
    placed = batching.place_frames(inputs.sized_frames(spark, sf_dir))
    return batching.replay_windows(placed, LIMIT, 1800).select(
        _long("part_id"), "batch_id", "bars", "age_seconds", "over_age"
    )


MAX_AGE = 4 * 3600
CUTS_SQL = f"""(WITH RECURSIVE
fr AS (SELECT part_id, src_offset, count(*) AS n, min(event_ts) AS got FROM bars GROUP BY 1, 2),
pl AS (SELECT *, sum(n) OVER w - n AS first, sum(n) OVER w AS next, max(got) OVER w AS clock
       FROM fr WINDOW w AS (PARTITION BY part_id ORDER BY src_offset)),
tot AS (SELECT part_id, sum(n) AS total FROM fr GROUP BY 1),
due AS (SELECT a.part_id, a.first, a.next, a.clock, min(b.first) AS late FROM pl a LEFT JOIN pl b
          ON b.part_id = a.part_id AND b.clock >= a.clock + INTERVAL {MAX_AGE} SECOND GROUP BY 1, 2, 3, 4),
walk AS (SELECT part_id, 0::BIGINT AS batch_id, 0::BIGINT AS low FROM tot
         UNION ALL
         SELECT w.part_id, w.batch_id + 1, least(w.low + {LIMIT}, coalesce(d.late, total), total)::BIGINT
         FROM walk w JOIN due d ON d.part_id = w.part_id AND w.low >= d.first AND w.low < d.next JOIN tot ON tot.part_id = w.part_id
         WHERE least(w.low + {LIMIT}, coalesce(d.late, total), total) < total),
cut AS (SELECT w.part_id, batch_id, low, coalesce(lead(low) OVER (PARTITION BY w.part_id ORDER BY batch_id), total) AS high, total
        FROM walk w JOIN tot ON tot.part_id = w.part_id)
SELECT c.part_id, batch_id, (high - low)::BIGINT AS bars, count(*) AS source_records,
       max(CASE WHEN p.next <= high THEN src_offset + 1 END) AS commit_offset, min(clock) AS opened_at, max(clock) AS filled_at,
       CASE WHEN high - low = {LIMIT} THEN 'full' WHEN high < total THEN 'age' ELSE 'open' END AS reason
FROM cut c JOIN pl p ON p.part_id = c.part_id AND p.first < high AND p.next > low GROUP BY 1, 2, low, high, total)"""


def _cut_columns(found):
    return found.select(
        _long("part_id"), "batch_id", "bars", "source_records", "commit_offset",
        *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("opened_at", "filled_at")], "reason")


@query("batching_t1_cuts", sql(f"SELECT * FROM {CUTS_SQL}", "bars"))
def replayed_cuts(spark, sf_dir):
    """The batches a bars-or-age loader cuts from the landed log, by the exact rule."""
    placed = batching.place_frames(inputs.sized_frames(spark, sf_dir))
    return _cut_columns(cuts.replay_cuts(placed, LIMIT, MAX_AGE))


@query("batching_t1_live_cuts", sql(f"SELECT * FROM {CUTS_SQL} WHERE reason <> 'open'", "bars"))
def streamed_cuts(spark, sf_dir):
    """The same batches from the live stream, landed and drained in three goes with the rest in state."""
    checkpoint_dir(spark)
    frames = inputs.sized_frames(spark, sf_dir).checkpoint()
    folder, landed = shared_path(spark, "cuts"), shared_path(spark, "frames")
    third = F.expr("ntile(3) OVER (PARTITION BY topic, part_id ORDER BY span)")
    spans = frames.select("topic", "part_id", F.floor(F.col("src_offset") / 16).alias("span")).distinct().withColumn(
        "go", third).checkpoint()
    dealt = frames.withColumn("span", F.floor(F.col("src_offset") / 16)).join(spans, ["topic", "part_id", "span"])
    for go in (1, 2, 3):
        dealt.where(F.col("go") == go).select(*frames.columns).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(frames.schema).parquet(landed)
        found = drained(live_cuts.stream_cuts(stream, LIMIT, MAX_AGE, timers=False), folder)
    return _cut_columns(found)


def _delivered(spark, sf_dir):
    """Stored bars with every tenth delivered again at a later offset."""
    bars = inputs.bars(spark, sf_dir)
    replay = bars.filter(F.col("event_id") % 10 == 0).withColumn(
        "src_offset", F.col("src_offset") + 1_000_000
    ).withColumn("received_at", F.col("received_at") + F.expr("INTERVAL 1 DAY"))
    both = bars.unionByName(replay)
    return decode.stored_bars(both, F.col("received_at"))


REPLAY_SQL = """(SELECT *, event_ts AS ingested_at FROM bars UNION ALL BY NAME
  SELECT * REPLACE (src_offset + 1000000 AS src_offset), event_ts + INTERVAL 1 DAY AS ingested_at FROM bars WHERE event_id % 10 = 0)"""


@query("views_u3_deduplicated", sql(
    f"""SELECT payload_hash, symbol, event_time_text, first_at AS ingested_at, src_offset, delivery_count FROM (
          SELECT *, ingested_at AS first_at, row_number() OVER (PARTITION BY payload_hash ORDER BY ingested_at, part_id, src_offset, pos) AS rn,
            count(*) OVER (PARTITION BY payload_hash) AS delivery_count
          FROM (SELECT *, sha256(concat_ws('|', bar_type, symbol, CAST(open AS VARCHAR), CAST(high AS VARCHAR), CAST(low AS VARCHAR),
            CAST(close AS VARCHAR), CAST(volume AS VARCHAR), event_time_text, CAST(trade_count AS VARCHAR), CAST(vwap AS VARCHAR))) AS payload_hash
            FROM {REPLAY_SQL})) WHERE rn = 1""", "bars"))
def deduplicated(spark, sf_dir):
    """Replay-safe view: first delivery of each payload and its delivery count."""
    return readviews.deduplicated(_delivered(spark, sf_dir)).select(
        "payload_hash", "symbol", "event_time_text",
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"), "src_offset", "delivery_count",
    )


BOUND_SQL = """SELECT symbol, event_time_text, open, high, low, close, volume, trade_count, vwap
FROM bars WHERE {condition} ORDER BY {order}, symbol LIMIT 500"""


def _bounded(spark, sf_dir, text_compare):
    start = datetime(2024, 1, 5, tzinfo=timezone.utc)
    view = decode.stored_bars(inputs.bars(spark, sf_dir), F.col("received_at"))
    return readviews.bounded(view, start, start + timedelta(days=20), 500, text_compare).drop(
        "ingested_at", "payload_hash"
    )


@query("views_p7_bounded", sql(BOUND_SQL.format(
    condition="event_ts >= TIMESTAMP '2024-01-05' AND event_ts < TIMESTAMP '2024-01-25'",
    order="event_ts"), "bars"))
def bounded_bars(spark, sf_dir):
    """Bounded bar query on real timestamps, ordered and limited."""
    return _bounded(spark, sf_dir, False)


@query("views_p7_bounded_text", sql(BOUND_SQL.format(
    condition="event_time_text >= '2024-01-05T00:00:00Z' AND event_time_text < '2024-01-25T00:00:00Z'",
    order="event_time_text"), "bars"))
def bounded_bars_text(spark, sf_dir):
    """The same with the stored text compared, as the wire contract implies."""
    return _bounded(spark, sf_dir, True)


@query("ingest_a19_reconcile", sql(
    """SELECT 'p' || CAST(part_id AS VARCHAR) AS query_id, src_offset // 25 AS batch_id, CAST(sum(n) AS BIGINT) AS received,
        CAST(sum(CASE src_offset % 40 WHEN 7 THEN n - 1 WHEN 9 THEN 2 * n ELSE n END) AS BIGINT) AS inserted,
        sum(n) = sum(CASE src_offset % 40 WHEN 7 THEN n - 1 WHEN 9 THEN 2 * n ELSE n END) AS balanced
       FROM (SELECT part_id, src_offset, count(*) AS n FROM bars WHERE src_offset % 50 <> 0 GROUP BY 1, 2) GROUP BY 1, 2""", "bars"))
def reconciled(spark, sf_dir):
    """Received against inserted bars per batch, where some frames were refused, some stored rows
    were lost and some frames were stored twice (A19)."""
    frames = inputs.raw_frames(spark, sf_dir).withColumn("raw", F.when(
        F.col("src_offset") % 50 == 0, F.concat("raw", F.lit("x"))).otherwise(F.col("raw")))
    batch = F.call_function("div", F.col("src_offset"), F.lit(25)).alias("batch_id")
    passed = decode.accepted(decode.decode(frames))
    ledger = passed.groupBy("part_id", batch).agg(F.sum(F.size("bars")).alias("bars"))
    rows = decode.stored_bars(decode.explode_bars(passed), F.lit(datetime(2024, 2, 1, tzinfo=timezone.utc)))
    kind = F.col("src_offset") % 40
    stored = rows.filter(~((kind == 7) & (F.col("pos") == 0))).unionByName(rows.filter(kind == 9))
    inserted = stored.groupBy("part_id", batch).agg(F.count(F.lit(1)).alias("inserted"))
    return reconcile(ledger.join(inserted, ["part_id", "batch_id"], "left").select(
        F.concat(F.lit("p"), F.col("part_id").cast("string")).alias("query_id"),
        "batch_id", "bars", F.coalesce("inserted", F.lit(0)).alias("inserted"),
    ))


@query("views_u4_uniqueness", sql(
    f"""SELECT count(*) AS row_count, count(DISTINCT id) AS distinct_count, count(*) = count(DISTINCT id) AS is_unique
        FROM (SELECT symbol || '|' || event_time_text AS id FROM {REPLAY_SQL})""", "bars"))
def stored_uniqueness(spark, sf_dir):
    """Are the event ids of stored bars unique while replays are in the table? (U4)"""
    stored = _delivered(spark, sf_dir).withColumn("id", event_id(F.col("symbol"), F.col("event_ts")))
    return readviews.uniqueness(stored, "id")
