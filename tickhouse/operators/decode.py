"""Frames to bars. Decoding and whole-frame rejection happen inside each row: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tickhouse.functions.bars import payload_hash
from tickhouse.functions.lets import once
from tickhouse.functions.numbers import whole_number
from tickhouse.functions.times import strict_instant
from tickhouse.schemas import BAR_COLUMNS, TEXT_BARS, WIRE_BARS

PRICES = ("open", "high", "low", "close", "vwap")
COUNTS = ("volume", "trade_count")
POSITION = ("topic", "part_id", "src_offset")


def _price(text: Column) -> Column:
    """A finite number; texts such as NaN, Infinity or 1d are not prices."""
    value = F.when(text.rlike(r"^\s*[-+.0-9eE]+\s*$"), text.try_cast("double"))
    return F.when(value - value == 0, value)


def _typed(bar: Column) -> Column:
    columns = []
    for name in BAR_COLUMNS:
        text = bar[name]
        if name in PRICES:
            text = _price(text)
        elif name in COUNTS:
            text = whole_number(text)
        columns.append(text.alias(name))
    return F.struct(*columns, strict_instant(bar["event_time_text"]).alias("event_ts"))


def _symbol_is_text(raw: Column, position: Column) -> Column:
    """Is the symbol at a position of the frame a JSON string? Asked only where its text looks like
    an array or object, which a string may do too."""
    path = F.concat(F.lit("$["), position.cast("string"), F.lit("].S"))
    value = F.try_variant_get(F.try_parse_json(raw), path, "variant")
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def bar_fault(bar: Column, raw: Column, position: Column) -> Column:
    """Why one parsed bar is refused, or null. Missing and mistyped members look the same."""
    missing = bar.isNull()
    for name in BAR_COLUMNS:
        missing = missing | bar[name].isNull()
    symbol = bar["symbol"]
    return (
        F.when(missing, "missing_member")
        .when(bar["bar_type"] != "b", "not_a_bar")
        .when(~symbol.rlike(r"[^\p{javaWhitespace}]"), "blank_symbol")
        .when(
            symbol.rlike(r"^[\[{]") & ~_symbol_is_text(raw, position), "blank_symbol"
        )
        .when(bar["event_ts"].isNull(), "bad_event_time")
    )


def _verdict(bars: Column) -> Column:
    faults = F.transform(bars, lambda bar, i: bar_fault(bar, F.col("raw"), i))
    first = F.get(F.filter(faults, lambda fault: fault.isNotNull()), F.lit(0))
    return F.struct(
        bars.alias("bars"),
        faults.alias("bar_faults"),
        F.when(bars.isNull(), "not_an_array").otherwise(first).alias("reject_reason"),
    )


def _only_array(raw: Column) -> Column:
    """The bars of a text that is one JSON array and nothing else; null otherwise.

    The parser stops after the first value, so the text is parsed as the first of two elements; the
    second is a mark made from the text itself. Anything after the array breaks the outer one or
    moves the mark.
    """
    mark = F.xxhash64(raw).cast("string")
    both = F.concat(F.lit("["), raw, F.lit(',[{"T":"'), mark, F.lit('"}]]'))
    # The cast renames by position: wire names T and t would be ambiguous afterwards.
    parsed = F.from_json(both, ArrayType(WIRE_BARS)).cast(ArrayType(TEXT_BARS))
    return once(parsed, lambda two: F.when(
        raw.rlike(r"^\s*\[") & (F.size(two) == 2)
        & (F.get(F.get(two, F.lit(1)), F.lit(0))["bar_type"] == mark),
        F.get(two, F.lit(0)),
    ))


def decode(frames: DataFrame) -> DataFrame:
    """Add ``bars`` (typed array, order kept), ``bar_faults`` and ``reject_reason`` to each frame.

    A frame is exactly one array; a lone object, a second value, trailing text or anything else is
    refused. One bad bar refuses its whole frame, and the reason is that of the first bad bar.
    """
    decoded = once(F.transform(_only_array(F.col("raw")), _typed), _verdict)
    return frames.withColumn("_d", decoded).select(*frames.columns, "_d.*")


def accepted(decoded: DataFrame) -> DataFrame:
    """Frames that passed. ``inline`` instead of a filter: a filter on the reason would be pushed
    below the projection and parse every frame a second time."""
    others = [c for c in decoded.columns if c not in ("bars", "bar_faults", "reject_reason")]
    passed = F.when(F.col("reject_reason").isNull(), F.array(F.struct("bars")))
    return decoded.select(*others, F.inline(passed))


def quarantine(decoded: DataFrame) -> DataFrame:
    """Refused frames with their raw text and reason; nothing is dropped."""
    return decoded.filter(F.col("reject_reason").isNotNull()).drop("bars", "bar_faults")


def require_clean(decoded: DataFrame) -> DataFrame:
    """Strict mode: the job fails on the first refused frame instead of quarantining it."""
    problem = F.concat(
        F.lit("refused frame "),
        F.concat_ws("/", *[F.col(c).cast("string") for c in POSITION]),
        F.lit(": "),
        F.col("reject_reason"),
    )
    checked = F.when(F.col("reject_reason").isNotNull(), F.raise_error(problem)).otherwise(
        F.col("bars")
    )
    return decoded.withColumn("bars", checked).drop("reject_reason", "bar_faults")


def explode_bars(frames: DataFrame) -> DataFrame:
    """One row per bar with its position in the frame and whether it is the frame's last."""
    kept = [c for c in frames.columns if c not in ("bars", "raw")]
    exploded = frames.select(
        *kept, F.size("bars").alias("frame_size"), F.posexplode("bars").alias("pos", "bar")
    )
    return exploded.select(
        *kept,
        "frame_size",
        "pos",
        (F.col("pos") == F.col("frame_size") - 1).alias("is_final"),
        "bar.*",
    )


def stored_bars(bars: DataFrame, ingested_at: Column) -> DataFrame:
    """The stored row: payload hash, the wire values, the event time and the batch's ingest time."""
    source = [c for c in (*POSITION, "pos") if c in bars.columns]
    return bars.select(
        payload_hash().alias("payload_hash"),
        *BAR_COLUMNS,
        "event_ts",
        ingested_at.alias("ingested_at"),
        *source,
    )
