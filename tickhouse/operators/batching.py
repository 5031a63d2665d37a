"""Bounded commit batches over arrival-ordered frames.

Everything is computed on a narrow index of frames, not on bars: a frame knows where its first bar
falls, hence which batches it touches. Offsets are unique within a partition, so a span of
``OFFSET_SPAN`` offsets bounds the rows any window group can hold, however hot the partition is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.session import checkpoint_dir

SOURCE = ("topic", "part_id")
OFFSET_SPAN = 1 << 17


def _checked(limit: int) -> int:
    if limit < 1:
        raise ValueError("a batch must hold at least one bar")
    return limit


def frame_index(decoded: DataFrame) -> DataFrame:
    """Position and size of each accepted frame, checkpointed.

    Placing frames reads the sizes twice; without the checkpoint each reading would parse the JSON
    of every frame again. The index holds a few numbers per frame and none of its payload.
    """
    checkpoint_dir(decoded.sparkSession)
    arrival = [c for c in ("received_at",) if c in decoded.columns]
    size = F.when(F.col("reject_reason").isNull(), F.size("bars")).otherwise(0)
    return decoded.select(*SOURCE, "src_offset", *arrival, size.alias("frame_size")).checkpoint()


def place_frames(frames: DataFrame, span: int = OFFSET_SPAN) -> DataFrame:
    """Add ``first_bar``: how many bars of the partition arrived before the frame.

    Needs ``topic, part_id, src_offset, frame_size``. Empty frames add no bars and are left out,
    so their offsets are never committable on their own.
    """
    sized = frames.filter(F.col("frame_size") > 0).withColumn(
        "_span", F.call_function("div", F.col("src_offset"), F.lit(span))
    )
    spans = sized.groupBy(*SOURCE, "_span").agg(F.sum("frame_size").alias("_bars"))
    earlier = (
        Window.partitionBy(*SOURCE).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = spans.select(
        *SOURCE, "_span", F.coalesce(F.sum("_bars").over(earlier), F.lit(0)).alias("_start")
    )
    inside = (
        Window.partitionBy(*SOURCE, "_span")
        .orderBy("src_offset")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = sized.withColumn("_inside", F.coalesce(F.sum("frame_size").over(inside), F.lit(0)))
    return (
        placed.join(starts, [*SOURCE, "_span"])
        .withColumn("first_bar", (F.col("_start") + F.col("_inside")).cast("long"))
        .drop("_span", "_start", "_inside")
    )


def batch_of(position: Column, limit: int) -> Column:
    # Integer division: a double would lose exactness for very long logs.
    return F.call_function("div", position, F.lit(_checked(limit)))


def assign_bars(placed_bars: DataFrame, limit: int = 100) -> DataFrame:
    """Batch number of each exploded bar; needs ``first_bar`` and ``pos``."""
    return placed_bars.withColumn(
        "batch_id", batch_of(F.col("first_bar") + F.col("pos"), limit)
    )


def batched_bars(bars: DataFrame, limit: int = 100, span: int = OFFSET_SPAN) -> DataFrame:
    """Batch number of each exploded bar, straight from the bars.

    Bars are stored once and exchanged once by span of offsets, where a window counts them; only the
    bars per span are added up and joined, a row per 131,072 offsets. Frames are parsed one time.
    """
    checkpoint_dir(bars.sparkSession)
    spanned = bars.withColumn(
        "_span", F.call_function("div", F.col("src_offset"), F.lit(span))).checkpoint()
    earlier = (
        Window.partitionBy(*SOURCE).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = spanned.groupBy(*SOURCE, "_span").agg(F.count(F.lit(1)).alias("_bars")).select(
        *SOURCE, "_span", F.coalesce(F.sum("_bars").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*SOURCE, "_span").orderBy("src_offset", "pos")
    counted = spanned.withColumn("_inside", F.row_number().over(inside) - 1)
    return counted.join(starts, [*SOURCE, "_span"]).withColumn(
        "batch_id", batch_of(F.col("_start") + F.col("_inside"), limit)
    ).drop("_span", "_start", "_inside")


def frame_pieces(placed: DataFrame, limit: int = 100) -> DataFrame:
    """One row per (frame, batch it touches): bars in that piece and whether it ends the frame."""
    first, size = F.col("first_bar"), F.col("frame_size")
    last_batch = batch_of(first + size - 1, limit)
    touched = placed.withColumn(
        "batch_id", F.explode(F.sequence(batch_of(first, limit), last_batch))
    )
    lower = F.greatest(first, F.col("batch_id") * limit)
    upper = F.least(first + size, (F.col("batch_id") + 1) * limit)
    return touched.withColumn("piece_bars", (upper - lower).cast("long")).withColumn(
        "ends_frame", F.col("batch_id") == last_batch
    )


def batch_summary(placed: DataFrame, limit: int = 100) -> DataFrame:
    """Per batch: bars, distinct source records, committable offset and the partial-batch flag.

    ``commit_offset`` is one past the newest source record fully contained in the batch, or null
    when the batch holds only a middle piece of a large frame. With ``received_at`` present the
    arrival span of the batch is reported too.
    """
    pieces = frame_pieces(placed, limit)
    measures = [
        F.sum("piece_bars").alias("bars"),
        F.count(F.lit(1)).alias("source_records"),
        F.max(F.when(F.col("ends_frame"), F.col("src_offset") + 1)).alias("commit_offset"),
    ]
    timed = "received_at" in placed.columns
    if timed:
        measures += [F.min("received_at").alias("opened_at"), F.max("received_at").alias("filled_at")]
    summary = pieces.groupBy(*SOURCE, "batch_id").agg(*measures)
    return summary.withColumn("is_partial", F.col("bars") < limit)


def replay_windows(placed: DataFrame, limit: int = 100, max_age_seconds: int = 300) -> DataFrame:
    """Batches of a landed log with their age and whether the time rule would have cut them.

    The age starts at the batch's first bar, so idle time before it never counts.
    """
    micros = F.unix_micros("filled_at") - F.unix_micros("opened_at")
    return (
        batch_summary(placed, limit)
        .withColumn("age_seconds", micros / F.lit(1_000_000.0))
        .withColumn("over_age", micros >= max_age_seconds * 1_000_000)
    )
