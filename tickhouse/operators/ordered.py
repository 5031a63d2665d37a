"""Ordered scans that never put one whole key into one task.

``chunk_rows`` range-partitions by key and order, so even a key that owns a third of the table is
split into even, contiguous chunks. ``running`` then computes each running value inside its chunk
and adds what the earlier chunks of the same key contribute; that carry table has at most
``chunks + keys`` rows. Chunk numbers come from sampled range bounds, so the rows are checkpointed
once: every later branch (and every retry after a lost executor) sees the same chunks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.session import checkpoint_dir, partitions

CHUNK = "_chunk"


@dataclass(frozen=True)
class Running:
    """One running value: ``sum``, ``max``, ``min``, ``last`` (non-null) or ``previous`` (row)."""

    how: str
    value: Column

    def inside(self, rows, upto) -> Column:
        if self.how == "previous":
            return F.lag(F.struct(self.value.alias("v"))).over(rows)
        if self.how == "last":
            return F.last(self.value, ignorenulls=True).over(upto)
        return {"sum": F.sum, "max": F.max, "min": F.min}[self.how](self.value).over(upto)

    def at_end(self, position: Column) -> Column:
        if self.how == "previous":
            return F.max_by(F.struct(self.value.alias("v")), position)
        if self.how == "last":
            return F.max_by(self.value, F.when(self.value.isNotNull(), position))
        return {"sum": F.sum, "max": F.max, "min": F.min}[self.how](self.value)

    def carried(self, end: Column, before) -> Column:
        if self.how in ("previous", "last"):
            return F.last(end, ignorenulls=True).over(before)
        return {"sum": F.sum, "max": F.max, "min": F.min}[self.how](end).over(before)

    def merged(self, inside: Column, carry: Column) -> Column:
        if self.how == "previous":
            return F.coalesce(inside, carry)["v"]
        if self.how == "last":
            return F.coalesce(inside, carry)
        if self.how == "sum":
            return F.when(
                inside.isNotNull() | carry.isNotNull(),
                F.coalesce(inside, F.lit(0)) + F.coalesce(carry, F.lit(0)),
            )
        return {"max": F.greatest, "min": F.least}[self.how](inside, carry)


def chunk_rows(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], chunks: int | None = None
) -> DataFrame:
    """Split rows into contiguous chunks of (keys, order). Keys must not be null, order unique."""
    checkpoint_dir(rows.sparkSession)
    count = chunks or 2 * partitions(rows.sparkSession)
    ranged = rows.repartitionByRange(count, *keys, *order)
    return ranged.withColumn(CHUNK, F.spark_partition_id()).checkpoint()


def running(
    chunked: DataFrame, keys: Sequence[str], order: Sequence[str], **columns: Running
) -> DataFrame:
    """Add running columns to chunked rows; ``_chunk`` stays for further scans."""
    part = [CHUNK, *keys]
    rows = Window.partitionBy(*part).orderBy(*order)
    upto = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = (
        Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    position = F.struct(*order)
    inside = chunked.select(
        "*", *[c.inside(rows, upto).alias(f"_in_{name}") for name, c in columns.items()]
    )
    ends = chunked.groupBy(*part).agg(
        *[c.at_end(position).alias(f"_end_{name}") for name, c in columns.items()]
    )
    carries = ends.select(
        *part,
        *[c.carried(F.col(f"_end_{n}"), before).alias(f"_carry_{n}") for n, c in columns.items()],
    )
    return inside.join(carries, part, "left").select(
        *chunked.columns,
        *[
            c.merged(F.col(f"_in_{n}"), F.col(f"_carry_{n}")).alias(n)
            for n, c in columns.items()
        ],
    )


def scan(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], **columns: Running
) -> DataFrame:
    """Chunk, run and drop the chunk number: the one-step form."""
    return running(chunk_rows(rows, keys, order), keys, order, **columns).drop(CHUNK)
