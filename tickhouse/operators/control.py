"""Control messages that share the stream with data frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.schemas import CONTROL

_FIRST = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("msg", T.StringType()),
    T.StructField("code", T.LongType()),
    T.StructField("bars", T.ArrayType(T.StringType())),
])


def first_message(raw: Column) -> Column:
    """First element of the array as struct(kind, msg, code, bars); null when there is none."""
    parsed = F.from_json(raw, CONTROL).cast(T.ArrayType(_FIRST))
    return F.get(F.when(raw.rlike(r"^\s*\["), parsed), F.lit(0))


def classify(message: Column, want_type: str, want_msg: str | None = None) -> Column:
    """struct(outcome, detail) with outcome match, fatal, mismatch or malformed."""
    msg = F.coalesce(message["msg"], F.lit(""))
    kind = message["kind"]

    def outcome(name: str, detail: Column) -> Column:
        return F.struct(F.lit(name).alias("outcome"), detail.alias("detail"))

    other_type = F.concat(F.lit(f"expected T={want_type}, got T="), kind)
    result = (
        F.when(kind.isNull(), outcome("malformed", F.lit(None).cast("string")))
        .when(
            kind == "error",
            outcome("fatal", F.concat(
                F.lit("server error "),
                F.coalesce(message["code"], F.lit(-1).cast("long")).cast("string"),
                F.lit(": "), msg,
            )),
        )
        .when(kind != want_type, outcome("mismatch", other_type))
    )
    if want_msg is not None:
        other_msg = F.concat(F.lit(f"expected msg={want_msg}, got msg="), msg)
        result = result.when(msg != want_msg, outcome("mismatch", other_msg))
    return result.otherwise(outcome("match", F.lit(None).cast("string")))


def route_frames(frames: DataFrame) -> DataFrame:
    """Add ``frame_route``: bars, control or malformed, from the first element's type."""
    kind = first_message(F.col("raw"))["kind"]
    empty = F.col("raw").rlike(r"^\s*\[\s*\]\s*$")
    return frames.withColumn(
        "frame_route",
        F.when((kind == "b") | empty, "bars").when(kind.isNotNull(), "control").otherwise("malformed"),
    )
