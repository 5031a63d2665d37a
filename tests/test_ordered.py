from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickhouse.operators.ordered import Running, chunk_rows, scan


def sample(spark):
    """One key owns a third of the rows; some values are null."""
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        rows.append((key, rng.randrange(500), i, rng.choice([None, 1, 2, 3])))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, at long, seq long, v long")


def test_chunked_scan_equals_a_plain_window(spark):
    rows = sample(spark)
    plain = Window.partitionBy("k").orderBy("at", "seq")
    upto = plain.rowsBetween(Window.unboundedPreceding, 0)
    expected = rows.select(
        "*",
        F.lag("v").over(plain).alias("p"),
        F.sum("v").over(upto).alias("s"),
        F.last("v", ignorenulls=True).over(upto).alias("l"),
        F.max("v").over(upto).alias("mx"),
        F.min("v").over(upto).alias("mn"),
    )
    v = F.col("v")
    got = scan(rows, ["k"], ["at", "seq"], p=Running("previous", v), s=Running("sum", v),
               l=Running("last", v), mx=Running("max", v), mn=Running("min", v))
    assert got.columns == expected.columns
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_a_hot_key_is_split_into_even_chunks(spark):
    chunked = chunk_rows(sample(spark), ["k"], ["at", "seq"], chunks=12)
    sizes = [r["count"] for r in chunked.groupBy("_chunk").count().collect()]
    assert max(sizes) < 3000 / 12 * 2
    hot = chunked.filter("k = 'hot'").select("_chunk").distinct().count()
    assert hot >= 3


def test_global_scan_without_keys(spark):
    rows = spark.range(1000).withColumn("v", F.lit(1))
    got = scan(rows, [], ["id"], n=Running("sum", F.col("v")))
    assert got.filter("n <> id + 1").count() == 0
