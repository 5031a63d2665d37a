"""Buckets of the same nodes are one, and their rows are shuffled once."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickhouse.llm import common


def test_rows_of_buckets_are_shuffled_once(spark, monkeypatch):
    plans = []

    def kept(rows):
        rows.collect()
        plans.append(rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0])
        return rows

    monkeypatch.setattr(common, "saved", kept)
    data = spark.createDataFrame([(1, [5, 6, 7]), (2, [6, 7, 6, 5]), (3, [7, 8]), (4, [9])], "node long, buckets array<long>")
    found = common.members_of(data.select("node", F.explode("buckets").alias("bucket"))).collect()
    assert sorted(tuple(r) for r in found) == [(5, 1, 2), (5, 2, 2), (7, 1, 3), (7, 2, 3), (7, 3, 3)]
    assert "ReusedExchange" in plans[0]
