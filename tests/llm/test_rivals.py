"""What suffix deduplication need not compare."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from cases import word_list
from tickhouse.llm import suffixdedup


def test_op1_compares_only_what_agrees_beside_the_anchor(spark):
    """A phrase of all texts is the anchor of many segments; two of them agree for more than it."""
    rnd, words = random.Random(2), word_list(2, 3000)
    phrase = "this very common phrase has forty bytes."
    texts = [" ".join(rnd.choices(words, k=40)) + phrase + " ".join(rnd.choices(words, k=40)) for _ in range(400)]
    middle = texts[0].index(phrase)
    texts.append(" ".join(rnd.choices(words, k=40)) + texts[0][middle - 90:middle + 120] + "other end " * 20)
    docs = spark.createDataFrame(list(enumerate(texts)), "at long, text string").select(
        F.lit(0).cast("long").alias("file"), "at", F.col("text").cast("binary").alias("text"))
    shared = suffixdedup.shared_segments(suffixdedup.segments(docs)).where("chosen AND distinct > 1")
    left = suffixdedup.rivals(shared).collect()
    assert shared.count() > 50
    assert 2 <= len(left) < 20 and {r["at"] for r in left} >= {0, 400}
    hit = {r["at"] for r in suffixdedup.repeats(docs).collect()}
    assert hit == {0, 400}


def test_op1_counts_crowded_anchors_without_a_join(spark):
    cut = spark.createDataFrame(
        [(1, 1, 2, 1, 9, b"x" + b"a" * 200), (1, 2, 1, 1, 9, b"a" * 200), (1, 3, 1, 1, 9, b"b" * 200)],
        "anchor long, digest long, windows int, copies long, distinct long, bytes binary")
    counted = suffixdedup._counted(cut, 200)
    assert "Join" not in counted._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.digest, bytes(r.marks)) for r in counted.collect()} == {(1, b"\x40"), (2, b"\x80")}
