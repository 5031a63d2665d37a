"""Near copies found, against brute force that knows nothing of fingerprints."""

from __future__ import annotations

import random

import corpus_pipeline
from cases import SF, word_list
from test_exact import components, edit_distance
from tickhouse.llm import linededup, simhash
from tickhouse.llm.common import saved


def removed(spark, pairs: list[tuple[str, str]]) -> list[bool]:
    """Whether the second of each pair of lines goes; pairs have nothing to do with each other."""
    data = [(2 * i + j, line) for i, pair in enumerate(pairs) for j, line in enumerate(pair)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    gone = {r.row.doc_id for r in linededup.dedup_lines(docs).collect() if r.removed}
    return [2 * i + 1 in gone for i in range(len(pairs))]


def test_op8_recall_of_edit_similarity(spark):
    rnd, words = random.Random(3), word_list(3, 3000)
    pairs = []
    while len(pairs) < 200:
        line = [rnd.choice(words) for _ in range(rnd.randint(5, 60))]
        other = list(line)
        for _ in range(rnd.randint(1, max(1, len(line) // 6))):
            at = rnd.randrange(len(other))
            other[at:at + rnd.randint(0, 1)] = rnd.choices(words, k=rnd.randint(0, 1))
        a, b = " ".join(line), " ".join(other)
        if a != b and len(other) >= 5 and 5 * edit_distance(a, b) <= max(len(a), len(b)):
            pairs.append((a, b))
    assert sum(removed(spark, pairs)) >= 0.97 * len(pairs)


def test_op8_long_lines_that_are_shifted(spark):
    rnd, words = random.Random(4), word_list(4, 3000)
    pairs = []
    for _ in range(5):
        line = " ".join(rnd.choices(words, k=450))
        pairs.append((line, " ".join(rnd.choices(words, k=12)) + " " + line))
        assert 5 * edit_distance(*pairs[-1]) <= len(pairs[-1][1])
    assert all(removed(spark, pairs))


def test_near_duplicates_stage_finds_jaccard(spark):
    rnd, words = random.Random(5), word_list(5, 3000)
    texts = []
    for _ in range(40):
        text = rnd.choices(words, k=rnd.randint(60, 200))
        texts.append(" ".join(text))
        for _ in range(2):
            other = list(text)
            for _ in range(rnd.randint(1, 6)):
                other[rnd.randrange(len(other))] = rnd.choice(words)
            texts.append(" ".join(other))
    sets = []
    for text in texts:
        w = text.split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)})
    groups = components(len(texts), lambda i, j: 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]))
    assert len(set(groups)) < len(texts) - 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()}
    assert kept == set(groups)


def test_op6_links_of_nodes_in_many_partitions(spark):
    """The nodes of a bucket come from several tasks. Joins by bucket are broadcast, and what was dealt by
    bucket for them is read in as many tasks as it was written by, as in larger tables."""
    rnd = random.Random(6)
    prints = []
    for _ in range(300):
        value = rnd.getrandbits(64)
        prints += [value, value ^ 1 << rnd.randrange(64), value ^ 1 << rnd.randrange(32) ^ 1 << 32 + rnd.randrange(32)]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = saved(spark.createDataFrame([(p,) for p in signed], "fp long").repartition(8))
    smallest = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(smallest, "1b")
    try:
        found = components_of(simhash.links(simhash.pivot_table(nodes)).collect())
    finally:
        spark.conf.unset(smallest)
    groups = components(len(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    assert {p: found.get(p, p) for p in signed} == {
        p: min(q for q, h in zip(signed, groups, strict=True) if h == g) for p, g in zip(signed, groups, strict=True)}


def components_of(edges: list) -> dict[int, int]:
    least = {n: n for e in edges for n in e}
    for _ in least:
        before = dict(least)
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
        if least == before:
            break
    return least
