"""SimHash near-duplicates found through pivot distance tables.

Documents get 64-bit fingerprints; equal fingerprints are one node. The table of pivot distances
holds each node's Hamming distance to ``PIVOTS`` reference fingerprints. Two nodes within ``radius``
differ by at most ``radius`` in every coordinate (triangle inequality), so pairs are discarded by
their largest coordinate difference and only survivors are compared bit by bit.

So that no more than a neighbourhood is looked at, nodes meet in buckets that agree on two of four
16-bit blocks: two fingerprints within two bits always share one. Inside a bucket, nodes are sorted
by the first coordinate and paired only within ``radius`` of it. A bucket of more than ``BUCKET``
nodes is split by agreement on a further third of the remaining bits, and again, which any two
linked nodes also satisfy for one of the three thirds; after the second split the prints of a
bucket differ in 14 to 16 bits at most, so it has at most 2 ** 16 nodes. What a bucket returns is a
spanning forest of its links, not its pairs.

Null and empty texts have fingerprint zero and link like any other. Repeated rows are copies. A null
id never becomes a component id unless all ids of the component are null. Further columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.llm.common import by_batch, prepare, saved, sized, stored, texts_of
from tickhouse.llm.components import connected_components

SHINGLE = 3
SEED = 42
RADIUS = 2
PIVOTS = 16
BUCKET = 4096
#: Pairs that are held at once while a bucket is compared.
PAIRS = 1 << 20


def _bits(digests: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(digests), 1 << 16):
        part = digests[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(2 * ones > len(digests)))


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint of a text as an unsigned number."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    return _bits(np.fromiter(
        (digest(joined[a:b], SEED)
         for a, b in zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist(),
                         strict=True)),
        np.uint64, len(words) - width + 1,
    ))


def fingerprints(rows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Replace ``text`` by ``fp``, the fingerprint as a signed long."""
    kept = [c for c in rows.columns if c != "text"]

    def step(batch: pa.RecordBatch) -> dict:
        values = np.array([fingerprint(t, shingle) for t in texts_of(batch)], np.uint64)
        return {c: batch.column(c) for c in kept} | {"fp": values.view(np.int64)}

    schema = rows.select(*kept, F.lit(0).cast("long").alias("fp")).schema
    return by_batch(rows, schema, step)


def pivots(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: digests of their own numbers."""
    return np.array([xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(count)], np.uint64)


def pivot_table(nodes: DataFrame, count: int = PIVOTS) -> DataFrame:
    """Add ``pivots``, the Hamming distances of ``fp`` to the reference fingerprints."""
    distances = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(int(p)))).cast("tinyint")
                 for p in pivots(count).view(np.int64)]
    return nodes.withColumn("pivots", F.array(*distances))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _levels() -> list[dict[int, list[int]]]:
    """Masks that buckets agree on: the six first ones, and the three refinements of each."""
    blocks = [0xFFFF << (16 * i) for i in range(4)]
    first = [a | b for i, a in enumerate(blocks) for b in blocks[i + 1:]]
    levels = [{0: first}]
    for _ in range(2):
        parents = [m for masks in levels[-1].values() for m in masks]
        levels.append({m: [m | third for third in _thirds(m)] for m in parents})
    return levels


def _thirds(mask: int) -> list[int]:
    free = [1 << i for i in range(64) if not mask >> i & 1]
    size = -(-len(free) // 3)
    return [reduce(int.__or__, free[k:k + size]) for k in range(0, len(free), size)]


def _linked(fp: np.ndarray, table: np.ndarray, group: np.ndarray, radius: int) -> tuple:
    """A spanning forest of the links within groups."""
    key = group * 256 + table[:, 0]
    order = np.argsort(key, kind="stable")
    fp, table, key = fp[order], table[order], key[order]
    last = np.searchsorted(key, key + radius, side="right")
    counts = last - np.arange(len(fp)) - 1
    label = np.arange(len(fp))
    edge_at = 0
    total = np.cumsum(counts)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while edge_at < len(fp):
        stop = max(edge_at + 1, int(np.searchsorted(
            total, (total[edge_at - 1] if edge_at else 0) + PAIRS, side="right")))
        own = counts[edge_at:stop]
        left = np.repeat(np.arange(edge_at, stop), own)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(own) - own, own)
        for p in range(1, table.shape[1]):
            near = np.abs(table[left, p] - table[right, p]) <= radius
            left, right = left[near], right[near]
        near = np.bitwise_count(fp[left] ^ fp[right]) <= radius
        found.append((left[near], right[near]))
        edge_at = stop
        if sum(len(a) for a, _ in found) > PAIRS:
            found = [_forest(label, found)]
    left, right = _forest(label, found)
    return fp[left], fp[right]


def _forest(label: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> tuple:
    """Links of each node to the smallest node it reaches; the same components, fewer links."""
    left = np.concatenate([a for a, _ in found])
    right = np.concatenate([b for _, b in found])
    label = label.copy()
    while True:
        before = label.copy()
        least = np.minimum(label[left], label[right])
        np.minimum.at(label, left, least)
        np.minimum.at(label, right, least)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(len(label)))
    return moved, label[moved]


def _compare(buckets: DataFrame, radius: int) -> DataFrame:
    """Links within stored buckets: rows arrive sorted by bucket, and whole buckets are compared.

    They are stored because the exchange of a join by bucket would stand for the one asked for here, and
    adaptive execution may read that one by its writers, which takes buckets apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(fp, table, group):
            a, b = _linked(fp, table, group, radius)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = [batch.column(n).to_numpy() for n in ("mask", "value", "fp")]
            flat = batch.column("pivots")
            table = flat.flatten().to_numpy().astype(np.int16).reshape(batch.num_rows, -1)
            parts.append(table)
            if rest is not None:
                parts = [np.concatenate(x) for x in zip(rest, parts, strict=True)]
            mask, value, fp, table = parts
            new = np.concatenate([[True], (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])])
            cut = int(np.flatnonzero(new)[-1])
            if cut:
                yield out(fp[:cut].view(np.uint64), table[:cut], np.cumsum(new[:cut]))
            rest = [x[cut:] for x in parts]
        if rest is not None:
            yield out(rest[2].view(np.uint64), rest[3], np.zeros(len(rest[2]), np.int64))

    ordered = buckets.repartition("mask", "value").sortWithinPartitions("mask", "value")
    return ordered.mapInArrow(run, "a long, b long")


def links(nodes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Edges whose components are those of all pairs of ``fp`` within ``radius`` bits."""
    if not 0 <= radius <= 2:
        raise ValueError("two of four blocks agree only up to a radius of 2")
    prepare(nodes.sparkSession)
    edges, current = None, None
    for level in _levels():
        children = F.create_map(*[
            x for parent, masks in level.items()
            for x in (F.lit(_signed(parent)), F.array(*[F.lit(_signed(m)) for m in masks]))
        ])
        rows = nodes if current is None else current
        parent = F.lit(0).cast("long") if current is None else F.col("mask")
        split = rows.select("fp", "pivots", F.explode(children[parent]).alias("mask")).withColumn(
            "value", F.col("fp").bitwiseAND(F.col("mask")))
        if current is not None:
            split = split.distinct()
        sizes = saved(split.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        members = saved(split.join(sizes, ["mask", "value"]))
        last = level is _LEVELS[-1]
        found = _compare(members if last else members.where(F.col("n") <= bucket), radius)
        edges = found if edges is None else edges.union(found)
        if last or not sizes.where(F.col("n") > bucket).limit(1).count():
            break
        current = members.where(F.col("n") > bucket).select("fp", "pivots", "mask")
    return edges


_LEVELS = _levels()


def classes(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``fp`` and ``component``, the smallest ``doc_id`` reachable, for stored fingerprints."""
    nodes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    edges = links(pivot_table(nodes.select("fp")), radius, bucket)
    labels = connected_components(edges).select(F.col("node").alias("fp"), "component")
    named = nodes.join(labels, "fp", "left").withColumn("label", F.coalesce("component", "fp"))
    least = saved(named.groupBy("label").agg(F.min("least").alias("component")))
    return saved(named.select("fp", "label").join(least, "label").select("fp", "component"))


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS
) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` and ``component_id``."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    prints = saved(fingerprints(rows))
    known = classes(prints, radius)
    return prints.join(sized(known), "fp").select(
        "doc_id", hexadecimal(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS,
    shingle: int = SHINGLE,
) -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns.

    The rows are stored with a number of their own, so that repeated rows and ids stay apart.
    """
    prepare(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("doc_id"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{text_col}`").alias("text"),
    )
    whole = stored(fingerprints(rows, shingle), "simhash")
    prints = whole.select("rid", "doc_id", "fp")
    known = classes(prints.select("doc_id", "fp"), radius)
    placed = saved(prints.join(sized(known), "fp").select("rid", "doc_id", "component", "fp"))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("rid"))
    least = saved(placed.groupBy("component").agg(F.min(order).alias("first"))
                  .select(F.col("first.rid").alias("rid")))
    return whole.join(sized(least), "rid", "left_semi").select("row.*")
