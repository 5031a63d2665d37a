"""A Merkle manifest of a table, kept as nodes labelled with the leaf ranks they cover.

Rows get their rank within a group from a range partitioning (a position inside the partition plus
what earlier partitions of the group hold), so no group passes through one task. A node covers the
ranks ``[lo, hi)``; labels nest like the tree. Nodes are made in bands of ``BAND`` levels: all base
nodes below one node of the band's top share a bucket, which holds at most ``2 ** BAND`` of them,
and a bucket's nodes of all levels come from one group. Inside buckets, a containment join of labels
gives each node its parent; what the parent covers beyond the node is the sibling's label, and a
join on that label fetches its digest. A second containment join attaches all ancestors to the base
nodes, which yields their paths. The tops of a band are the base of the next one, so a table of n
rows takes ``log2(n) / BAND`` bands, each ``2 ** BAND`` times smaller than the one below.

A digest is lowercase hex SHA-256; a parent's is that of its children's digests joined, also for a
single child; a lone node is its own root. Groups are ordered bytewise, null first, and their roots
are folded in the same way.

Null columns have a defined text in the leaf (``-``). Null ids come first within their group, equal
ids are ordered by leaf digest; repeated rows are leaves of their own. Further columns are ignored.
An empty table gives an empty manifest.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.llm.common import prepare, saved, sized

#: Levels of a band; a bucket holds 2 ** BAND base nodes.
BAND = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(*fields: Column) -> Column:
    """Each field as its UTF-8 length, a colon and its text, or a dash for null."""
    texts = [f.cast("string") for f in fields]
    return digest_of(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def group_key(group: Column) -> Column:
    """A text for every group, null included, in the order of the groups."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def ranked(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Add ``rank`` within ``key`` and ``n``, the rows of the key. The result is stored."""
    ranged = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    placed = saved(ranged.withColumn("_place", F.monotonically_increasing_id()))
    chunks = saved(placed.groupBy(key, F.shiftright("_place", 33).alias("_chunk")).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")))
    # Chunks of one key: at most as many as there are partitions, numbers only.
    every = Window.partitionBy(key)
    before = every.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = saved(chunks.select(
        key, "_chunk", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(every).alias("n")))
    return (placed.withColumn("_chunk", F.shiftright("_place", 33)).join(sized(offsets), [key, "_chunk"])
            .withColumn("rank", F.col("_place") - F.col("_first") + F.col("_before"))
            .drop("_place", "_chunk", "_first", "_before"))


def _levels(base: Column, height: Column) -> Column:
    """Digests level by level, from the base nodes of one bucket up to ``height`` levels above."""
    def parents(digests: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / 2).cast("int")),
            lambda i: digest_of(F.get(digests, 2 * i), F.coalesce(F.get(digests, 2 * i + 1), F.lit(""))))

    return F.aggregate(
        F.slice(F.array(*[F.lit(i) for i in range(BAND)]), 1, height), F.array(base),
        lambda levels, _: F.concat(levels, F.array(parents(F.element_at(levels, -1)))))


def _nodes(base: DataFrame, band: int) -> DataFrame:
    """All nodes of a band: key, bucket, level (within the band), label and digest.

    ``base`` has ``key``, ``at`` (the label's start in units of the base nodes' width), ``digest``, ``n``
    (rows of the key) and ``height`` (levels of its tree).
    """
    width = BAND * band
    grouped = base.groupBy("key", F.shiftright("at", BAND).alias("bucket")).agg(
        F.array_sort(F.collect_list(F.struct("at", "digest"))).alias("base"),
        F.min("n").alias("n"), F.min("height").alias("height"))
    steps = F.greatest(F.lit(0), F.least(F.lit(BAND), F.col("height") - width)).cast("int")
    levels = grouped.select("key", "bucket", "n", "height", F.posexplode(
        _levels(F.transform("base", lambda b: b["digest"]), steps)).alias("level", "digests"))
    nodes = levels.select("key", "bucket", "n", "height", "level",
                          F.posexplode("digests").alias("slot", "digest"))
    begin = f"shiftleft(shiftleft(bucket, {BAND}) + shiftleft(cast(slot as long), level), {width})"
    return nodes.withColumn("lo", F.expr(begin)).withColumn(
        "hi", F.expr(f"least(n, lo + shiftleft(1L, level + {width}))"))


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes below the band's top with their sibling's digest (null: none) and its side."""
    node, parent, other = nodes.alias("c"), nodes.alias("p"), nodes.alias("s")
    beyond = node.join(
        parent,
        (F.col("p.key") == F.col("c.key")) & (F.col("p.bucket") == F.col("c.bucket"))
        & (F.col("p.level") == F.col("c.level") + 1)
        & (F.col("p.lo") <= F.col("c.lo")) & (F.col("c.hi") <= F.col("p.hi")),
    ).select(
        F.col("c.key").alias("key"), F.col("c.bucket").alias("bucket"), F.col("c.level").alias("level"),
        F.col("c.lo").alias("lo"), F.col("c.hi").alias("hi"),
        (F.col("p.lo") < F.col("c.lo")).alias("left"),
        # The parent's label without the node's: before the node, or after it, or nothing.
        F.when(F.col("p.lo") < F.col("c.lo"), F.col("p.lo")).otherwise(F.col("c.hi")).alias("from"),
        F.when(F.col("p.lo") < F.col("c.lo"), F.col("c.lo")).otherwise(F.col("p.hi")).alias("upto"),
    ).alias("b")
    return beyond.join(
        other,
        (F.col("s.key") == F.col("b.key")) & (F.col("s.bucket") == F.col("b.bucket"))
        & (F.col("s.level") == F.col("b.level")) & (F.col("s.lo") == F.col("b.from"))
        & (F.col("s.hi") == F.col("b.upto")), "left",
    ).select("b.key", "b.bucket", "b.level", "b.lo", "b.hi", "b.left", F.col("s.digest").alias("sibling"))


def _paths(base: DataFrame, siblings: DataFrame, band: int, carried: list[str]) -> DataFrame:
    """Base nodes with ``path``: sibling and side of every node of the band that contains them."""
    width = BAND * band
    b = base.withColumn("bucket", F.shiftright("at", BAND)).withColumn("lo", F.shiftleft("at", width))
    rows, nodes = b.alias("b"), siblings.alias("c")
    named = ["key", "bucket", "at", *carried]
    contained = rows.join(
        nodes,
        (F.col("c.key") == F.col("b.key")) & (F.col("c.bucket") == F.col("b.bucket"))
        & (F.col("c.lo") <= F.col("b.lo")) & (F.col("b.lo") < F.col("c.hi")), "left")
    step = F.when(F.col("c.level").isNotNull(), F.struct("c.level", "c.left", "c.sibling"))
    return contained.groupBy(*[F.col(f"b.{c}").alias(c) for c in named]).agg(
        F.array_sort(F.collect_list(step)).alias("path"))


@dataclass
class Tree:
    """``leaves`` with ``root`` and ``path`` (level by level, sibling null where there is none); ``nodes``."""

    leaves: DataFrame
    nodes: DataFrame


def tree(leaves: DataFrame, carried: list[str]) -> Tree:
    """Fold stored leaves (``key``, ``rank``, ``n``, ``digest`` and carried columns) key by key."""
    height = F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)
    base = leaves.withColumn("height", height).withColumnRenamed("rank", "at")
    most = base.agg(F.max("height")).first()[0] or 0
    bands, all_nodes = [], []
    current, extra = base, ["digest", "n", *carried]
    for band in range(max(1, -(-most // BAND))):
        nodes = _nodes(current, band)
        bands.append(_paths(current, _with_siblings(nodes), band, extra))
        all_nodes.append(nodes.select("key", (F.col("level") + BAND * band).alias("level"), "lo", "hi", "digest"))
        tops = nodes.where(
            f"level = least({BAND}, greatest(0, height - {BAND * band}))").select(
            "key", F.col("bucket").alias("at"), "digest", "n", "height")
        current, extra = saved(tops), []
    roots = current.select("key", F.col("digest").alias("root"))
    above = None
    for band in reversed(range(1, len(bands))):
        own = bands[band].select("key", F.col("at").alias("bucket"), F.col("path").alias("upper"),
                                 F.col("bucket").alias("next"))
        if above is not None:
            own = own.withColumnRenamed("upper", "mine").join(
                above.withColumnRenamed("bucket", "next"), ["key", "next"]
            ).select("key", "bucket", F.concat("mine", "upper").alias("upper"))
        above = saved(own.select("key", "bucket", "upper"))
    named = bands[0]
    if above is not None:
        named = named.join(above, ["key", "bucket"]).withColumn("path", F.concat("path", "upper")).drop("upper")
    named = named.drop("bucket").withColumnRenamed("at", "rank").join(sized(roots), "key")
    return Tree(named, reduce(DataFrame.unionByName, all_nodes))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    def up(digest: Column, step: Column) -> Column:
        beside = F.coalesce(step["sibling"], F.lit(""))
        return F.when(step["left"], digest_of(beside, digest)).otherwise(digest_of(digest, beside))

    return F.aggregate(path, leaf, up)


def siblings_of(path: Column) -> Column:
    """Digests of the siblings, from the leaf's to those below the root."""
    return F.filter(F.transform(path, lambda s: s["sibling"]), lambda d: d.isNotNull())


def manifest(
    docs: DataFrame, leaf: Column, group_col: str = "lang", id_col: str = "doc_id", **carried: Column
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, carried columns, ``leaf``, ``subroot``, ``root``, ``path``."""
    prepare(docs.sparkSession)
    leaves = saved(docs.select(
        group_key(F.col(f"`{group_col}`")).alias("key"), F.col(f"`{id_col}`").alias("doc_id"),
        leaf.alias("digest"), F.monotonically_increasing_id().alias("row"),
        *[value.alias(name) for name, value in carried.items()]))
    names = ["doc_id", "row", *carried]
    groups = tree(ranked(leaves, "key", "doc_id", "digest", "row"), names).leaves
    groups = groups.withColumnRenamed("digest", "leaf").withColumnRenamed("root", "subroot")
    tops = saved(groups.select("key", "subroot").where("rank = 0"))
    under = tops.select(F.lit("").alias("key"), F.col("key").alias("group"), F.col("subroot").alias("digest"))
    whole = tree(ranked(under, "key", "group"), ["group"]).leaves
    above = saved(whole.select(F.col("group").alias("key"), "root", F.col("path").alias("upper")))
    return groups.join(sized(above), "key").select(
        "doc_id", *carried, "leaf", "subroot", "root", F.concat("path", "upper").alias("path"))
