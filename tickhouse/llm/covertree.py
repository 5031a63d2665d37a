"""Embedding near-duplicates by cover trees and a dual traversal.

Vectors of one label are compared as unit vectors; cosine ``c`` is distance ``sqrt(2 - 2c)``. Equal
vectors are one node with a weight. A tree has nested levels with halving radii: the centres of a node
of radius ``R`` are some of its points, more than ``R / 2`` apart, and a point belongs to its nearest
centre. Every node keeps the radius that its points really need, so the bounds hold whatever the
centres are.

Upper levels are made in Spark: while a node holds more than a block of points, ``CENTRES`` of them
(those of least hash) are thinned to the largest radius of the ladder 2, 1, 1/2 ... that keeps half of
them apart, and its points are dealt to the nearest centre; copies of the centres go to every share of a
node that was dealt over several tasks. A node that such a step hardly divides (points that differ by
rounding only) is cut evenly by hash. Pairs of nodes are followed from the roots down, level by level,
and dropped where the distance of their centres exceeds both radii and the threshold distance.

Blocks get their lower levels in their task: a node is split as above, points that no centre covers
are tried again with new centres, and where centres stop gathering points the rest stays loose under its
parent. The dual traversal of two trees drops node pairs too far apart, accepts pairs that are close as
a whole, and compares the points of pairs of leaves by matrix products. It returns for each point
the weight of its links and a spanning forest of the links, never all pairs; ``pairs`` lists them where
they are wanted.

Links need equal, non-null labels and equal dimension. Vectors that are null, zero, or hold null or
non-finite components link with nothing: no links, their own component, kept. Repeated rows and ids are
copies that link. A null id is never a component's id unless it has no other. Further columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.llm.common import by_batch, prepare, saved, sized
from tickhouse.llm.components import connected_components

COSINE = 0.98
#: Components of the vectors of one block: 65,536 vectors of 64.
BLOCK = 1 << 22
CENTRES = 64
LEAF = 64
#: Cosines that are held at once.
TILE = 1 << 21
#: Rounding of distances near zero, where 2 - 2c loses half its digits.
SLACK = 1e-6
LINKS = "kind string, a long, b long, n long, cosine double, node string, centre array<double>"


def _unit(raw: np.ndarray) -> np.ndarray:
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ y.T), 0))


def _apart(distances: np.ndarray, radius: float) -> np.ndarray:
    """Greedy choice of points that are more than ``radius`` from those chosen before."""
    chosen: list[int] = []
    near = np.zeros(len(distances), bool)
    for i in range(len(distances)):
        if not near[i]:
            chosen.append(i)
            near |= distances[i] <= radius
    return np.array(chosen)


def _thinned(points: np.ndarray) -> tuple[np.ndarray, float]:
    """Centres among candidates: the largest radius of the ladder that keeps half of them."""
    distances = _distances(points, points)
    radius = 1.0
    while True:
        chosen = _apart(distances, radius)
        if 2 * len(chosen) >= len(points) or radius < SLACK:
            return chosen, radius
        radius /= 2


class Block:
    """The points of a block in the order of their tree, and the nodes of the tree as columns.

    A node covers the points ``[lo, hi)`` within ``radius`` of ``centre``; its children are the nodes
    ``[first, first + count)``, none for a leaf.
    """

    def __init__(self, ids: np.ndarray, weights: np.ndarray, points: np.ndarray):
        self.order = np.arange(len(ids))
        self.points = points
        self.nodes: list[list] = []
        self._grow(0, len(ids), 0)
        self.ids, self.weights, self.points = ids[self.order], weights[self.order], points[self.order]
        self.centre, self.lo, self.hi, self.first, self.count = (
            np.array([n[k] for n in self.nodes], np.int64) for k in range(5))
        self.radius = np.array([n[5] for n in self.nodes])
        self.centres = points[self.centre]

    def _add(self, centre: int, lo: int, hi: int) -> int:
        self.nodes.append([centre, lo, hi, 0, 0, 0.0])
        self._centre(len(self.nodes) - 1, centre)
        return len(self.nodes) - 1

    def _centre(self, at: int, centre: int) -> None:
        _, lo, hi = self.nodes[at][:3]
        far = _distances(self.points[centre][None], self.points[self.order[lo:hi]]).max() if hi - lo > 1 else 0.0
        self.nodes[at][0], self.nodes[at][5] = centre, float(far)

    def _grow(self, lo: int, hi: int, centre: int) -> None:
        todo = [self._add(centre, lo, hi)]
        while todo:
            at = todo.pop()
            lo, hi = self.nodes[at][1:3]
            groups = [(self.nodes[at][0], self.order[lo:hi])]
            while len(groups) == 1 and hi - lo > LEAF and self.nodes[at][5] > SLACK:
                if self.nodes[at][0] != groups[0][0]:
                    self._centre(at, groups[0][0])
                half = 2.0 ** (np.ceil(np.log2(self.nodes[at][5])) - 1)
                groups = self._children(lo, hi, self.nodes[at][0], half)
            if len(groups) < 2:
                continue
            self.order[lo:hi] = np.concatenate([members for _, members in groups])
            self.nodes[at][3:5] = [len(self.nodes), len(groups)]
            begin = lo
            for own, members in groups:
                todo.append(self._add(own, begin, begin + len(members)))
                begin += len(members)

    def _children(self, lo: int, hi: int, centre: int, radius: float) -> list[tuple[int, np.ndarray]]:
        """Centres more than ``radius`` apart with the points they cover; uncovered ones last."""
        rest = self.order[lo:hi].copy()
        groups: list[tuple[int, np.ndarray]] = []
        first = True
        while len(rest):
            tried = rest[np.linspace(0, len(rest) - 1, min(CENTRES, len(rest))).astype(np.int64)]
            if first and (rest == centre).any():
                tried = np.r_[centre, tried[tried != centre]]
            first = False
            tried = tried[_apart(_distances(self.points[tried], self.points[tried]), radius)]
            distances = _distances(self.points[rest], self.points[tried])
            nearest = distances.argmin(axis=1)
            covered = distances[np.arange(len(rest)), nearest] <= radius
            size = np.bincount(nearest[covered], minlength=len(tried))
            gathers = size >= 8
            taken = covered & gathers[nearest]
            if taken.sum() < 2 * len(tried):
                break
            for c in np.flatnonzero(gathers):
                groups.append((int(tried[c]), rest[taken & (nearest == c)]))
            rest = rest[~taken]
        if len(rest) and groups:
            groups.append((int(rest[0]), rest))
        return groups


def _leaf_tiles(a: Block, b: Block, left: np.ndarray, right: np.ndarray) -> Iterator[tuple]:
    """Places of points of pairs of leaves: one leaf (or part of it) against those it meets."""
    if not len(left):
        return
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    starts = np.flatnonzero(np.diff(left, prepend=-1))
    for begin, end in zip(starts, np.r_[starts[1:], len(left)], strict=True):
        lo, hi = int(a.lo[left[begin]]), int(a.hi[left[begin]])
        others = [np.arange(b.lo[r], b.hi[r]) for r in right[begin:end]]
        cols = np.concatenate(others)
        wide = max(1, TILE // max(1, min(hi - lo, 512)))
        for row in range(lo, hi, 512):
            # Within one block a pair is compared once: from its earlier place.
            met = cols[cols > row] if a is b else cols
            for col in range(0, len(met), wide):
                yield np.arange(row, min(hi, row + 512)), met[col:col + wide]


class Links:
    """What a traversal finds: link weights per point of both blocks and a forest of the links."""

    def __init__(self, a: Block, b: Block, listed: bool):
        self.a, self.b, self.same = a, b, a is b
        self.counts = [np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)]
        self.shift = 0 if self.same else len(a.ids)
        self.label = np.arange(len(a.ids) + (0 if self.same else len(b.ids)))
        self.listed: list[tuple] | None = [] if listed else None

    def _join(self, x: np.ndarray, y: np.ndarray) -> None:
        """Let the linked points share the smallest place that they reach."""
        label = self.label
        while True:
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
            p, q = label[x], label[y]
            if (p == q).all():
                break
            low, high = np.minimum(p, q), np.maximum(p, q)
            np.minimum.at(label, high, low)
        self.label = label

    def near(self, rows: np.ndarray, cols: np.ndarray, cosine: float) -> None:
        """Compare points; within one block a pair is met once, from its earlier place."""
        sims = self.a.points[rows] @ self.b.points[cols].T
        x, y = np.nonzero(sims >= cosine)
        sims = sims[x, y]
        x, y = rows[x], cols[y]
        if self.same:
            later = x < y
            x, y, sims = x[later], y[later], sims[later]
        if len(x):
            self._count(x, y)
            self._join(x, y + self.shift)
            if self.listed is not None:
                self.listed.append((self.a.ids[x], self.b.ids[y], sims))

    def _count(self, x: np.ndarray, y: np.ndarray) -> None:
        self.counts[0] += np.bincount(x, self.b.weights[y], len(self.counts[0])).astype(np.int64)
        self.counts[1] += np.bincount(y, self.a.weights[x], len(self.counts[1])).astype(np.int64)

    def whole(self, i: int, j: int) -> None:
        """Two nodes (or one and itself) of which all points link."""
        a, b = slice(self.a.lo[i], self.a.hi[i]), slice(self.b.lo[j], self.b.hi[j])
        own = self.same and i == j
        self.counts[0][a] += int(self.b.weights[b].sum())
        if own:
            self.counts[0][a] -= self.a.weights[a]
        else:
            self.counts[1][b] += int(self.a.weights[a].sum())
        x, y = np.arange(a.start, a.stop), np.arange(b.start, b.stop) + self.shift
        self._join(np.r_[x, np.full(len(y), x[0])], np.r_[np.full(len(x), y[0]), y])

    def columns(self) -> dict:
        """Rows of counts, forest edges and, if wanted, pairs."""
        ids = [self.a.ids] if self.same else [self.a.ids, self.b.ids]
        counts = [self.counts[0] + self.counts[1]] if self.same else self.counts
        ids, counts = np.concatenate(ids), np.concatenate(counts)
        linked = np.flatnonzero(counts)
        moved = np.flatnonzero(self.label != np.arange(len(self.label)))
        sets = [("links", ids[linked], np.full(len(linked), -1), counts[linked], np.zeros(len(linked))),
                ("edge", ids[moved], ids[self.label[moved]], np.zeros(len(moved), np.int64), np.zeros(len(moved)))]
        for x, y, sims in self.listed or []:
            sets.append(("pair", np.minimum(x, y), np.maximum(x, y), np.zeros(len(x), np.int64), sims))
        return {
            "kind": np.concatenate([np.full(len(s[1]), s[0], object) for s in sets]),
            **{name: np.concatenate([s[k] for s in sets]) for k, name in enumerate(("a", "b", "n", "cosine"), 1)},
        }


def traverse(a: Block, b: Block, cosine: float, listed: bool = False) -> Links:
    """Dual traversal of two trees, or of a tree with itself."""
    reach = np.sqrt(max(2 - 2 * cosine, 0.0))
    links = Links(a, b, listed)
    left, right = np.zeros(1, np.int64), np.zeros(1, np.int64)
    leaves: list[tuple[np.ndarray, np.ndarray]] = []
    while len(left):
        nearer = []
        for at in range(0, len(left), TILE // 64):
            i, j = left[at:at + TILE // 64], right[at:at + TILE // 64]
            dots = np.einsum("ij,ij->i", a.centres[i], b.centres[j])
            nearer.append(np.sqrt(np.maximum(2 - 2 * dots, 0)))
        distance = np.concatenate(nearer)
        span = a.radius[left] + b.radius[right]
        # A node with itself: any two of its points are within twice its radius.
        own = (left == right) & links.same
        close = ~own & (distance + span + SLACK <= reach) | own & (span + SLACK <= reach)
        if listed:
            close[:] = False
        for i, j in zip(left[close].tolist(), right[close].tolist(), strict=True):
            links.whole(i, j)
        open_ = ~close & (distance <= reach + span + SLACK)
        left, right, own = left[open_], right[open_], own[open_]
        flat = (a.count[left] == 0) & (b.count[right] == 0)
        leaves.append((left[flat], right[flat]))
        left, right, own = left[~flat], right[~flat], own[~flat]
        # Split the side with the larger radius, a node with itself on both sides.
        by_left = (a.count[left] > 0) & ((b.count[right] == 0) | (a.radius[left] >= b.radius[right])) & ~own
        by_right = ~by_left & ~own
        nxt = []
        for chosen, grown, side, other in ((by_left, a, left, right), (by_right, b, right, left)):
            counts = grown.count[side[chosen]]
            kids = np.repeat(grown.first[side[chosen]], counts) + _within(counts)
            rest = np.repeat(other[chosen], counts)
            nxt.append((kids, rest) if side is left else (rest, kids))
        for i in left[own].tolist():
            kids = np.arange(a.first[i], a.first[i] + a.count[i])
            x, y = np.triu_indices(len(kids))
            nxt.append((kids[x], kids[y]))
        left = np.concatenate([x for x, _ in nxt]).astype(np.int64)
        right = np.concatenate([y for _, y in nxt]).astype(np.int64)
    if leaves:
        i, j = (np.concatenate(x) for x in zip(*leaves, strict=True))
        if links.same:
            swap = a.lo[i] > a.lo[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
        for rows, cols in _leaf_tiles(a, b, i, j):
            links.near(rows, cols, cosine)
    return links


def _within(counts: np.ndarray) -> np.ndarray:
    """0 .. count - 1 for each count."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id``, ``label``, ``rid``; and for vectors that can link their digest, size and values."""
    rows = vectors.select(
        F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("vec_id"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))

    def step(batch: pa.RecordBatch) -> dict:
        flat, lists = batch.column("vector").flatten(), batch.column("vector")
        starts = np.r_[0, np.cumsum(np.array([0 if n is None else n for n in pc.list_value_length(lists).to_pylist()], np.int64))]
        values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
        nulls = batch.column("label").is_null().to_pylist()
        keys, sizes, blobs = [], [], []
        for i, no_label in enumerate(nulls):
            own = values[starts[i]:starts[i + 1]] + 0.0  # no negative zero
            if no_label or not len(own) or not np.isfinite(own).all() or not own.any():
                keys.append(None), sizes.append(None), blobs.append(None)
                continue
            raw = own.astype("<f8").tobytes()
            with np.errstate(over="ignore"):
                narrow = own.astype("<f4")
            keys.append(hashlib.blake2b(raw, digest_size=16).digest())
            sizes.append(len(own))
            blobs.append(narrow.tobytes() if (narrow == own).all() else raw)
        return {"rid": batch.column("rid"), "vec_id": batch.column("vec_id"), "label": batch.column("label"),
                "digest": pa.array(keys, pa.binary()), "size": pa.array(sizes, pa.int32()),
                "blob": pa.array(blobs, pa.binary())}

    schema = rows.select("rid", "vec_id", "label", F.lit(None).cast("binary").alias("digest"),
                         F.lit(None).cast("int").alias("size"), F.lit(None).cast("binary").alias("blob")).schema
    return by_batch(rows, schema, step)


def _points(blobs: list[bytes], size: int) -> np.ndarray:
    return _unit(np.stack([np.frombuffer(b, "<f4" if len(b) == 4 * size else "<f8").astype(np.float64)
                           for b in blobs]))


def _grouped(rows: DataFrame, keys: list[str], schema: str, work) -> DataFrame:
    """Call ``work(key, columns)`` for each group of rows; groups are bounded and arrive sorted."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {n: [] for n in names}
        for batch in batches:
            columns = {n: batch.column(n).to_pylist() for n in names}
            for i, own in enumerate(zip(*[columns[k] for k in keys], strict=True)):
                if own != key:
                    if key is not None:
                        yield from work(key, held)
                    key, held = own, {n: [] for n in names}
                for n in names:
                    held[n].append(columns[n][i])
        if key is not None:
            yield from work(key, held)

    order = [*keys, *[n for n in ("side", "node") if n in names and n not in keys]]
    return rows.repartition(*keys).sortWithinPartitions(*order).mapInArrow(run, schema)


ARROW = {"string": pa.string(), "long": pa.int64(), "double": pa.float64(), "int": pa.int32(),
         "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}


def _batch(columns: dict, schema: str) -> pa.RecordBatch:
    """The columns of a schema; those that are not given are null."""
    fields = [field.strip().split(" ") for field in schema.split(",")]
    rows = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[n], ARROW[k]) if n in columns else pa.nulls(rows, ARROW[k]) for n, k in fields],
        names=[n for n, _ in fields])


def _share(size_col: str, block: int) -> Column:
    """Points that a block of this dimension holds."""
    return F.greatest(F.lit(16), F.floor(F.lit(block) / F.col(size_col)))


DEALT = "rid long, weight long, label string, size int, blob binary, node string, own string, distance double"


def _split(points: DataFrame, sizes: DataFrame) -> DataFrame:
    """Deal the points of crowded nodes to their nearest centres; returns them with ``own``, the child.

    The candidates are the points of least hash of each node; a window with a constant bound, which
    Spark applies before the shuffle.
    """
    crowded = points.join(sized(sizes.select("node", "shares")), "node")
    order = Window.partitionBy("node").orderBy(F.xxhash64("rid"), "rid")
    tried = (crowded.withColumn("place", F.row_number().over(order)).where(F.col("place") <= CENTRES)
             .select("node", "shares", "size", "place", "blob"))
    shares = crowded.withColumn("share", F.pmod(F.xxhash64(F.lit(1), "rid"), F.col("shares")))
    sent = tried.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))
    rows = sent.select("node", "share", F.lit(0).alias("side"), "place", F.lit(0).cast("long").alias("rid"),
                       F.lit(0).cast("long").alias("weight"), F.lit("").alias("label"), "size", "blob").unionByName(
        shares.select("node", "share", F.lit(1).alias("side"), F.lit(0).alias("place"), "rid", "weight", "label",
                      "size", "blob"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, blobs, centres, chosen = None, [], None, None
        for batch in batches:
            c = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            cuts = [0, *[i for i in range(1, batch.num_rows)
                         if (c["node"][i], c["share"][i], c["side"][i])
                         != (c["node"][i - 1], c["share"][i - 1], c["side"][i - 1])], batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                own = (c["node"][lo], c["share"][lo])
                if own != key:
                    key, blobs, centres = own, [], None
                if c["side"][lo] == 0:
                    blobs += c["blob"][lo:hi]
                    continue
                if centres is None:
                    found = _points(blobs, c["size"][lo])
                    chosen = _thinned(found)[0]
                    centres = found[chosen]
                far = _distances(_points(c["blob"][lo:hi], c["size"][lo]), centres)
                near = far.argmin(axis=1)
                yield _batch({
                    **{n: c[n][lo:hi] for n in ("rid", "weight", "label", "size", "blob", "node")},
                    "own": [f"{key[0]}/{chosen[k]}" for k in near],
                    "distance": far[np.arange(hi - lo), near],
                }, DEALT)

    ordered = rows.repartition("node", "share").sortWithinPartitions("node", "share", "side", "place")
    return ordered.mapInArrow(run, DEALT)


def _blocks(nodes: DataFrame, block: int) -> DataFrame:
    """Stored nodes with ``node``, the path of the block that each belongs to."""
    current = nodes.withColumn("node", F.concat_ws("/", F.hex(F.encode("label", "utf-8")), "size"))
    settled = None
    while True:
        sizes = current.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("size"))
        sizes = sizes.withColumn("shares", F.ceil(F.col("n") / _share("size", block)).cast("long"))
        sizes = saved(sizes.select("node", "n", "shares"))
        if not sizes.where("shares > 1").limit(1).count():
            return current if settled is None else settled.unionByName(current)
        fine = current.join(sized(sizes.where("shares = 1").select("node")), "node", "left_semi")
        settled = fine if settled is None else settled.unionByName(fine)
        crowded = sizes.where("shares > 1")
        dealt = saved(_split(current, crowded).drop("distance"))
        # A child with most of its parent's points is cut evenly.
        children = dealt.groupBy("node", "own").agg(F.count(F.lit(1)).alias("m"))
        stuck = children.join(crowded, "node").where("4 * m > 3 * n").select("own", "shares")
        current = saved(dealt.join(sized(saved(stuck)), "own", "left").select(
            "rid", "weight", "label", "size", "blob",
            F.when(F.col("shares").isNull(), F.col("own")).otherwise(
                F.concat("own", F.lit("+"), F.pmod(F.xxhash64(F.lit(2), "rid"), F.col("shares")))
            ).alias("node")))


def _tree(held: dict) -> Block:
    return Block(np.array(held["rid"], np.int64), np.array(held["weight"], np.int64),
                 _points(held["blob"], held["size"][0]))


def _within_blocks(blocks: DataFrame, cosine: float, listed: bool) -> DataFrame:
    """Links inside blocks, and a row for each block with its centre and radius."""
    def work(key: tuple, held: dict) -> Iterator[pa.RecordBatch]:
        grown = _tree(held)
        yield _batch(traverse(grown, grown, cosine, listed).columns(), LINKS)
        yield _batch({"kind": ["block"], "cosine": [float(grown.radius[0])], "node": [key[0]],
                      "centre": [grown.centres[0]]}, LINKS)

    return _grouped(blocks.select("node", "rid", "weight", "size", "blob"), ["node"], LINKS, work)


def _upper(blocks: DataFrame) -> list[DataFrame]:
    """Nodes above the blocks, level by level from the roots: node, parent, centre, radius, block.

    A parent has the centre of one of its children and a radius that reaches around all of them.
    """
    path = F.split("node", "/")
    rows = blocks.select("node", F.size(path).alias("depth"), "centre", F.col("cosine").alias("radius"),
                         F.lit(True).alias("block"))
    deepest = rows.agg(F.max("depth")).first()[0] or 2
    levels, below = [], None
    for depth in range(deepest, 1, -1):
        level = rows.where(F.col("depth") == depth).drop("depth")
        if below is not None:
            lead = below.groupBy("parent").agg(F.min_by("centre", "node").alias("centre"))
            far = _distance(F.col("centre"), F.col("child")) + F.col("radius")
            above = below.withColumnRenamed("centre", "child").join(lead, "parent").groupBy("parent").agg(
                F.min_by("centre", "node").alias("centre"), F.max(far).alias("radius"))
            level = level.unionByName(above.select(
                F.col("parent").alias("node"), "centre", "radius", F.lit(False).alias("block")))
        below = saved(level.withColumn("parent", F.regexp_replace("node", "/[^/]*$", "")))
        levels.insert(0, below)
    return levels


def _distance(x: Column, y: Column) -> Column:
    dot = F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    return F.sqrt(F.greatest(2 - 2 * dot, F.lit(0.0)))


def _block_pairs(blocks: DataFrame, cosine: float) -> DataFrame:
    """Pairs of different blocks that may hold links, by dual traversal of the upper levels."""
    reach = float(np.sqrt(max(2 - 2 * cosine, 0.0))) + SLACK
    levels = _upper(blocks)
    roots = levels[0]
    pairs = roots.select(*[F.col(c).alias(f"{side}_{c}") for side in "xy" for c in ("node", "centre", "radius", "block")])
    for level in levels[1:]:
        for side in "xy":
            kids = level.select(F.col("parent").alias(f"{side}_node"), *[
                F.col(c).alias(f"kid_{c}") for c in ("node", "centre", "radius", "block")])
            stays = pairs.where(f"{side}_block")
            rest = [c for c in pairs.columns if not c.startswith(f"{side}_")]
            moved = pairs.where(f"not {side}_block").join(kids, f"{side}_node").select(*rest, *[
                F.col(f"kid_{c}").alias(f"{side}_{c}") for c in ("node", "centre", "radius", "block")])
            pairs = stays.unionByName(moved)
        near = _distance(F.col("x_centre"), F.col("y_centre")) <= F.col("x_radius") + F.col("y_radius") + reach
        pairs = saved(pairs.where("x_node <= y_node").where(near | (F.col("x_node") == F.col("y_node"))))
    return pairs.where("x_node < y_node").select(F.col("x_node").alias("x"), F.col("y_node").alias("y"))


PACKED = "node string, size int, rids binary, weights binary, blobs binary, widths binary"


def _packed(blocks: DataFrame) -> DataFrame:
    """A row per block: its points in a few binary columns."""
    def work(key: tuple, held: dict) -> Iterator[pa.RecordBatch]:
        yield _batch({
            "node": [key[0]], "size": [held["size"][0]],
            "rids": [np.array(held["rid"], np.int64).tobytes()],
            "weights": [np.array(held["weight"], np.int64).tobytes()],
            "blobs": [b"".join(held["blob"])],
            "widths": [np.array([len(b) for b in held["blob"]], np.int32).tobytes()],
        }, PACKED)

    return _grouped(blocks.select("node", "rid", "weight", "size", "blob"), ["node"], PACKED, work)


def _unpacked(row: dict) -> Block:
    widths = np.frombuffer(row["widths"], np.int32)
    ends = np.cumsum(widths)
    blobs = [row["blobs"][e - w:e] for w, e in zip(widths.tolist(), ends.tolist(), strict=True)]
    return Block(np.frombuffer(row["rids"], np.int64), np.frombuffer(row["weights"], np.int64),
                 _points(blobs, row["size"]))


def _between_blocks(blocks: DataFrame, pairs: DataFrame, cosine: float, listed: bool) -> DataFrame:
    """Links between different blocks: a block once, then the blocks that it meets."""
    packed = saved(_packed(blocks))
    met = pairs.join(packed, pairs["y"] == packed["node"]).select(
        "x", F.lit(1).alias("side"), *packed.columns)
    own = packed.join(pairs.select(F.col("x").alias("node")).distinct(), "node", "left_semi").select(
        F.col("node").alias("x"), F.lit(0).alias("side"), *packed.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                grown = _unpacked(row)
                if row["side"] == 0:
                    first = grown
                else:
                    yield _batch(traverse(first, grown, cosine, listed).columns(), LINKS)

    return own.unionByName(met).repartition("x").sortWithinPartitions("x", "side", "node").mapInArrow(run, LINKS)


def _found(vectors: DataFrame, cosine: float, block: int, listed: bool, columns: tuple) -> tuple:
    """Stored rows, classes of equal vectors, and what the traversals found."""
    prepare(vectors.sparkSession)
    rows = saved(_prepared(vectors, *columns))
    classes = saved(rows.where("digest is not null").groupBy("label", "size", "digest").agg(
        F.min("rid").alias("node"), F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least")))
    points = rows.select("rid", "blob").join(
        classes.select(F.col("node").alias("rid"), "weight", "label", "size"), "rid")
    blocks = _blocks(saved(points.select("rid", "weight", "label", "size", "blob")), block)
    found = saved(_within_blocks(blocks, cosine, listed))
    made = found.where("kind = 'block'")
    if made.where("node like '%/%/%'").limit(1).count():
        pairs = _block_pairs(made, cosine)
        found = found.unionByName(saved(_between_blocks(blocks, pairs, cosine, listed)))
    return rows, classes, found


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label", block: int = BLOCK,
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id`` and ``kept``."""
    if not 0.5 <= cosine <= 1:
        raise ValueError("the threshold is a cosine of 0.5 to 1")
    rows, classes, found = _found(vectors, cosine, block, False, (id_col, vector_col, label_col))
    sums = found.where("kind = 'links'").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    labels = connected_components(found.where("kind = 'edge'").select("a", "b"))
    named = classes.join(labels, "node", "left").join(sums, "node", "left").withColumn(
        "group", F.coalesce("component", "node"))
    least = named.groupBy("group").agg(F.min("least").alias("component_id"))
    known = saved(named.join(least, "group").select(
        "label", "size", "digest", "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    placed = rows.select("vec_id", "label", "size", "digest").join(sized(known), ["label", "size", "digest"], "left")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return placed.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def pairs(
    vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label", block: int = BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """All linked pairs of different vectors with their cosine, and the members of each class.

    The first table has ``a``, ``b`` (class numbers) and ``cosine``; the second ``class`` and ``vec_id``.
    """
    rows, classes, found = _found(vectors, cosine, block, True, (id_col, vector_col, label_col))
    members = rows.join(classes.select("label", "size", "digest", F.col("node").alias("class")),
                        ["label", "size", "digest"]).select("class", "vec_id")
    return found.where("kind = 'pair'").select("a", "b", "cosine"), members
