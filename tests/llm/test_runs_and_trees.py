"""Periodic runs, Merkle manifest and cover trees against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from cases import SF, frame, rows

from tickhouse.llm import covertree, merkle, periodicruns, queries


# --- periodic runs -----------------------------------------------------------------------------

def brute_runs(words: list) -> list[tuple[int, int, int]]:
    """All maximal runs by comparing the words of every lag."""
    found = []
    for period in range(1, len(words) // 4 + 1):
        start = None
        for i in range(len(words) - period + 1):
            same = i < len(words) - period and words[i] == words[i + period]
            if same and start is None:
                start = i
            elif not same and start is not None:
                length = i - start + period
                if length >= max(6, 4 * period) and not any(
                    all(words[j] == words[j + d] for j in range(start, start + length - d))
                    for d in range(1, period)
                ):
                    found.append((start, length, period))
                start = None
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    code = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if code is not None and code % 10 == 0 and words:
        n, g = len(words), code // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def run_rows(df):
    return sorted((tuple(r) for r in df.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
        "collapsed_sha256").collect()), key=repr)


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_lag_scan_equals_brute_force(letters):
    rnd = random.Random(letters)
    for _ in range(150):
        words = [rnd.randrange(letters) for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            unit = [rnd.randrange(letters + 5) for _ in range(rnd.randint(1, 9))]
            at = rnd.randint(0, len(words))
            words[at:at] = (unit * 8)[:rnd.randint(1, 8 * len(unit))]
        array = np.array(words, np.int64)
        got = periodicruns.runs_of(array, np.zeros(len(words), np.int64))
        assert list(zip(*(x.tolist() for x in got), strict=True)) == brute_runs(words)


def test_texts_of_a_batch_stay_apart():
    words = np.array([1] * 5 + [1] * 5 + [1] * 7, np.int64)
    text = np.repeat([0, 1, 2], [5, 5, 7])
    assert [x.tolist() for x in periodicruns.runs_of(words, text)] == [[10], [7], [1]]


def test_rare_words_split_until_nothing_is_left():
    rnd = random.Random(5)
    words = np.array([int(rnd.paretovariate(0.8)) for _ in range(5000)], np.int64)
    places, _ = periodicruns.stable_segments(words, np.zeros(5000, np.int64))
    assert len(places) < 500


def test_periodic_runs_equal_brute_force(spark):
    data = [(i, t, *rest) for i, (_, t, *rest) in enumerate(rows()) if t is None or len(t) < 10_000]
    data += [(100 + i, "a b c " * i + "x y\nz " * (i % 7) + "a b c " * 5, None, None, None) for i in range(60)]
    data += [(None, "w " * 9, None, None, None), (100, "a", None, None, None), (100, "a", None, None, None)]
    docs = frame(spark, data, extra=True)
    got = periodicruns.digest(periodicruns.periodic_runs(periodicruns.planted(docs)))
    assert run_rows(got) == sorted((brute_row(r[0], r[1]) for r in data), key=repr)
    assert sum(r[1] > 0 for r in run_rows(got)) > 20
    assert periodicruns.periodic_runs(frame(spark, [])).collect() == []


def test_registered_runs_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    short = {r.doc_id: r.text for r in docs if len((r.text or "").split()) < 700}
    got = [r for r in run_rows(queries.QUERIES["op12_periodic_runs"](spark, SF)) if r[0] in short]
    assert got == sorted((brute_row(i, t) for i, t in short.items()), key=repr)


# --- Merkle manifest ---------------------------------------------------------------------------

def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves: list[str]) -> tuple[str, list[list[str]]]:
    """Root and, per leaf, (sibling, left side) per level."""
    level, paths, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for leaf, i in enumerate(at):
            other = i ^ 1
            paths[leaf].append((level[other] if other < len(level) else None, i % 2 == 1))
        level = [sha(*level[i:i + 2]) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], paths


def brute_manifest(data: list[tuple]) -> list[tuple]:
    def leaf(doc_id, text, lang, source, n_chars):
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}"
                     for v in (doc_id, source, lang, n_chars, text)])

    groups: dict = {}
    for row in data:
        groups.setdefault(row[2], []).append((row[0], leaf(*row), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[g] = brute_tree([r[1] for r in groups[g]])
    root, tops = brute_tree([trees[g][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, (doc_id, own, row) in enumerate(groups[g]):
            path = trees[g][1][i] + tops[k]
            digest = own
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and row[4] is not None:
                digest = leaf(*row[:4], row[4] + 1)
            for sibling, left in path:
                digest = sha(sibling or "", digest) if left else sha(digest, sibling or "")
            out.append((doc_id, own, trees[g][0], root, sha(*[s for s, _ in path if s]), digest, digest == root))
    return sorted(out, key=repr)


def manifest_rows(spark, data, monkeypatch, extra=False):
    monkeypatch.setattr(queries, "table", lambda s, d, name: frame(spark, data, extra=extra))
    got = queries.QUERIES["op13_merkle_manifest"](spark, "")
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.select(*names).collect()), key=repr)


@pytest.mark.parametrize("sizes", [(1,), (2,), (3, 1), (5, 64, 65), (130, 7, 1, 1)])
def test_manifest_equals_brute_force(spark, monkeypatch, sizes):
    langs = ["en", None, "Ä", "z"]
    data = [(rank * 3 + k, f"text {rank}", langs[k], "s", rank if rank % 5 else None)
            for k, size in enumerate(sizes) for rank in range(size)]
    random.Random(1).shuffle(data)
    assert manifest_rows(spark, data, monkeypatch) == brute_manifest(data)


def test_manifest_of_awkward_rows(spark, monkeypatch):
    assert manifest_rows(spark, rows(), monkeypatch, extra=True) == brute_manifest(rows())
    assert manifest_rows(spark, [], monkeypatch) == []


def test_nodes_are_nested_intervals(spark):
    data = [(i, "t", "en", "s", i) for i in range(150)]
    docs = frame(spark, data)
    leaves = merkle.ranked(docs.select(
        merkle.group_key(docs.lang).alias("key"), "doc_id", merkle.leaf_digest(docs.doc_id).alias("digest")),
        "key", "doc_id")
    made = merkle.tree(leaves, ["doc_id"])
    nodes = {(r.level, r.lo): r.hi for r in made.nodes.collect()}
    for (level, lo), hi in nodes.items():
        assert lo % (1 << level) == 0 and hi == min(150, lo + (1 << level))
    assert len(nodes) == sum(math.ceil(150 / (1 << k)) for k in range(9))


def test_registered_manifest_equals_brute_force(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.QUERIES["op13_merkle_manifest"](spark, SF).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert sorted(map(tuple, got.collect()), key=repr) == brute_manifest(data)


# --- cover trees -------------------------------------------------------------------------------

def vectors(seed: int, n: int, size: int = 16) -> list[tuple]:
    """Noise, tight groups, chains of links, copies and vectors that cannot link."""
    rnd = np.random.default_rng(seed)
    data = list(rnd.normal(size=(n, size)))
    for k in range(6):
        centre = rnd.normal(size=size)
        data += list(centre + rnd.normal(size=(20 + 10 * k, size)) * 0.04 * (k + 1))
    walk = rnd.normal(size=size)
    for _ in range(40):
        walk = walk + rnd.normal(size=size) * 0.12
        data.append(walk.copy())
    data += [data[3], data[3] * 7, data[3] * 1e150, data[n + 5], data[n + 5]]
    out = [(i, [float(x) for x in v], int(rnd.integers(0, 3))) for i, v in enumerate(data)]
    out += [(len(out) + k, v, label) for k, (v, label) in enumerate([
        (None, 1), ([], 1), ([0.0] * size, 1), ([-0.0] * size, 1), ([math.nan] * size, 1), ([math.inf] * size, 1),
        ([1.0] * (size - 1) + [None], 1), ([1.0] * size, None), ([1.0] * size, None), ([1.0] * 3, 1), ([2.0] * 3, 1)])]
    out += [(None, [1.0] * 5, 2), (7, [1.0] * 5, 2), (None, [-1.0] * 5, 2), (8, [3.0] * 5, 2), (8, [3.0] * 5, 2)]
    return out


def brute_links(data: list[tuple], cosine: float) -> list[tuple]:
    def unit(v, label):
        if v is None or label is None or not v or None in v or not all(map(math.isfinite, v)) or not any(v):
            return None
        a = np.array(v) / np.abs(v).max()
        return a / np.sqrt((a * a).sum())

    units = [unit(v, label) for _, v, label in data]
    linked = [[] for _ in data]
    for i, a in enumerate(units):
        for j, b in enumerate(units):
            if (i != j and a is not None and b is not None and data[i][2] == data[j][2]
                    and len(a) == len(b) and float(a @ b) >= cosine):
                linked[i].append(j)
    out = []
    for i in range(len(data)):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [data[j][0] for j in seen if data[j][0] is not None]
        component = min(ids, default=None)
        out.append((data[i][0], len(linked[i]), component, data[i][0] == component))
    return sorted(out, key=repr)


def vector_frame(spark, data):
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    return df.selectExpr("*", "'x' AS rid", "'x' AS node", "'x' AS digest", "'x' AS weight")


def link_rows(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


@pytest.mark.parametrize("block", [1 << 22, 16 * 40])
def test_links_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(covertree, "CENTRES", 8)
    data = vectors(3, 400)
    expected = brute_links(data, 0.98)
    assert sum(r[1] for r in expected) > 500
    assert link_rows(covertree.near_duplicates(vector_frame(spark, data), block=block)) == expected


def test_links_of_empty_tables(spark):
    assert covertree.near_duplicates(vector_frame(spark, [])).collect() == []


def test_pairs_equal_brute_force(spark):
    data = [r for r in vectors(4, 100) if r[0] is not None]
    found, members = covertree.pairs(vector_frame(spark, data), block=16 * 40)
    of = {}
    for r in members.collect():
        of.setdefault(r["class"], []).append(r.vec_id)
    links = {i: 0 for i, *_ in data}
    for r in found.collect():
        assert r.cosine >= 0.98
        for x, y in ((r.a, r.b), (r.b, r.a)):
            for i in of[x]:
                links[i] += len(of[y])
    for ids in of.values():
        for i in ids:
            links[i] += len(ids) - 1
    expected = {}
    for i, n, *_ in brute_links(data, 0.98):
        expected[i] = n
    unique = {i for i, *_ in data if sum(r[0] == i for r in data) == 1}
    assert {i: links[i] for i in unique} == {i: expected[i] for i in unique}


def blocks_of(points: np.ndarray) -> covertree.Block:
    n = len(points)
    return covertree.Block(np.arange(n), np.ones(n, np.int64), covertree._unit(points))


def test_trees_nest_and_cover():
    rnd = np.random.default_rng(1)
    points = np.concatenate([c + rnd.normal(size=(300, 8)) * 0.1 for c in rnd.normal(size=(12, 8))])
    grown = blocks_of(points)
    assert sorted(grown.order.tolist()) == list(range(len(points)))
    assert len(grown.radius) > 12
    for k in range(len(grown.radius)):
        covered = grown.points[grown.lo[k]:grown.hi[k]]
        far = covertree._distances(grown.centres[k][None], covered).max()
        assert far <= grown.radius[k] + covertree.SLACK
        if grown.count[k]:
            kids = range(grown.first[k], grown.first[k] + grown.count[k])
            assert [int(grown.lo[j]) for j in kids][0] == grown.lo[k]
            assert sum(int(grown.hi[j] - grown.lo[j]) for j in kids) == grown.hi[k] - grown.lo[k]


def test_bounds_spare_most_comparisons(monkeypatch):
    """Far groups are pruned and tight groups accepted whole, so few cosines are computed."""
    rnd = np.random.default_rng(2)
    centres = rnd.normal(size=(20, 32))
    points = np.concatenate([c + rnd.normal(size=(400, 32)) * 0.005 for c in centres])
    grown = blocks_of(points)
    compared = []
    near = covertree.Links.near
    monkeypatch.setattr(covertree.Links, "near", lambda self, rows, cols, c: (
        compared.append(len(rows) * len(cols)), near(self, rows, cols, c))[1])
    links = covertree.traverse(grown, grown, 0.98)
    assert (links.counts[0] + links.counts[1] == 399).all()
    assert len(set(links.label.tolist())) == 20
    assert sum(compared) < len(points) ** 2 / 100
