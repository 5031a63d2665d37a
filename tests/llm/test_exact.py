"""Operators against brute force and against their SQL."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import regex
import xxhash
from cases import SF, frame, rows, word_list
from tickhouse.llm import (
    bwt,
    decontamination,
    licenses,
    linededup,
    packing,
    quality,
    queries,
    secrets,
    simhash,
    suffixdedup,
    tokencounts,
)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


def components(n: int, linked) -> list[int]:
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if find(i) != find(j) and linked(i, j):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, tmp_path, name):
    """Registered SQL on the smallest tables, with awkward documents added."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").union(frame(spark))
    notices = [(9000 + i, f"w w w {t} tail\nPassword: 'abcdefghijklmnop1' user=bob AKIA{'Z' * 16}", "en", "s", 1)
               for i, (_, t) in enumerate(licenses.TEMPLATES)]
    docs.union(frame(spark, notices)).write.parquet(str(tmp_path / "documents.parquet"))
    db = duckdb.connect()
    for table in ("pages", "benchmark", "embeddings"):
        (tmp_path / f"{table}.parquet").symlink_to(f"{SF}/{table}.parquet")
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = queries.QUERIES[name](spark, str(tmp_path))
    want = db.execute(queries.ORACLES[name])
    columns = sorted(d[0] for d in want.description)
    assert sorted(got.columns) == columns
    names = [d[0] for d in want.description]
    expected = sorted(repr([dict(zip(names, r, strict=True))[c] for c in columns]) for r in want.fetchall())
    assert sorted(repr([r[c] for c in columns]) for r in got.collect()) == expected


def test_bwt_marks_repeats():
    rnd = random.Random(5)
    for _ in range(150):
        least, letters = rnd.randint(1, 6), rnd.choice([b"ab", b"abc", bytes(5), bytes(range(4))])
        strings = [bytes(rnd.choice(letters) for _ in range(rnd.randint(0, 25)))
                   for _ in range(rnd.randint(1, 8))]
        if not any(strings):
            continue
        times = Counter(s[i:i + least] for s in strings for i in range(len(s) - least + 1))
        want = [[i + least <= len(s) and times[s[i:i + least]] > 1 for i in range(len(s))]
                for s in strings]
        assert [m.tolist() for m in bwt.repeated(strings, least)] == want


@pytest.mark.parametrize("block", [suffixdedup.BLOCK, 3000])
def test_op1(spark, block):
    words, rnd = word_list(1), random.Random(1)
    passage = " ".join(rnd.choice(words) for _ in range(60))
    data = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60))) + passage[:rnd.randint(150, 400)]
             + " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60)))) for i in range(60)]
    data += [(100, "a" * 900), (101, "ab" * 250), (102, "b" + "ab" * 120), (103, None), (104, "é" * 130),
             (105, "q" * 199), (106, "q" * 199), (107, passage), (107, passage)]
    got = suffixdedup.digest(suffixdedup.remove_repeats(
        spark.createDataFrame(data, "doc_id long, text string").repartition(3), block=block))
    encoded = [(i, (t or "").encode()) for i, t in data]
    times = Counter(t[i:i + 200] for _, t in encoded for i in range(len(t) - 199))
    want = []
    for doc, t in encoded:
        hit = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - 199):
            if times[t[i:i + 200]] > 1:
                hit[i + 1:i + 201] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~hit[1:-1]])
        want.append((doc, len(t), int(hit.sum()), int((hit[1:] & ~hit[:-1]).sum()),
                     hashlib.sha256(kept).hexdigest()))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_op1_long_texts_are_chunked():
    rnd = np.random.default_rng(3)
    text = rnd.integers(97, 123, suffixdedup.CHUNK + 5000, np.uint8).tobytes()
    parts = list(suffixdedup._chunks([text, b"short"], 200))
    starts = sorted({o + i for meta, data, ends in parts for (_, o), end, begin in zip(
        meta, ends, [0, *ends[:-1]], strict=True) for i in range(end - begin - 199)})
    assert starts == list(range(len(text) - 199))


def test_op2_parts_are_reported_only_together(spark):
    key, far = "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY9", " " * 400
    data = [(1, f"see https://a.example.org {key}"), (2, f"see https://a.example.org {far}{key}"), (3, key),
            (4, "login=root42 password=abcdefghijkl"), (5, "login=root42"), (6, f"AKIA{'B' * 16} {key}")]
    got = {r.doc_id: [s.name for s in r.spans] for r in secrets.scan(
        spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == {1: ["endpoint", "key"], 2: [], 3: [], 4: ["login", "assign"], 5: [],
                   6: ["access", "key"]}


def test_op3_misses_are_rare_and_near_texts_match(spark):
    assert max(licenses.miss(n) for n in range(5, 400)) < 1e-4
    name, text = licenses.TEMPLATES[5]
    words = text.split()
    words[-2] = "any"
    data = [(1, " ".join(["x"] * 50 + words + ["y"] * 50)), (2, " ".join(words[:12]))]
    got = licenses.scan(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.license_id, r.first_word) for r in got] == [(1, name, 50)]
    with pytest.raises(ValueError):
        licenses.scan(spark.createDataFrame(data, "doc_id long, text string"), templates=[("s", "too short")])


def test_op4(spark, documents, texts):
    pieces = tokencounts.load(tokencounts.public_pieces())

    def brute(word: str) -> tuple[float, int]:
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            width = len(word[end - 1].encode())
            cases = [(best[end - 1][0] + width * pieces.byte, best[end - 1][1] - width)]
            cases += [(best[a][0] + pieces.scores[word[a:end]], best[a][1] - 1)
                      for a in range(end) if word[a:end] in pieces.scores]
            best.append(max(cases))
        return best[-1]

    store = {}
    for r in tokencounts.token_counts(documents).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])
        for w in words:
            if w not in store:
                store[w] = brute(tokencounts.MARK + w)
        assert r.n_pretokens == len(words) and r.n_distinct == len(set(words))
        assert r.n_tokens == -sum(store[w][1] for w in words)
        assert r.log_score == pytest.approx(sum(store[w][0] for w in words))
    totals = tokencounts.totals(tokencounts.token_counts(documents)).first()
    assert totals.n_docs == len(texts)


def test_op5_round_trip(spark):
    from tokenizers import Tokenizer

    model = packing.ByteBpe.public()
    whole = Tokenizer.from_file(model.vocabulary)
    data = [r for r in rows() if r[0] not in (None, 11)] + [(50, "a <|endoftext|> b", "en", None, 1)]
    got = packing.pack(frame(spark, data).repartition(3), window=4).collect()
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, text, *_ in data:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(pieces.pop(doc), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids == ids[at:at + r.length]
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert not pieces
    sizes = {}
    for number, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        sizes[number] = at
    assert sorted(sizes) == list(range(len(sizes)))
    assert all(n == 1024 for k, n in sizes.items() if k < len(sizes) - 1) and 0 < sizes[len(sizes) - 1] <= 1024


@pytest.mark.parametrize("weights", [None, {0: 5, 1: 1, 2: 1}])
def test_op5_mixture_is_a_round_robin(weights):
    totals = {0: 700, 1: 190, 2: 37}
    mixture = packing.Mixture(totals, weights or totals, 10, 2)
    due = sorted(((2 * j + 1) / (2 * (weights or totals)[q]), q) for q, n in totals.items() for j in range(n))
    for window in range(mixture.windows + 1):
        served = Counter(q for _, q in due[:window * 20])
        assert mixture.before(window) == [served[q] for q in sorted(totals)]
    for i in range(3):
        for position in range(totals[i]):
            w = mixture.find(i, position)
            assert mixture.before(w)[i] <= position < mixture.before(w + 1)[i]


def brute_print(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op6(spark, documents, texts):
    ids = sorted(texts)
    prints = [brute_print(texts[i]) for i in ids]
    groups = components(len(ids), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(documents).collect()}
    assert got == {i: (f"{p:016x}", ids[g]) for i, p, g in zip(ids, prints, groups, strict=True)}


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 12])
def test_op6_dense_groups(spark, bucket):
    """Hundreds of prints around a few centres; small buckets force both splits."""
    rnd = random.Random(2)
    centres = [rnd.getrandbits(64) for _ in range(3)]
    prints = []
    for k in range(400):
        value = centres[k % 3]
        for _ in range(rnd.randint(0, 4)):
            value ^= 1 << rnd.randrange(64)
        prints.append(value)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    data = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    got = {r.fp: r.component for r in simhash.classes(data, 2, bucket).collect()}
    groups = components(len(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    assert [got[s] for s in signed] == groups


def edit_distance(a: str, b: str) -> int:
    row = np.arange(len(b) + 1)
    other = np.frombuffer(b.encode("utf-32-le"), np.uint32)
    for i, x in enumerate(a, 1):
        step = np.minimum(row[1:] + 1, row[:-1] + (other != ord(x)))
        new = np.concatenate([[i], step])
        row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return int(row[-1])


def similar(a: str, b: str) -> bool:
    most = max(len(a), len(b))
    if 5 * min(len(a), len(b)) < 4 * most:
        return False
    size = linededup.PIECE
    if most <= size:
        return edit_distance(a, b) <= most // 5
    return 5 * sum(edit_distance(a[i:i + size], b[i:i + size]) for i in range(0, most, size)) <= most


def brute_lines(docs: list[tuple]) -> dict:
    places: dict[str, list] = {}
    for doc, text in docs:
        for n, line in enumerate(text.split("\n") if text is not None else []):
            line = regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower()).strip(" ")
            if len(line.split(" ")) >= 5:
                places.setdefault(line, []).append((doc, n))
    lines = list(places)
    prints = []
    for line in lines:
        hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in line.split(" ")]
        prints.append(sum(1 << b for b in range(64)
                          if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    groups = components(len(lines), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= linededup.RADIUS
                        and similar(lines[i], lines[j]))
    gone: dict = {}
    for g in set(groups):
        for doc, n in sorted(p for i, x in enumerate(lines) if groups[i] == g for p in places[x])[1:]:
            gone.setdefault(doc, []).append(n)
    return {doc: sorted(ns) for doc, ns in gone.items()}


def test_op8(spark, documents, texts):
    words, rnd = word_list(8), random.Random(8)
    source = [rnd.choice(words) for _ in range(80)]
    data = [(i, texts[i]) for i in sorted(texts)[:120]]
    for k in range(150):  # many variants of one line, and a very long one
        line = list(source)
        for _ in range(rnd.randint(0, 4)):
            line[rnd.randrange(80)] = rnd.choice(words)
        data.append((1000 + k, " ".join(line) + "\nshort one\n" + " ".join(rnd.choices(words, k=7))))
    long = " ".join(words * 60)  # over one segment of counters
    data += [(2000, long + " end"), (2001, long + " ends")]
    got = linededup.dedup_lines(spark.createDataFrame(data, "doc_id long, text string").repartition(3))
    want = brute_lines(data)
    for r in got.collect():
        gone = want.get(r.row.doc_id, [])
        assert list(r.removed or []) == gone
        assert r.kept == "\n".join(x for n, x in enumerate(r.row.text.split("\n")) if n not in set(gone))


def test_op9_stored_ledger_equals_its_sql(spark, documents, tmp_path):
    """The counts beside the ledger are those that SQL finds by trying every rule on its own."""
    folder = str(tmp_path / "quality")
    rows = quality.write_ledger(documents, folder).collect()
    assert len(rows) == documents.count()
    con = duckdb.connect()
    con.sql(f"CREATE TABLE l AS SELECT * FROM '{folder}/ledger/*.parquet'")
    got = {(r.policy, r.rule): (r.kept, r.kept_without, r.only_this, r.failed)
           for r in spark.read.parquet(f"{folder}/ablations").collect()}
    rules = {r.name: r.failed for r in quality.RULES}
    for policy in (quality.BASE, quality.DEFAULT, quality.STRICT):
        for name in policy.rules:
            others = " OR ".join(f"({rules[n]})" for n in policy.rules if n != name) or "FALSE"
            kept, without, only, failed = (con.sql(f"SELECT count(*) FROM l WHERE {c}").fetchall()[0][0] for c in (
                f"NOT ({others} OR ({rules[name]}))", f"NOT ({others})",
                f"({rules[name]}) AND NOT ({others})", rules[name]))
            assert got[policy.version, name] == (kept, without, only, failed)
    assert len(got) == sum(len(p.rules) for p in (quality.BASE, quality.DEFAULT, quality.STRICT))


def test_op9_ledger_and_ablations(spark, documents):
    ledger = quality.ledger(documents).cache()
    policies = (quality.BASE, quality.DEFAULT, quality.STRICT)
    bits = [r.fail_bits for r in ledger.collect()]
    assert len(set(bits)) > 2
    for r in quality.ablations(ledger, policies).collect():
        policy = next(p for p in policies if p.version == r.policy)
        rule = 1 << next(x.bit for x in quality.RULES if x.name == r.rule)
        mask = quality.mask(policy)
        assert r.kept == sum(not b & mask for b in bits)
        assert r.kept_without == sum(not b & mask & ~rule for b in bits)
        assert r.only_this == sum(b & mask == rule for b in bits)
        assert r.failed == sum(bool(b & rule) for b in bits)
    with pytest.raises(ValueError):
        quality.mask(quality.Policy("x", ("nothing",)))


def test_op9_exact_ranks_agree_with_hashes():
    rnd = np.random.default_rng(1)
    ids = rnd.integers(0, 3, 400)
    doc, ends = np.repeat([0, 1], 200), np.array([200, 400])
    starts = np.flatnonzero(np.arange(400) + quality.WINDOW <= ends[doc])
    keys = quality._ranked(ids, starts, doc)
    times = Counter((doc[s], *ids[s:s + 8]) for s in starts)
    assert [Counter(keys.tolist())[k] for k in keys.tolist()] == [times[(doc[s], *ids[s:s + 8])] for s in starts]
    want = np.zeros(400, bool)
    for s in starts:
        if times[(doc[s], *ids[s:s + 8])] > 1:
            want[s:s + 8] = True
    assert (quality._repeated(ids, doc, ends) == want).all()


@pytest.mark.parametrize("shard_bytes", [decontamination.SHARD_BYTES, 60])
def test_op10(spark, shard_bytes):
    rnd, words = random.Random(4), list("abcdefgh")
    items = [(k, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 18)))) for k in range(25)]
    items += [(25, None), (26, items[3][1]), (26, items[3][1]), (None, "a b c")]
    data = [(k, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60)))) for k in range(60)]
    data += [(90 + i, "Zz. " * 40 + (t or "").upper() + " zz" * 400) for i, (_, t) in enumerate(items)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    scanned = decontamination.scan(docs, bench, shard_bytes=shard_bytes)
    got = {r.doc_id: r for r in decontamination.report(scanned).collect()}
    windows: dict[tuple, set] = {}
    for name, text in items:
        ws = tuple((text or "").split())
        size = min(13, len(ws))
        for i in range(len(ws) - size + 1 if ws else 0):
            windows.setdefault(ws[i:i + size], set()).add("" if name is None else str(name))
    for doc, text in data:
        ws = re.findall(r"[a-z]+", text.lower())
        hit, found = set(), set()
        for size in range(1, 14):
            for i in range(len(ws) - size + 1):
                names = windows.get(tuple(ws[i:i + size]))
                if names:
                    found |= names
                    hit |= set(range(i, i + size))
        r = got[doc]
        assert (r.n_words, r.n_hit, r.n_items) == (len(ws), len(hit), len(found))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(ws))
    cut = {r.doc_id: r.text for r in decontamination.remove_spans(docs, bench, shard_bytes=shard_bytes).collect()}
    kept = {r.doc_id for r in decontamination.keep_clean(docs, bench, shard_bytes=shard_bytes).collect()}
    for doc, text in data:
        assert (doc in kept) == (not got[doc].contaminated)
        if got[doc].contaminated:
            assert len(re.findall(r"[a-z]+", cut[doc].lower())) == got[doc].n_words - got[doc].n_hit
        elif not got[doc].n_hit:
            assert cut[doc] == text


def test_plans_of_native_operators_hold_no_python(spark, documents):
    for frame_ in (licenses.scan(documents), secrets.scan(documents), linededup.dedup_lines(documents)):
        plan = frame_._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


@pytest.mark.parametrize("name", ["MIT-whole", "ISC-whole", "BSD-2-Clause-whole", "GPL-header", "Unlicense-whole"])
def test_op3_finds_whole_license_texts(spark, name):
    """Whole and lightly edited texts inside others match; the opening sentence alone does not."""
    text, rnd = dict(licenses.TEMPLATES)[name], random.Random(3)
    around = " ".join(rnd.choice(word_list(3)) for _ in range(500))
    words = text.split()
    edited = [w if i != len(words) // 2 else "changed" for i, w in enumerate(words)]
    data = [(1, f"{around} {text} {around}"), (2, f"{around} {' '.join(edited)}"), (3, " ".join(words[:12])), (4, around)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = {(r.doc_id, r.license_id): r.containment for r in licenses.scan(docs).collect()}
    assert found[1, name] == 1 and 0.8 <= found[2, name] < 1 and (3, name) not in found
    assert not any(i == 4 for i, _ in found)
