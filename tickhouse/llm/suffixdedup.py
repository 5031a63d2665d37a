"""Exact removal of byte strings that occur more than once, by suffix order.

A byte goes if it lies in a string of ``least`` bytes that also starts anywhere else, in the same
document or another; matches never cross documents and are judged on the input.

Suffix order is only needed among strings that can be equal, so the work is cut up by content:

1. In every window of ``least`` bytes the ``GRAM``-byte string with the smallest hash is its anchor
   (leftmost on ties). Equal windows have equal anchors in equal places. A maximal run of windows
   with one anchor is a *segment*: its windows, and the bytes they cover.
2. Segments are grouped by anchor. An anchor that occurs once has no repeats. Equal segments are
   counted, not compared; where an anchor has one distinct segment, occurring twice or more, there
   is nothing else that its windows could match.
3. A window reaches at least half of ``least - GRAM`` bytes to one side of its anchor. A segment that
   agrees with no other distinct one of its anchor on that many bytes on either side shares no window
   with them and is not compared (``rivals``).
4. The distinct segments that are left are gathered in blocks of whole anchors, at most about
   ``BLOCK`` bytes. Each block gets its Burrows-Wheeler transform, and breadth-first backward
   extension finds which neighbours in suffix order share ``least`` bytes (``bwt.repeated``).
5. An anchor whose distinct segments exceed a block (a short string with very many contexts) has its
   windows counted by digest instead: the exact way for the rest, spread over all tasks.
6. Marked windows go back to every place their segment occurs; each document unites them and drops
   the bytes they cover. Texts travel compressed.

Equal segments of one batch are one row with a list of places, so copies are combined before the
first shuffle. Null texts are empty; texts shorter than ``least`` lose nothing; very long texts are
anchored in chunks; repeated rows are documents of their own, and each loses what the other has; an
empty table gives an empty result; further columns are kept and cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.llm.bwt import repeated
from tickhouse.llm.common import identified, prepare, stored

LEAST = 200
GRAM = 32
BLOCK = 1 << 20
CHUNK = 1 << 20
#: Windows whose anchors are found at once.
TILE = 1 << 15
PLACE = np.dtype([("file", "<i8"), ("at", "<i8"), ("start", "<i8")])
_POSITION = np.uint64((1 << 24) - 1)


def _mix(values: np.ndarray) -> np.ndarray:
    values ^= values >> np.uint64(31)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(29)
    return values


def _grams(data: np.ndarray, gram: int) -> np.ndarray:
    """The hash of the ``gram`` bytes at each position."""
    with np.errstate(over="ignore"):
        hashed = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        width, factor = 1, 0x9E3779B97F4A7C15
        while width < gram:
            hashed = hashed[:-width] * np.uint64(factor) + hashed[width:]
            width, factor = 2 * width, factor * factor % 2**64
        return _mix(hashed)


def anchors(data: np.ndarray, least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """For each window of a chunk: the hash of its anchor and the anchor's position."""
    hashed, place = _anchors(data, least, gram)
    return hashed[place], place


def _anchors(data: np.ndarray, least: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each gram and the position of each window's anchor; in tiles that stay in the cache."""
    hashed = np.empty(len(data) - gram + 1, np.uint64)
    place = np.empty(len(data) - least + 1, np.int64)
    for begin in range(0, len(place), TILE):
        end = min(begin + TILE, len(place))
        part = hashed[begin:end + least - gram] = _grams(data[begin:end + least - 1], gram)
        smallest = (part & ~_POSITION) | np.arange(len(part), dtype=np.uint64)
        span, width = least - gram + 1, 1
        while 2 * width <= span:
            smallest = np.minimum(smallest[:-width], smallest[width:])
            width *= 2
        if width < span:
            smallest = np.minimum(smallest[:width - span], smallest[span - width:])
        place[begin:end] = (smallest & _POSITION).astype(np.int64) + begin
    return hashed, place


def _side(hashed: np.ndarray, begin: np.ndarray, reach: int, gram: int, there: np.ndarray) -> pa.Array:
    """A hash of the ``reach`` bytes from ``begin``, null where they are not all ``there``. Two that
    collide only cost a comparison. A reach shorter than a gram tells nothing: all are alike."""
    out = np.zeros(len(begin), np.uint64)
    at = begin[there]
    found = np.zeros(len(at), np.uint64)
    if reach >= gram:
        with np.errstate(over="ignore"):
            for offset in [*range(0, reach - gram, gram), reach - gram]:
                found = _mix(found * np.uint64(0x9E3779B97F4A7C15) + hashed[at + offset])
    out[there] = found
    return pa.array((out >> np.uint64(32)).astype(np.uint32).view(np.int32), mask=~there)


def _segments(data: np.ndarray, ends: np.ndarray, least: int, gram: int):
    """Anchor, document, start and number of windows of each segment of some concatenated texts, and
    the hashes of what is on the left and the right of its anchor."""
    hashed, place = _anchors(data, least, gram)
    doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[:len(place)]
    inside = np.flatnonzero(np.arange(len(place)) + least <= ends[doc])
    if not len(inside):
        return None
    place, doc = place[inside], doc[inside]
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (inside[1:] != inside[:-1] + 1)
                          | (doc[1:] != doc[:-1])])
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate([first, [len(inside)]]))
    start, middle, reach = inside[first], place[first], (least - gram + 1) // 2
    left = _side(hashed, middle - reach, reach, gram, middle - reach >= start)
    right = _side(hashed, middle + gram, reach, gram, middle + gram + reach <= start + count + least - 1)
    return hashed[middle].view(np.int64), doc[first], start, count, left, right


def _chunks(texts: list[bytes], least: int) -> Iterator[tuple[list[tuple[int, int]], bytes, np.ndarray]]:
    """Concatenated texts of about ``CHUNK`` bytes; long texts are cut with an overlap.

    Yields (document, offset) of each part, the bytes and the ends of the parts.
    """
    parts: list[tuple[int, int]] = []
    pieces: list[bytes] = []
    size = 0
    for k, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - least + 1), CHUNK):
            piece = text[offset:offset + CHUNK + least - 1]
            if len(piece) < least:
                continue
            parts.append((k, offset))
            pieces.append(piece)
            size += len(piece)
            if size >= CHUNK:
                yield parts, b"".join(pieces), np.cumsum([len(p) for p in pieces])
                parts, pieces, size = [], [], 0
    if parts:
        yield parts, b"".join(pieces), np.cumsum([len(p) for p in pieces])


def segments(rows: DataFrame, least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """A row per distinct segment of a batch: anchor, digest, windows, a place, and other places.

    ``rows`` has ``file``, ``at`` and ``text`` (binary).
    """
    names = ["anchor", "digest", "windows", "left", "right", "file", "at", "start", "n", "more"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files, ats = batch.column("file").to_numpy(), batch.column("at").to_numpy()
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            for parts, data, ends in _chunks(texts, least):
                found = _segments(np.frombuffer(data, np.uint8), ends, least, gram)
                if found is None:
                    continue
                anchor, part, position, count, left, right = found
                row = np.array([k for k, _ in parts])[part]
                begin = np.concatenate([[0], ends[:-1]])
                start = position - begin[part] + np.array([o for _, o in parts])[part]
                hashed = xxhash.xxh64_intdigest
                digest = np.fromiter(
                    (hashed(data[a:b]) for a, b in zip(
                        position.tolist(), (position + count + least - 1).tolist(), strict=True)),
                    np.uint64, len(anchor)).view(np.int64)
                order = np.lexsort((digest, anchor))
                a, d = anchor[order], digest[order]
                first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (d[1:] != d[:-1])]))
                n = np.diff(np.concatenate([first, [len(order)]]))
                one = order[first]
                place = np.empty(len(order), PLACE)
                place["file"], place["at"], place["start"] = files[row[order]], ats[row[order]], start[order]
                more = [place[f + 1:f + c].tobytes() if c > 1 else None
                        for f, c in zip(first.tolist(), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[one]), pa.array(digest[one]), pa.array(count[one].astype(np.int32)),
                     left.take(pa.array(one)), right.take(pa.array(one)), pa.array(files[row[one]]), pa.array(ats[row[one]]), pa.array(start[one]),
                     pa.array(n), pa.array(more, pa.binary())], names=names)

    return rows.mapInArrow(run, "anchor long, digest long, windows int, left int, right int, file long, "
                                "at long, start long, n long, more binary")


def shared_segments(rows: DataFrame) -> DataFrame:
    """The segments whose anchor occurs twice or more, with ``copies`` of the segment, ``distinct``
    segments of the anchor, and ``chosen`` on one row of each distinct segment."""
    same = Window.partitionBy("anchor", "digest")
    by_anchor = Window.partitionBy("anchor")
    ordered = same.orderBy("file", "at", "start")
    numbered = rows.repartition("anchor").select(
        "*", (F.row_number().over(ordered) == 1).alias("chosen")).select(
        "*", F.sum("n").over(same).alias("copies"),
        F.sum("n").over(by_anchor).alias("places"),
        F.sum(F.col("chosen").cast("long")).over(by_anchor).alias("distinct"))
    return numbered.where("places > 1").drop("places")


def rivals(chosen: DataFrame) -> DataFrame:
    """The distinct segments that agree with another one of their anchor on the left or the right of
    it; ``distinct`` then counts these."""
    def others(side: str):
        return F.count(side).over(Window.partitionBy("anchor", side)) > 1

    alike = chosen.repartition("anchor").select("*", others("left").alias("by_left")).select(
        "*", others("right").alias("by_right")).where("by_left OR by_right")
    return alike.drop("left", "right", "by_left", "by_right", "distinct").select(
        "*", F.count(F.lit(1)).over(Window.partitionBy("anchor")).alias("distinct"))


def _cut_out(docs: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """The bytes of chosen segments, fetched from the documents they lie in."""
    by_doc = wanted.groupBy("file", "at").agg(F.collect_list(
        F.struct("anchor", "digest", "windows", "start", "copies", "distinct")).alias("wanted"))
    names = ["anchor", "digest", "windows", "copies", "distinct", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in names}
            for packed, segs in zip(batch.column("packed").to_pylist(),
                                    batch.column("wanted").to_pylist(), strict=True):
                text = zstandard.decompress(packed)
                for s in segs:
                    for n in names[:-1]:
                        out[n].append(s[n])
                    out["bytes"].append(text[s["start"]:s["start"] + s["windows"] + least - 1])
            if out["anchor"]:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[n], k) for n, k in zip(names, kinds, strict=True)], names=names)

    joined = docs.join(by_doc, ["file", "at"]).select("packed", "wanted")
    return joined.mapInArrow(run, "anchor long, digest long, windows int, copies long, distinct long, "
                                  "bytes binary")


def _packed_bits(marks: np.ndarray) -> bytes:
    return np.packbits(marks).tobytes()


def _compared(cut: DataFrame, least: int, block: int) -> DataFrame:
    """``marks``: which windows of each segment without copies occur again, as packed bits."""

    def solve(rows: list[dict]) -> pa.RecordBatch:
        found = [(r, m[:r["windows"]]) for r, m in zip(
            rows, repeated([r["bytes"] for r in rows], least), strict=True) if r["copies"] == 1]
        found = [(r, m) for r, m in found if m.any()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r["anchor"] for r, _ in found], pa.int64()),
             pa.array([r["digest"] for r, _ in found], pa.int64()),
             pa.array([_packed_bits(m) for _, m in found], pa.binary())],
            names=["anchor", "digest", "marks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size, last = 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["anchor"] != last and size >= block // 2:
                    yield solve(held)
                    held, size = [], 0
                last = row["anchor"]
                held.append(row)
                size += len(row["bytes"])
        if held:
            yield solve(held)

    ordered = cut.repartition("anchor").sortWithinPartitions("anchor")
    return ordered.mapInArrow(run, "anchor long, digest long, marks binary")


def _counted(cut: DataFrame, least: int) -> DataFrame:
    """The same for anchors with too many distinct segments: windows are counted by digest."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                whole, n = row["bytes"], row["windows"]
                keys = [xxhash.xxh128_digest(whole[i:i + least]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["anchor"]] * n, pa.int64()), pa.array([row["digest"]] * n, pa.int64()),
                     pa.array([row["copies"]] * n, pa.int64()), pa.array(range(n), pa.int32()),
                     pa.array(keys, pa.binary())],
                    names=["anchor", "digest", "copies", "i", "key"])

    # Dealt by segment, so that the windows of one phrase come from all tasks alike.
    windows = cut.repartition("digest").mapInArrow(
        digests, "anchor long, digest long, copies long, i int, key binary")
    again = windows.select("anchor", "digest", "copies", "i", F.sum("copies").over(
        Window.partitionBy("anchor", "key")).alias("times")).where("times > 1 AND copies = 1")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for places in batch.column("places").to_pylist():
                bits = np.zeros(max(places) + 1, bool)
                bits[places] = True
                marks.append(_packed_bits(bits))
            yield pa.RecordBatch.from_arrays(
                [batch.column("anchor"), batch.column("digest"), pa.array(marks, pa.binary())],
                names=["anchor", "digest", "marks"])

    by_segment = again.groupBy("anchor", "digest").agg(F.collect_list("i").alias("places"))
    return by_segment.mapInArrow(pack, "anchor long, digest long, marks binary")


def repeats(
    docs: DataFrame, least: int = LEAST, gram: int = GRAM, block: int = BLOCK
) -> DataFrame:
    """``file``, ``at`` and ``found``: segments of a document with the windows that are repeats.

    ``docs`` has ``file``, ``at``, ``text`` (binary) and is read three times.
    """
    shared = stored(shared_segments(segments(docs.select("file", "at", "text"), least, gram)), "segments")
    wanted = rivals(shared.where("chosen AND distinct > 1").select(
        "file", "at", "anchor", "digest", "windows", "left", "right", "start", "copies", "distinct"))
    cut = stored(_cut_out(packed_texts(docs), wanted, least), "bytes")
    most = block // (2 * least)
    marks = stored(_compared(cut.where(F.col("distinct") <= most), least, block), "marks")
    crowded = cut.where(F.col("distinct") > most)
    if crowded.limit(1).count():
        marks = marks.union(_counted(crowded, least))
    places = shared.select("anchor", "digest", "windows", "copies", "distinct", "file", "at", "start", "more")
    # All windows of a segment that occurs twice are repeats, whatever else its anchor has.
    copied = places.where("copies > 1").withColumn("marks", F.lit(None).cast("binary"))
    compared = places.where("copies = 1").join(marks, ["anchor", "digest"]).select(*copied.columns)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each place of each segment that has marked windows."""
        for batch in batches:
            rows: list[tuple] = []
            names = ("windows", "file", "at", "start", "more", "marks")
            for n, file, at, start, more, bits in zip(
                    *(batch.column(c).to_pylist() for c in names), strict=True):
                rows.append((file, at, start, n, bits))
                if more:
                    rows += [(*p, n, bits) for p in np.frombuffer(more, PLACE).tolist()]
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)],
                    names=["file", "at", "start", "windows", "marks"])

    found = copied.union(compared).mapInArrow(
        spread, "file long, at long, start long, windows int, marks binary")
    return found.groupBy("file", "at").agg(
        F.collect_list(F.struct("start", "windows", "marks")).alias("found"))


def packed_texts(docs: DataFrame) -> DataFrame:
    """Replace ``text`` by ``packed``, its compressed form for shuffles."""
    kept = [c for c in docs.columns if c != "text"]
    schema = docs.select(*kept, F.lit(b"").alias("packed")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed = [tool.compress(t or b"") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(packed, pa.binary())],
                names=[*kept, "packed"])

    return docs.mapInArrow(run, schema)


def covered(size: int, found: list[dict], least: int) -> list[tuple[int, int]]:
    """The maximal runs of bytes that marked windows cover."""
    edge = np.zeros(size + 1, np.int32)
    for seg in found:
        start, n = seg["start"], seg["windows"]
        if seg["marks"] is None:
            edge[start] += 1
            edge[start + n + least - 1] -= 1
        else:
            bits = np.unpackbits(np.frombuffer(seg["marks"], np.uint8))
            at = start + np.flatnonzero(bits)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + least, -1)
    inside = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    return list(zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True))


def remove_repeats(
    docs: DataFrame, text_col: str = "text", least: int = LEAST, gram: int = GRAM, block: int = BLOCK,
) -> DataFrame:
    """Per document: ``row`` (its other columns), ``n_bytes``, ``spans`` (start and end of each removed
    run) and ``kept``, the remaining bytes."""
    if least < gram:
        raise ValueError("an anchor must fit into the shortest match")
    prepare(docs.sparkSession)
    rows = identified(docs).select(
        F.col("rid.file").alias("file"), F.col("rid.at").alias("at"), "row",
        F.col("row")[text_col].cast("binary").alias("text"))
    narrow = rows.select("file", "at", "text")
    found = repeats(narrow, least, gram, block)
    joined = packed_texts(rows.select(
        "file", "at", F.struct(*[F.col("row")[c].alias(c) for c in docs.columns if c != text_col])
        .alias("row"), "text") if len(docs.columns) > 1 else rows.select(
        "file", "at", F.struct(F.lit(0).alias("none")).alias("row"), "text")
    ).join(found, ["file", "at"], "left")

    schema = joined.select(
        "row", F.lit(0).cast("long").alias("n_bytes"),
        F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end")))
        .alias("spans"), F.lit(b"").alias("kept")).schema
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for packed, segs in zip(batch.column("packed").to_pylist(),
                                    batch.column("found").to_pylist(), strict=True):
                text = zstandard.decompress(packed)
                runs = covered(len(text), segs, least) if segs else []
                at, rest = 0, []
                for a, b in runs:
                    rest.append(text[at:a])
                    at = b
                sizes.append(len(text))
                spans.append([{"start": a, "end": b} for a, b in runs])
                kept.append(b"".join([*rest, text[at:]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(sizes, pa.int64()), pa.array(spans, span),
                 pa.array(kept, pa.binary())], names=["row", "n_bytes", "spans", "kept"])

    return joined.select("row", "packed", "found").mapInArrow(run, schema)


def digest(removed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    lengths = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return removed.select(
        F.col("row")[id_col].alias("doc_id"), "n_bytes", lengths.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
