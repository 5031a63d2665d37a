"""Mixture-controlled packing by deficit round-robin over source queues.

Every document becomes token ids and an end id, and joins the queue of its source. A window is a run
of ``window`` sequences. Windows are filled by deficit round-robin: a queue is owed its share of each
window, gets whole tokens, and carries what it is still owed into the next window. Token ``j`` of a
queue with weight ``w`` is due at ``(j + 1/2) / w``; serving by due time is that round-robin, and
what a queue was served before window ``k`` follows from ``k`` alone. So each task starts at its own
windows with the deficits that all earlier windows and partitions left, without a scan over them.
An exhausted queue leaves its share to the others. Default weights are the queues' own token counts:
every window then has the corpus mixture, within a token, and all queues end together.

All sequences are full but the last. Within a window the queues take turns in going first.

Tokens are computed once and written to the shared folder with the count that the same queue has
earlier in the same task; only counts per task and queue are shuffled. Queues are sources hashed
into ``MAX_QUEUES``, which bounds what the driver and each task hold; a null source is a queue of
its own. A null text is empty and gives its end id; an empty table gives no pieces; repeated rows
are packed each for themselves; further columns of the input are ignored.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from fractions import Fraction
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tickhouse.llm.common import prepare, shared_folder, texts_of

SEQUENCE = 1024
WINDOW = 64
END_ID = 0
MAX_QUEUES = 65_536
#: Bytes of text or ids that a task works on at once.
SLICE = 1 << 20
#: Offsets per task and queue that may be broadcast; beyond it the ids are shuffled to them.
BROADCAST_OFFSETS = 200_000


@dataclass(frozen=True)
class ByteBpe:
    """A public byte-level BPE vocabulary.

    ``ranks`` holds the vocabulary of ``vocabulary`` as ranks: the same ids several times faster.
    Texts that contain the string of a special token are left to the vocabulary file. ``special`` has
    these strings and ``size`` the number of ids, so that a task without such a text never holds it.
    """

    vocabulary: str
    ranks: str
    pattern: str
    special: tuple[str, ...]
    size: int

    @classmethod
    def of(cls, vocabulary: str, ranks: str, pattern: str) -> ByteBpe:
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(vocabulary)
        return cls(vocabulary, ranks, pattern,
                   tuple(t.content for t in whole.get_added_tokens_decoder().values()), whole.get_vocab_size())

    @classmethod
    def public(cls) -> ByteBpe:
        import public_tokenizers

        return cls.of(public_tokenizers.path("byte_bpe_50k.json"),
                      public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)

    @cached_property
    def _whole(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.vocabulary)

    @cached_property
    def _fast(self):
        import tiktoken

        with open(self.ranks, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return tiktoken.Encoding(
            "ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if any(token in text for token in self.special):
            return np.array(self._whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self._fast.encode_ordinary(text), np.uint32)


@lru_cache(maxsize=4)
def _encoder(model: ByteBpe) -> ByteBpe:
    return replace(model)


def sliced(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``SLICE`` bytes of a column: what a task makes of a batch is held
    several times over, in Python, in Arrow and on its way to Spark."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        parts = np.cumsum(sizes, dtype=np.int64) // SLICE
        first = np.flatnonzero(np.diff(parts, prepend=-1))
        for begin, end in zip(first.tolist(), [*first[1:].tolist(), len(sizes)][:len(first)], strict=True):
            yield batch.slice(begin, end - begin)


class Mixture:
    """What each queue is served, from the token counts and weights of the queues alone."""

    def __init__(self, totals: dict[int, int], weights: dict[int, int], sequence: int, window: int):
        self.queues = sorted(q for q, n in totals.items() if n)
        self.place = {q: i for i, q in enumerate(self.queues)}
        self.totals = [totals[q] for q in self.queues]
        self.weights = [weights[q] for q in self.queues]
        self.all, self.tokens = sum(self.totals), sequence * window
        self.windows = -(-self.all // self.tokens)
        self.before = lru_cache(maxsize=4096)(self._before)

    def _due(self, tokens: int) -> Fraction:
        """A time by which about so many tokens are due."""
        left, weight, start = tokens, sum(self.weights), Fraction(0)
        ends = sorted((Fraction(n, w), n, w) for n, w in zip(self.totals, self.weights, strict=True))
        done = 0
        for end, total, own in ends:
            if start + Fraction(left - done, weight) <= end:
                break
            done += weight * (end - start)
            start, weight = end, weight - own
        return start + Fraction(left - done, weight) if weight else start

    def _before(self, window: int) -> list[int]:
        """Tokens that each queue has been served when a window begins."""
        want = min(window * self.tokens, self.all)
        if want == self.all:
            return list(self.totals)
        due = self._due(want)
        # Tokens due up to then: (j + 1/2) / w <= due.
        served = [
            min(n, (2 * w * due.numerator + due.denominator) // (2 * due.denominator))
            for n, w in zip(self.totals, self.weights, strict=True)
        ]
        over = sum(served) - want
        if over < 0:
            heap = [(Fraction(2 * s + 1, w), i) for i, (s, w) in enumerate(
                zip(served, self.weights, strict=True)) if s < self.totals[i]]
            heapq.heapify(heap)
            for _ in range(-over):
                _, i = heapq.heappop(heap)
                served[i] += 1
                if served[i] < self.totals[i]:
                    heapq.heappush(heap, (Fraction(2 * served[i] + 1, self.weights[i]), i))
        elif over > 0:
            heap = [(-Fraction(2 * s - 1, w), -i) for i, (s, w) in enumerate(
                zip(served, self.weights, strict=True)) if s]
            heapq.heapify(heap)
            for _ in range(over):
                _, i = heapq.heappop(heap)
                served[-i] -= 1
                if served[-i]:
                    heapq.heappush(heap, (-Fraction(2 * served[-i] - 1, self.weights[-i]), i))
        return served

    def starts(self, window: int) -> list[int]:
        """Where each queue begins within a window; the queues take turns in going first."""
        before, after = self.before(window), self.before(window + 1)
        order = [(k + window) % len(self.queues) for k in range(len(self.queues))]
        at, out = 0, [0] * len(order)
        for i in order:
            out[i], at = at, at + after[i] - before[i]
        return out

    def find(self, i: int, position: int) -> int:
        """The window that serves a queue's token at a position."""
        low, high = 0, self.windows - 1
        guess = min(high, position * self.windows // self.totals[i])
        if self.before(guess)[i] <= position:
            low = guess
            step = 1
            while low + step <= high and self.before(low + step)[i] <= position:
                low, step = low + step, 2 * step
            high = min(high, low + step)
        else:
            high = guess
        while low < high:
            middle = (low + high + 1) // 2
            if self.before(middle)[i] <= position:
                low = middle
            else:
                high = middle - 1
        return low


def _tokenize(rows: DataFrame, model: ByteBpe, folder: str) -> DataFrame:
    """Ids of every document, written once; ``chunk`` and ``before`` place it within its queue."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    narrow = model.size <= 1 << 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, chunk, counts = _encoder(model), TaskContext.get().partitionId(), {}
        for batch in sliced(batches, "text"):
            queues = batch.column("queue").to_pylist()
            ids, sizes, before = [], [], []
            for queue, text in zip(queues, texts_of(batch), strict=True):
                tokens = np.append(encoder.encode(text), np.uint32(END_ID))
                before.append(counts.get(queue, 0))
                counts[queue] = before[-1] + len(tokens)
                sizes.append(len(tokens))
                ids.append(tokens.astype(np.uint16 if narrow else np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("queue"),
                 pa.array([chunk] * len(ids), pa.int64()), pa.array(before, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "queue", "chunk", "before", "doc_tokens", "ids"],
            )

    schema = f"doc_id {kind}, queue int, chunk long, before long, doc_tokens long, ids binary"
    rows.mapInArrow(run, schema).write.parquet(folder)
    return rows.sparkSession.read.parquet(folder)


def _queue(source) -> F.Column:
    return F.pmod(F.xxhash64(source), F.lit(MAX_QUEUES)).cast("int")


def pack(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    model: ByteBpe | None = None, weights: dict[str, int] | None = None,
    sequence: int = SEQUENCE, window: int = WINDOW, with_ids: bool = True,
) -> DataFrame:
    """Pieces of documents with their place in the sequences (and their ids).

    ``weights`` are integer target proportions by source; a source without one gets weight 1. None
    takes the corpus mixture.
    """
    spark = prepare(docs.sparkSession)
    model = model or ByteBpe.public()
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
        _queue(F.col(f"`{source_col}`")).alias("queue"),
    )
    tokens = _tokenize(rows, model, shared_folder(spark, "tokens"))
    counts = tokens.groupBy("queue", "chunk").agg(F.sum("doc_tokens").alias("n"))
    earlier = Window.partitionBy("queue").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select(
        "queue", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    # At most MAX_QUEUES rows.
    totals = {r["queue"]: r["n"] for r in counts.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    shares = dict(totals)
    if weights is not None:
        known = spark.createDataFrame(list(weights.items()), "source string, weight long")
        own = {r["queue"]: r["weight"] for r in known.groupBy(_queue(F.col("source")).alias("queue"))
               .agg(F.sum("weight").alias("weight")).collect()}
        shares = {q: own.get(q, 1) for q in totals}
    small = counts.limit(BROADCAST_OFFSETS + 1).count() <= BROADCAST_OFFSETS
    placed = tokens.join(F.broadcast(offsets) if small else offsets, ["queue", "chunk"])
    width = np.uint16 if model.size <= 1 << 16 else np.uint32
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
             "window"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixture = Mixture(totals, shares, sequence, window)
        starts = lru_cache(maxsize=4096)(mixture.starts)
        for batch in sliced(batches, "ids"):
            columns = {n: [] for n in ("row", *names[1:])}
            pieces = []
            for k, (queue, before, offset, size, ids) in enumerate(zip(
                *(batch.column(n).to_pylist()
                  for n in ("queue", "before", "offset", "doc_tokens", "ids")), strict=True)):
                i, at, done = mixture.place[queue], before + offset, 0
                w = mixture.find(i, at)
                values = np.frombuffer(ids, width).astype("<u4")
                while done < size:
                    while mixture.before(w + 1)[i] <= at + done:
                        w += 1
                    place = w * mixture.tokens + starts(w)[i] + at + done - mixture.before(w)[i]
                    length = min(size - done, mixture.before(w + 1)[i] - at - done,
                                 sequence - place % sequence)
                    piece = values[done:done + length]
                    pieces.append(piece)
                    for n, v in zip(columns, (k, done, length, zlib.crc32(piece.tobytes()), size,
                                              place // sequence, place % sequence, w), strict=True):
                        columns[n].append(v)
                    done += length
            out = [batch.column("doc_id").take(pa.array(columns["row"], pa.int64()))]
            out += [pa.array(columns[n], pa.int64()) for n in names[1:]]
            if with_ids:
                ends = np.cumsum([0, *map(len, pieces)]).astype(np.int32)
                out.append(pa.ListArray.from_arrays(
                    pa.array(ends), pa.array(np.concatenate(pieces).astype(np.int32))))
            yield pa.RecordBatch.from_arrays(out, names=names + ["ids"] * with_ids)

    kind = tokens.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names[1:])
    return placed.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))
