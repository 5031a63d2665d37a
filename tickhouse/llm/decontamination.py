"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton is built over the words of all items. Documents stream through it word by word; the
state always stands for the longest run of words, ending here, that some item contains. A word is
hit if it lies in an occurrence of a window: ``WINDOW`` consecutive words of an item, or a whole
item that has fewer. A document is contaminated if words are hit and they are at least one in
``COVERAGE`` of its words.

Items are cut into shards of bounded size by hash; a shard's automaton is the only thing that is
broadcast, and each shard is one more narrow pass over the documents. There is no shuffle of
documents, and a run of words outside the shard's vocabulary costs one dictionary lookup a word.

Words are lower-cased (A-Z only) runs of letters, digits and non-ASCII characters. Null texts have
no words; items without words are ignored; an empty benchmark hits nothing; repeated item rows count
once per item id and a null item id is written as an empty string; repeated documents are judged
each for themselves; further columns are ignored.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.llm.common import by_batch, prepare, texts_of

WINDOW = 13
COVERAGE = 20
SHARD_BYTES = 2_000_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FOLD = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A
    else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton of word sequences; ``found`` names the windows of a state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        numbered = [
            (name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws])
            for name, ws in items if ws
        ]
        for _, ids in numbered:
            state = 0
            for word in ids:
                state = self._extend(state, word)
        #: Per state: (words of the window, item) of windows that end there.
        self.found: dict[int, dict[int, set[str]]] = {}
        self.shortest = min((min(len(ids), window) for _, ids in numbered), default=0)
        for name, ids in numbered:
            size, state, length = min(len(ids), window), 0, 0
            for position, word in enumerate(ids):
                state, length = self._step(state, length, word)
                while self.link[state] >= 0 and self.length[self.link[state]] >= size:
                    state = self.link[state]
                    length = self.length[state]
                if position + 1 >= size:
                    self.found.setdefault(state, {}).setdefault(size, set()).add(name)

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            q = nxt[last][word]
            return q if length[last] + 1 == length[q] else self._clone(last, word, q)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and word not in nxt[p]:
            nxt[p][word] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][word]
            link[new] = q if length[p] + 1 == length[q] else self._clone(p, word, q)
        return new

    def _clone(self, p: int, word: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = clone
        while p >= 0 and nxt[p].get(word) == q:
            nxt[p][word] = clone
            p = link[p]
        return clone

    def _step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """Longest match that ends with one more word."""
        nxt = self.next
        while state and word not in nxt[state]:
            state = self.link[state]
            length = self.length[state]
        if word in nxt[state]:
            return nxt[state][word], length + 1
        return 0, 0

    def match(self, text_words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of hit words (start, end) and the items whose windows occur."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        n = len(text_words)
        if not self.shortest or n < self.shortest:
            return spans, items
        get = self.vocabulary.get
        ids = np.fromiter(map(get, text_words, repeat(-1)), np.int64, n)
        # Runs of known words that are long enough to hold a window.
        outside = np.concatenate([[-1], np.flatnonzero(ids < 0), [n]])
        long = np.flatnonzero(np.diff(outside) > self.shortest)
        for start, end in zip(outside[long] + 1, outside[long + 1], strict=True):
            state = length = 0
            for position, word in enumerate(ids[start:end].tolist(), int(start)):
                state, length = self._step(state, length, word)
                if length < self.shortest:
                    continue
                v = state
                while v > 0:
                    for size, names in self.found.get(v, {}).items():
                        if size <= length:
                            items |= names
                            if spans and position + 1 - size <= spans[-1][1]:
                                first = min(spans[-1][0], position + 1 - size)
                                spans[-1] = (first, position + 1)
                            else:
                                spans.append((position + 1 - size, position + 1))
                    v = self.link[v]
        return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _shards(items: DataFrame, id_col: str, text_col: str, limit: int) -> list[Automaton]:
    """Automata over the items, each of at most about ``limit`` bytes of text."""
    rows = items.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    count = -(-size // limit)
    shard = F.pmod(F.xxhash64("item", "text"), F.lit(max(count, 1)))
    return [
        Automaton([(r["item"], words(r["text"]))
                   for r in rows.where(shard == k).orderBy("item", "text").collect()])
        for k in range(count)
    ]


def scan(
    docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Per document: ``row`` (all its columns), ``n_words``, hit ``spans`` (flat word positions:
    start, end, start, end, ...) and the ``items`` whose windows occur."""
    spark = prepare(docs.sparkSession)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{text_col}`").alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<long>").alias("spans"), F.array().cast("array<string>").alias("items"),
    )
    schema = rows.schema
    for automaton in _shards(items, item_id_col, item_text_col, shard_bytes) or [Automaton([])]:
        shared = spark.sparkContext.broadcast(automaton)

        def step(batch: pa.RecordBatch, shared=shared) -> dict:
            automaton = shared.value
            counts, spans, items = [], [], []
            before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(),
                         strict=True)
            for text, (old, names) in zip(texts_of(batch), before, strict=True):
                ws = words(text)
                found, more = automaton.match(ws)
                both = merged(found + list(zip(old[::2], old[1::2], strict=True)))
                counts.append(len(ws))
                spans.append([p for span in both for p in span])
                items.append(sorted(more | set(names)))
            return {
                "row": batch.column("row"), "text": batch.column("text"),
                "n_words": pa.array(counts, pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.int64())),
                "items": pa.array(items, pa.list_(pa.string())),
            }

        rows = by_batch(rows, schema, step)
    return rows


def n_hit() -> Column:
    ends = F.expr("aggregate(spans, struct(0L AS n, -1L AS start), (a, x) -> if(a.start < 0, "
                  "struct(a.n AS n, x AS start), struct(a.n + x - a.start AS n, -1L AS start)))")
    return ends["n"]


def contaminated(coverage: int = COVERAGE) -> Column:
    return (n_hit() > 0) & (F.lit(coverage) * n_hit() >= F.col("n_words"))


def report(scanned: DataFrame, id_col: str = "doc_id", coverage: int = COVERAGE) -> DataFrame:
    return scanned.select(
        F.col("row")[id_col].alias("doc_id"), "n_words", n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated(coverage).alias("contaminated"), "spans",
    )


def keep_clean(docs: DataFrame, items: DataFrame, coverage: int = COVERAGE, **names) -> DataFrame:
    """Documents that are not contaminated, unchanged."""
    scanned = scan(docs, items, **names)
    return scanned.where(~contaminated(coverage)).select("row.*")


def remove_spans(
    docs: DataFrame, items: DataFrame, *, min_words: int = WINDOW, coverage: int = COVERAGE,
    text_col: str = "text", **names,
) -> DataFrame:
    """All documents, without the text of hit spans that exceed a limit.

    A span goes if it has at least ``min_words`` words, and every span of a document goes if the
    document exceeds the coverage limit. White space around the cut is left as it is.
    """
    scanned = scan(docs, items, text_col=text_col, **names).withColumn("over", contaminated(coverage))

    def cut(text: str, spans: list[int], over: bool) -> str:
        pairs = [(a, b) for a, b in zip(spans[::2], spans[1::2], strict=True)
                 if over or b - a >= min_words]
        if not pairs:
            return text
        places = [m.span() for m in WORD.finditer(text)]
        kept, at = [], 0
        for a, b in pairs:
            kept.append(text[at:places[a][0]])
            at = places[b - 1][1]
        return "".join([*kept, text[at:]])

    def step(batch: pa.RecordBatch) -> dict:
        out = [
            None if text is None else cut(text, spans, over)
            for text, spans, over in zip(*(batch.column(n).to_pylist()
                                           for n in ("text", "spans", "over")), strict=True)
        ]
        return {"row": batch.column("row"), "text": pa.array(out, pa.string())}

    schema = scanned.select("row", "text").schema
    cleaned = by_batch(scanned.select("row", "text", "spans", "over"), schema, step)
    columns = [F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c)
               for c in docs.columns]
    return cleaned.select(*columns)
