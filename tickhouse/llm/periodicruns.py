"""Periodic runs of words, found by recursive frequency splitting and a lag scan.

A run is a maximal stretch of words that repeats with its smallest period ``q`` over at least
``max(SHORTEST, REPEATS * q)`` words. Every word of a run therefore occurs at least ``REPEATS`` times
in it. A word that occurs less often in its segment belongs to no run and splits the segment; the
pieces are counted anew, since a word that was frequent in the whole may be rare in a piece, until
nothing splits. Ordinary prose is gone after two or three rounds.

Surviving segments are scanned for lags. For each window size ``s`` (1, 2, 4 ...) equal windows get
equal numbers, made from the numbers of their halves, and each place looks up the lag to the next
equal window. Inside a run of period ``q`` with ``s / 2 < q <= s`` that lag is exactly ``q`` (a nearer
equal window would give the run a smaller period), and it stops being ``q`` where the run stops, so a
streak of equal lags is a maximal run. The scan takes time of order ``n log(n)^2``, also on one long
segment of few words.

Collapsing drops every word that some run contains after its first ``q`` words.

Null and empty texts have no words, no runs and an empty collapsed text. Repeated rows, equal ids and
null ids are rows of their own. Further columns are ignored. An empty table gives an empty result. A
text is worked on as a whole by one task, since runs never leave their text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.llm.common import by_batch, prepare

SHORTEST = 6
REPEATS = 4
WORD_GAP = r"[\x20\x09-\x0D]+"


def _starts(new: np.ndarray) -> np.ndarray:
    """Segment numbers from the marks of first elements."""
    return np.cumsum(new) - 1


def stable_segments(words: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that no rare word removes, and the segment that each belongs to.

    ``words`` are word numbers; ``segment`` (not falling) tells where the first segments are.
    """
    done_places, done_segments, made = [], [], 0
    places = np.arange(len(words))
    vocabulary = int(words.max()) + 1 if len(words) else 1
    while len(places):
        _, which, counts = np.unique(segment * vocabulary + words[places],
                                     return_inverse=True, return_counts=True)
        stays = counts[which] >= REPEATS
        touched = np.bincount(segment, ~stays) > 0
        stable = ~touched[segment]
        if stable.any():
            done_places.append(places[stable])
            done_segments.append(segment[stable] + made)
            made += int(segment[-1]) + 1
        left = stays & ~stable
        places, segment = places[left], segment[left]
        if not len(places):
            break
        segment = _starts(np.r_[True, (np.diff(places) > 1) | (np.diff(segment) > 0)])
        long = np.bincount(segment)[segment] >= SHORTEST
        places, segment = places[long], segment[long]
    if not done_places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    places, segment = np.concatenate(done_places), np.concatenate(done_segments)
    order = np.argsort(places)
    places, segment = places[order], segment[order]
    long = np.bincount(segment)[segment] >= SHORTEST
    places, segment = places[long], segment[long]
    return places, _starts(np.r_[True, np.diff(segment) != 0]) if len(segment) else segment


def _streaks(at: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, size and lag of each stretch of neighbouring places with one lag."""
    new = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (np.diff(lag) != 0)])
    return at[new], np.diff(np.r_[new, len(at)]), lag[new]


def lag_scan(words: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs inside segments, by start and period."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    sizes = np.bincount(segment) if len(segment) else np.empty(0, np.int64)
    ends = np.cumsum(sizes)
    at = np.arange(len(words))
    number = np.unique(segment * (int(words.max()) + 1) + words, return_inverse=True)[1] if len(words) else words
    window = 1
    while len(at):
        order = np.argsort(number, kind="stable")
        again = np.flatnonzero(np.diff(number[order]) == 0)
        lag = np.zeros(len(at), np.int64)
        lag[order[again]] = at[order[again + 1]] - at[order[again]]
        hits = (2 * lag > window) & (lag <= window)
        if hits.any():
            start, streak, period = _streaks(at[hits], lag[hits])
            length = streak + window + period - 1
            whole = length >= np.maximum(SHORTEST, REPEATS * period)
            found.append((start[whole], length[whole], period[whole]))
        # The next windows hold two of these; their periods are over half their size.
        bottom = np.full(len(words), -1, np.int64)
        bottom[at] = number
        wide = (at + 2 * window <= ends[segment[at]]) & (sizes[segment[at]] >= REPEATS * (window + 1))
        at = at[wide]
        if len(at):
            pair = bottom[at] * (int(number.max()) + 1) + bottom[at + window]
            number = np.unique(pair, return_inverse=True)[1]
        window *= 2
    if not found:
        return (np.empty(0, np.int64),) * 3
    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def runs_of(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs; ``text`` numbers the text that each word belongs to."""
    places, segment = stable_segments(words, text)
    start, length, period = lag_scan(words[places], segment)
    return places[start], length, period


def _step(batch: pa.RecordBatch) -> dict:
    split = [t.encode("utf-8", "replace").split() if t else [] for t in batch.column("text").to_pylist()]
    known: dict[bytes, int] = {}
    sizes = np.array([len(words) for words in split], np.int64)
    first = np.cumsum(sizes) - sizes
    numbers = np.fromiter((known.setdefault(w, len(known)) for words in split for w in words),
                          np.int64, int(sizes.sum()))
    text = np.repeat(np.arange(len(split)), sizes)
    start, length, period = runs_of(numbers, text)
    owner = text[start]
    edges = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    kept = np.cumsum(edges[:-1]) == 0
    collapsed = []
    shrunk = set(owner.tolist())
    for i, words in enumerate(split):
        if i in shrunk:
            words = [w for w, k in zip(words, kept[first[i]:first[i] + sizes[i]].tolist(), strict=True) if k]
        collapsed.append(b" ".join(words).decode("utf-8"))
    runs = pa.ListArray.from_arrays(
        np.searchsorted(owner, np.arange(len(split) + 1)).astype(np.int32),
        pa.StructArray.from_arrays(
            [pa.array(x, pa.int64()) for x in (start - first[owner], length, period)],
            names=["start", "length", "period"]),
    )
    return {"doc_id": batch.column("doc_id"), "n_words": pa.array(sizes, pa.int64()), "runs": runs,
            "collapsed": collapsed}


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``runs`` (by start, then period) and ``collapsed``."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = rows.select(
        "doc_id", F.lit(0).cast("long").alias("n_words"),
        F.lit(None).cast("array<struct<start:long,length:long,period:long>>").alias("runs"),
        F.col("text").alias("collapsed"),
    ).schema
    return by_batch(rows, schema, _step)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; the earlier one of equals; null for none."""
    return F.aggregate(
        F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))), F.get(runs, F.lit(0)),
        lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run)
        .otherwise(best),
    )


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` by the query's contract: a tenth of the texts repeat themselves from some word on."""
    code, size = F.crc32(F.col("doc_id").cast("string")), F.size("words")
    seed = F.floor(code / 10)
    begin = F.pmod(seed, F.greatest(size, F.lit(1)))
    words = F.when(code % 10 == 0, F.filter(F.split("text", WORD_GAP), lambda w: w != ""))
    steps = docs.select("doc_id", "text", words.alias("words")).select(
        "doc_id", "text", "words", begin.cast("int").alias("begin"),
        (F.floor((size - begin) / (3 + seed % 8)) + 1).cast("int").alias("period"))
    rest = F.size("words") - F.col("begin")
    unit = F.slice("words", F.col("begin") + 1, F.col("period"))
    again = F.array_repeat(unit, F.ceil(rest / F.col("period")).cast("int"))
    changed = F.concat(F.slice("words", F.lit(1), F.col("begin")), F.slice(F.flatten(again), F.lit(1), rest))
    return steps.select("doc_id", F.when(F.size("words") > 0, F.array_join(changed, " "))
                        .otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """The query's columns."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat_ws("", F.transform(lines, lambda line: F.concat(line, F.lit("\n"))))
    return found.withColumn("best", strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")],
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
