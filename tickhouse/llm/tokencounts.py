"""Token counts under a unigram model, by dynamic programming shared along a trie.

A document is cut into pre-tokens (words). The distinct pre-tokens that a task has not met before
are walked in sorted order, which is the depth-first order of their trie: forward scores are kept
on a stack by prefix length, so each shared prefix is scored once, and a pre-token's token count and
score are stored at its terminal. Documents then add up terminals. There is no shuffle; the store of
terminals is emptied when it reaches ``TERMINALS``.

The pieces come from a public vocabulary. Its file ranks them, and a piece of rank ``r`` has the
Zipf probability proportional to ``1 / (r + OFFSET)``. Pre-tokens carry the word mark in front. A
character that no piece covers is spelled in bytes, at one byte token each. Among segmentations of
equal score the one with fewer tokens counts.

Null texts count as empty (no tokens, score 0); repeated rows are counted each for themselves; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickhouse.llm.common import by_batch, numbered, texts_of

MARK = "\u2581"
OFFSET = 2.7
TERMINALS = 500_000


def public_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass(frozen=True)
class Pieces:
    """Log probabilities of pieces, the longest piece, and the score of one byte token."""

    scores: dict[str, float]
    longest: int
    byte: float


@lru_cache(maxsize=4)
def load(path: str) -> Pieces:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    total = math.log(sum(1 / (r + OFFSET) for r in range(len(plain))))
    scores = {model.id_to_piece(i): -math.log(r + OFFSET) - total for r, i in enumerate(plain)}
    least = -math.log(len(plain) + OFFSET) - total
    return Pieces(scores, max(map(len, scores)), least)


def shared_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def score_sorted(words: list[str], pieces: Pieces) -> list[tuple[int, float]]:
    """Token count and score of each word; ``words`` are sorted and distinct.

    ``best[d]`` is the forward state of the prefix of length ``d``: (score, -tokens). What the word
    shares with its predecessor is left as it is.
    """
    scores, longest = pieces.scores, pieces.longest
    best: list[tuple[float, int]] = [(0.0, 0)]
    last, out = "", []
    for word in words:
        shared = shared_prefix(last, word)
        del best[shared + 1:]
        for d in range(shared + 1, len(word) + 1):
            score, tokens = best[d - 1]
            width = len(word[d - 1].encode("utf-8", "replace"))
            top = (score + width * pieces.byte, tokens - width)
            for start in range(max(0, d - longest), d):
                own = scores.get(word[start:d])
                if own is not None:
                    score, tokens = best[start]
                    case = (score + own, tokens - 1)
                    if case > top:
                        top = case
            best.append(top)
        out.append((-best[-1][1], best[-1][0]))
        last = word
    return out


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
) -> DataFrame:
    """Per document: ``n_pretokens``, ``n_distinct``, ``n_tokens`` and ``log_score``."""
    path = vocabulary or public_pieces()
    rows = numbered(docs, doc_id=id_col, text=text_col).drop("rid")
    counts: dict[bytes, int] = {}
    scores: dict[bytes, float] = {}

    def step(batch: pa.RecordBatch) -> dict:
        split = [t.encode("utf-8", "replace").split() for t in texts_of(batch)]
        distinct = [set(words) for words in split]
        if len(counts) > TERMINALS:
            counts.clear()
            scores.clear()
        new = set().union(*distinct).difference(counts)
        ordered = sorted((MARK + w.decode(), w) for w in new)
        for (_, word), (n, score) in zip(
                ordered, score_sorted([w for w, _ in ordered], load(path)), strict=True):
            counts[word], scores[word] = n, score
        return {
            "doc_id": batch.column("doc_id"),
            "n_pretokens": np.array([len(w) for w in split], np.int64),
            "n_distinct": np.array([len(w) for w in distinct], np.int64),
            "n_tokens": np.array([sum(map(counts.__getitem__, w)) for w in split], np.int64),
            "log_score": np.array([sum(map(scores.__getitem__, w)) for w in split], np.float64),
        }

    kind = rows.schema["doc_id"].dataType.simpleString()
    return by_batch(
        rows, f"doc_id {kind}, n_pretokens long, n_distinct long, n_tokens long, log_score double",
        step)


def totals(counts: DataFrame, *keys: str) -> DataFrame:
    """Sums of the counts, for the whole table or by key; combined on the map side."""
    return counts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_pretokens").alias("n_pretokens"),
        F.sum("n_tokens").alias("n_tokens"), F.sum("log_score").alias("log_score"),
    )
