"""Quality rules as a bitmask ledger.

``ledger`` evaluates every rule once per document and stores the measurements with one failure bit
per rule. A policy is a version name and the set of rules it enforces, so trying another policy is
a bitwise test over the stored ledger, and ``ablations`` reads what each rule does from a count per
distinct bit pattern: at most ``2 ** len(RULES)`` rows, combined on the map side.

Words are runs of characters other than space and U+0009-U+000D. A null text has no words, an empty
document table gives an empty ledger, repeated rows are measured each for themselves, and further
columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.llm.common import by_batch, numbered, texts_of

WINDOW = 8
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``failed`` is SQL over the measurements; ``bit`` is the rule's place in the ledger for good."""

    bit: int
    name: str
    failed: str


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]


RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 20 * n_words"),
)
BASE = Policy("base", ("few_words", "repeated_windows"))
DEFAULT = Policy("1", ("few_words", "repeated_windows", "symbols"))
STRICT = Policy("1-strict", tuple(rule.name for rule in RULES))


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def _ranked(ids: np.ndarray, starts: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Exact numbers of the windows at ``starts`` by doubling ranks; used if hashes collide."""
    rank, width = ids, 1
    while width < WINDOW:
        after = np.concatenate([rank[width:], np.zeros(min(width, len(rank)), rank.dtype)])
        rank = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)[1]
        width *= 2
    return rank[starts] + doc[starts] * (int(rank.max()) + 1)


def _repeated(ids: np.ndarray, doc: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which words lie in a window that occurs twice or more in its document."""
    starts = np.flatnonzero(np.arange(len(ids)) + WINDOW <= ends[doc])
    hit = np.zeros(len(ids) + 1, np.int64)
    if not len(starts):
        return hit[:-1] > 0
    with np.errstate(over="ignore"):
        hashed, width = _mixed(ids), 1
        while width < WINDOW:
            factor = np.uint64(pow(0xD6E8FEB86659FD93, width, 2**64))
            hashed, width = hashed[:-width] * factor + hashed[width:], 2 * width
        keys = hashed[starts] ^ _mixed(doc[starts])
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    left, right = starts[order[:-1][same]], starts[order[1:][same]]
    if any((ids[left + k] != ids[right + k]).any() for k in range(WINDOW)) or (
        doc[left] != doc[right]
    ).any():
        keys = _ranked(ids, starts, doc)
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        left, right = starts[order[:-1][same]], starts[order[1:][same]]
    twice = np.union1d(left, right)
    hit[twice] += 1
    hit[twice + WINDOW] -= 1
    return np.cumsum(hit)[:-1] > 0


def _duplicate_lines(text: str) -> tuple[int, int]:
    seen, lines, repeated = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            if line in seen:
                repeated += 1
            seen.add(line)
    return lines, repeated


def _measure(batch: pa.RecordBatch) -> dict:
    texts = texts_of(batch)
    numbers, sizes, ids = _Numbers(), [], []
    chars, symbols = [], []
    for text in texts:
        data = text.encode("utf-8", "replace")
        words = data.split()
        sizes.append(len(words))
        ids.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        chars.append(len(text) - sum(map(text.count, SPACES)))
        symbols.append(sum(data.count(s) for s in SYMBOLS))
    lines = [_duplicate_lines(text) for text in texts]
    sizes = np.array(sizes, np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    repeated = _repeated(np.concatenate(ids), doc, np.cumsum(sizes))
    return {
        "doc_id": batch.column("doc_id"),
        "n_words": sizes,
        "word_chars": np.array(chars, np.int64),
        "n_symbols": np.array(symbols, np.int64),
        "n_lines": np.array([n for n, _ in lines], np.int64),
        "n_dup_lines": np.array([n for _, n in lines], np.int64),
        "n_repeat_words": np.bincount(doc[repeated], minlength=len(texts)).astype(np.int64),
    }


def failure_bits(rules: tuple[Rule, ...] = RULES) -> Column:
    bits = [F.when(F.expr(r.failed), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in rules]
    return reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long")


def ledger(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """One row per document: id, measurements and ``fail_bits``. One pass, no shuffle."""
    rows = numbered(docs, doc_id=id_col, text=text_col).drop("rid")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{name} long" for name in MEASURES)
    return by_batch(rows, schema, _measure).withColumn("fail_bits", failure_bits(rules))


def mask(policy: Policy, rules: tuple[Rule, ...] = RULES) -> int:
    bits = {rule.name: 1 << rule.bit for rule in rules}
    unknown = [name for name in policy.rules if name not in bits]
    if unknown:
        raise ValueError(f"policy {policy.version} names unknown rules: {', '.join(unknown)}")
    return sum(bits[name] for name in set(policy.rules))


def rejects(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy, rules)).cast("long")) != 0


def apply_policy(
    rows: DataFrame, policy: Policy = DEFAULT, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """The ledger with ``kept`` under one policy."""
    return rows.withColumn("kept", ~rejects(policy, rules))


def ablations(
    rows: DataFrame, policies: tuple[Policy, ...], rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Per policy and rule: documents kept by all its rules, kept without this one, rejected by
    this one alone, and rejected by this one at all. Read from the bit patterns of a ledger."""
    patterns = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    cases = [
        F.struct(
            F.lit(p.version).alias("policy"), F.lit(r.name).alias("rule"),
            F.lit(mask(p, rules)).cast("long").alias("mask"),
            F.lit(1 << r.bit).cast("long").alias("bit"),
        )
        for p in policies for r in rules if r.name in p.rules
    ]
    each = patterns.select("fail_bits", "n", F.inline(F.array(*cases)))
    failed = F.expr("fail_bits & mask")
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return each.groupBy("policy", "rule").agg(
        total(failed == 0).alias("kept"),
        total(F.expr("fail_bits & mask & ~bit") == 0).alias("kept_without"),
        total(failed == F.col("bit")).alias("only_this"),
        total(F.expr("fail_bits & bit") != 0).alias("failed"),
    )


def write_ledger(
    docs: DataFrame, folder: str, policies: tuple[Policy, ...] = (BASE, DEFAULT, STRICT), id_col: str = "doc_id",
    text_col: str = "text", rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Store the ledger below ``folder`` and the ablation counts of the policies beside it; returns the
    stored ledger, from which any further policy is read without measuring again."""
    spark = docs.sparkSession
    ledger(docs, id_col, text_col, rules).write.parquet(f"{folder}/ledger")
    stored_rows = spark.read.parquet(f"{folder}/ledger")
    ablations(stored_rows, policies, rules).coalesce(1).write.parquet(f"{folder}/ablations")
    return stored_rows


def keep_good(
    docs: DataFrame, policy: Policy = DEFAULT, text_col: str = "text"
) -> DataFrame:
    """The documents that a policy keeps, with all their columns. One pass, no shuffle.

    The whole row travels through the measuring step, so neither a join nor a unique id is needed.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"),
                        F.col(f"`{text_col}`").alias("text"))
    return apply_policy(ledger(whole), policy).where("kept").select("doc_id.*")
