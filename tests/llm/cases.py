"""Small document tables with the awkward cases."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def word_list(seed: int, n: int = 300) -> list[str]:
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcdefghijklmnoprstuvwz") for _ in range(rnd.randint(3, 9)))
            for _ in range(n)]


def rows() -> list[tuple]:
    """Nulls, empty texts, one very long text, ties, repeated rows, near and exact copies."""
    rnd, words = random.Random(7), word_list(7)
    long = " ".join(rnd.choice(words) for _ in range(30_000))
    plain = [" ".join(rnd.choice(words) for _ in range(60)) for _ in range(6)]
    near = plain[0].split()
    near[30] = "changed"
    texts = [
        None, "", " \n\t ", long, plain[0], plain[0], " ".join(near), plain[1] + "\n" + plain[2],
        plain[3] + "\n" + plain[2], "one two", "é ß 漢字 " * 30, plain[4], plain[5], "x" * 5000,
    ]
    out = [(i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    out += 2 * [(11, plain[4], "en", "s2", len(plain[4]))]  # repeated rows
    out += [(None, plain[5], None, None, None), (None, None, None, None, None)]
    return out


def frame(spark, data=None, extra: bool = False):
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA)
    if extra:  # names that operators use themselves
        for name in ("rid", "row", "fp", "node", "component", "removed", "kept", "file", "at", "queue",
                     "n_words", "spans", "items", "fail_bits", "mask", "line", "words"):
            df = df.selectExpr("*", f"'clash' AS {name}")
    return df
