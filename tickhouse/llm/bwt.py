"""Common prefixes of many strings from their Burrows-Wheeler transform, in numpy.

Used inside tasks on blocks of bounded size. ``repeated`` marks the positions whose next ``least``
symbols occur again in the block.
"""

from __future__ import annotations

import numpy as np


def suffix_ranks(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and its inverse by prefix doubling over packed symbols.

    ``symbols`` are small numbers; 0 ends a string, differs from every other 0, and comes last in
    the block. Each round sorts only the suffixes that are still tied.
    """
    n = len(symbols)
    bits = max(1, int(symbols.max()).bit_length())
    width = min(63 // bits, n)
    key = np.zeros(n, np.int64)
    alive = np.ones(n, bool)
    for j in range(width):
        key <<= bits
        key[:n - j] |= np.where(alive[:n - j], symbols[j:], 0)
        alive[:n - j] &= symbols[j:] != 0
        alive[n - j:] = False
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]]) | ~alive[order]
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = start
    single = new & np.concatenate([new[1:], [True]])
    slots = np.flatnonzero(~single)
    while len(slots):
        tied = order[slots]
        key = rank[tied] * n + rank[tied + width]
        by = np.argsort(key, kind="stable")
        tied, key = tied[by], key[by]
        order[slots] = tied
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[tied] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        slots = slots[~(new & np.concatenate([new[1:], [True]]))]
        width *= 2
    return order, rank


def short_prefixes(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Which neighbours in suffix order share fewer than ``least`` symbols, and the ranks.

    Breadth-first backward extension: the intervals of all strings of length ``t`` are extended by
    one symbol in front; an interval of a string of length ``t + 1`` whose right end has no common
    prefix yet gives it the value ``t`` and is extended in turn. Values thus come in increasing
    order and the search stops at ``least``; whatever has none by then shares ``least`` or more.
    """
    n = len(symbols)
    order, rank = suffix_ranks(symbols)
    before = order - 1
    last_symbol = symbols[before]
    step = rank[before]
    first = symbols[order]
    # Rows with the same last symbol before and after each row: their steps are adjacent.
    row_of = np.empty(n, np.int64)
    row_of[step] = np.arange(n)
    previous = np.full(n, -1, np.int64)
    following = np.full(n, n, np.int64)
    same = np.flatnonzero((first[1:] == first[:-1]) & (first[1:] != 0))
    previous[row_of[same + 1]] = row_of[same]
    following[row_of[same]] = row_of[same + 1]

    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    ends = np.flatnonzero(np.concatenate([first[1:] != first[:-1], [True]]) | (first == 0)) + 1
    left, right = np.concatenate([[0], ends[:-1]]), ends
    known[right] = True
    for _ in range(1, least):
        if not len(left):
            break
        size = right - left
        one = left[size == 1]
        one = step[one[last_symbol[one] != 0]]
        many = size > 1
        count = size[many]
        low, high = np.repeat(left[many], count), np.repeat(right[many], count)
        rows = low + np.arange(len(low)) - np.repeat(np.cumsum(count) - count, count)
        inside = last_symbol[rows] != 0
        rows, low, high = rows[inside], low[inside], high[inside]
        begin = np.sort(step[rows[previous[rows] < low]])
        end = np.sort(step[rows[following[rows] >= high]]) + 1
        left, right = np.concatenate([one, begin]), np.concatenate([one + 1, end])
        fresh = ~known[right]
        left, right = left[fresh], right[fresh]
        known[right] = True
    return known, rank


def repeated(strings: list[bytes], least: int) -> list[np.ndarray]:
    """For each string, which positions start ``least`` bytes that start elsewhere too."""
    data = np.frombuffer(b"".join(strings), np.uint8)
    present = np.zeros(256, np.int16)
    present[np.unique(data)] = 1
    code = np.cumsum(present).astype(np.int16)
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    ends = np.cumsum(lengths + 1) - 1
    symbols = np.zeros(len(data) + len(strings), np.int16)
    text = np.ones(len(symbols), bool)
    text[ends] = False
    symbols[text] = code[data]
    known, rank = short_prefixes(symbols, least)
    marks = ~known[rank] | ~known[rank + 1]
    return [marks[e - n:e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
