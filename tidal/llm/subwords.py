"""Hashed byte n-grams ("subwords") of text columns, shared by the toxicity and language models."""

from __future__ import annotations

import numpy as np

from tidal.llm.common import lower_ascii, word_spans

_STEP = np.uint32(0x01000193)
_SPREAD = np.uint32(0x9E3779B1)


def _grams(low: np.ndarray, order: int, bits: int, salt: int) -> np.ndarray:
    """Bucket of the ``order`` bytes from each place on (the last places are cut off)."""
    n = len(low) - order + 1
    x = np.full(max(n, 0), 0x811C9DC5 ^ (salt * 0x1000193 & 0xFFFFFFFF), np.uint32)
    for j in range(order if n > 0 else 0):
        x ^= low[j:j + n]
        x *= _STEP
    x ^= x >> np.uint32(15)
    return ((x * _SPREAD) >> np.uint32(32 - bits)).astype(np.int64)


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words joined by single spaces: (bytes, word starts, word ends, word rows)."""
    low = lower_ascii(data)
    starts, ends, rows = word_spans(low, offsets)
    lengths = ends - starts
    new_ends = np.cumsum(lengths + 1)
    new_starts = new_ends - lengths
    out = np.full(int(new_ends[-1]) + 1 if len(lengths) else 1, 0x20, np.uint8)
    src = np.arange(int(lengths.sum())) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    dst = np.arange(int(lengths.sum())) + np.repeat(new_starts - (np.cumsum(lengths) - lengths), lengths)
    out[dst] = low[src]
    return out, new_starts, new_ends, rows


def word_grams(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, orders: tuple[int, ...],
               bits: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order: (buckets from each byte on, first gram and number of grams of each word).

    A word's grams lie in the word with one space at either side; a shorter word has none.
    """
    out = []
    for order in orders:
        out.append((_grams(text, order, bits, order), starts - 1, np.maximum(ends - starts + 3 - order, 0)))
    return out


def word_sums(text, starts, ends, table: np.ndarray, orders, bits) -> tuple[np.ndarray, np.ndarray]:
    """Per word: the sum of ``table`` over its grams, and their number."""
    sums = np.zeros((len(starts),) + table.shape[1:], np.float64)
    counts = np.zeros(len(starts), np.int64)
    for buckets, first, n in word_grams(text, starts, ends, orders, bits):
        counts += n
        if not len(buckets):
            continue
        some = n > 0
        if not some.any():
            continue
        values = table[buckets]
        bounds = np.empty(2 * int(some.sum()), np.int64)
        bounds[0::2] = first[some]
        bounds[1::2] = first[some] + n[some]
        if bounds[-1] == len(values):
            bounds = bounds[:-1]
        sums[some] += np.add.reduceat(values, bounds, axis=0, dtype=np.float64)[0::2]
    return sums, counts


def row_sums(text, starts, rows, tables: list[np.ndarray], orders, bits) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows with words, sums of each table over their grams, number of grams).

    Orders are 2 or more. The grams of a row's words lie from the space before its first word up to that before the next
    row's; those with a space inside belong to no word and are left out.
    """
    edge = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    begin = starts[edge] - 1
    space = text == 0x20
    sums = np.zeros((len(edge), len(tables)))
    counts = np.zeros(len(edge), np.int64)
    for order in orders:
        buckets = _grams(text, order, bits, order)
        inside = np.zeros(len(buckets), bool)
        for j in range(1, order - 1):
            inside |= space[j:j + len(buckets)]
        kept = buckets[~inside]
        before = np.r_[0, np.cumsum(~inside)]
        first = before[np.minimum(begin, len(buckets))]
        n = np.diff(np.r_[first, len(kept)])
        some = n > 0
        counts += n
        for k, table in enumerate(tables):
            sums[some, k] += np.add.reduceat(table[kept], first[some], dtype=np.float64) if some.any() else 0
    return rows[edge], sums, counts


def word_lists(text, starts, ends, orders, bits) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of each word as (flat buckets, word of each)."""
    flat, words = [], []
    for buckets, first, n in word_grams(text, starts, ends, orders, bits):
        total = int(n.sum())
        at = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        flat.append(buckets[at])
        words.append(np.repeat(np.arange(len(n)), n))
    flat, words = np.concatenate(flat), np.concatenate(words)
    order = np.argsort(words, kind="stable")
    return flat[order], words[order]
