"""Word hashing and subwords against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa

from tidal.llm import common, subwords

TEXTS = ["", None, "one", "a b c d e f", "a b c d e", "x" * 3000, "  lead\tand\ntrail \r\n", "Äpfel ÄPFEL äpfel",
         "A a A a A a A a", "\x0b\x0c  ", "wörd " * 700, "same same same same same same"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_shingle_sets_match_plain_sets():
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choice("ab") for _ in range(rng.randrange(30))) for _ in range(200)]
    got = [None] * len(texts)
    for limit in (1 << 20, 64):
        for first, data, offsets in common.text_chunks(pa.array(texts), limit):
            h, rows = common.word_hashes(data, offsets)
            n = len(offsets) - 1
            for r, s in enumerate(common.distinct_by_row(*common.shingle_hashes(h, rows, n), n)):
                got[first + r] = s
        names = {}
        for text, s in zip(texts, got, strict=True):
            want = shingles(text)
            assert len(s) == len(want), text
            names.setdefault(frozenset(want), set()).add(tuple(s.tolist()))
        assert all(len(v) == 1 for v in names.values()) and len({next(iter(v)) for v in names.values()}) == len(names)


def test_chunks_of_sliced_arrays():
    column = pa.array(["ab", "c d", None, "efg"]).slice(1, 3)
    out = [bytes(d[o[i]:o[i + 1]]) for _, d, o in common.text_chunks(column, 2) for i in range(len(o) - 1)]
    assert out == [b"c d", b"", b"efg"]


def test_row_sums_equal_word_sums():
    table = np.random.default_rng(0).normal(size=1 << 12)
    for _, data, offsets in common.text_chunks(pa.array(TEXTS)):
        text, starts, ends, rows = subwords.padded(data, offsets)
        at, sums, counts = subwords.row_sums(text, starts, rows, [table], (2, 3, 4), 12)
        per_word, n = subwords.word_sums(text, starts, ends, table, (2, 3, 4), 12)
        flat, of = subwords.word_lists(text, starts, ends, (2, 3, 4), 12)
        for r, s, c in zip(at, sums[:, 0], counts, strict=True):
            assert np.isclose(s, per_word[rows == r].sum()) and c == n[rows == r].sum()
            assert np.isclose(s, table[flat[np.isin(of, np.flatnonzero(rows == r))]].sum())


def test_bitmap_holds_its_values(spark):
    values = list(range(-50, 500, 7))
    bits = common.bitmap(spark.createDataFrame([(v,) for v in values], "v bigint"))
    assert common.in_bitmap(bits, np.array(values)).all()
    assert common.in_bitmap(bits, np.arange(10_000, 60_000)).mean() < 0.01
    assert not common.in_bitmap(common.bitmap(spark.createDataFrame([], "v bigint")), np.arange(100)).any()
