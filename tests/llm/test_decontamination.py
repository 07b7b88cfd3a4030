"""Spaced seeds: planted passages with replaced words are found, unrelated texts aren't."""

import random

import numpy as np

from tidal.llm import decontamination as d


def prose(rng, n):
    return [rng.choice("the of and".split()) if rng.random() < 0.3 else "".join(rng.choices("abcdefgh", k=5)) for _ in range(n)]


def test_finds_passages_with_replaced_words(spark, frame):
    rng = random.Random(3)
    items = [(i, prose(rng, rng.randint(14, 50))) for i in range(20)]
    rows, planted = [], set()
    for k in range(60):
        text = prose(rng, rng.randint(0, 300))
        if k % 3 == 0:
            i, words = items[k % 20]
            words = [f"x{j}" if j % 7 == 3 else w for j, w in enumerate(words)]
            at = rng.randint(0, len(text))
            text = text[:at] + [w.upper() if k % 2 else w + "," for w in words] + text[at:]
            planted.add((k, i))
        rows.append((k, " ".join(text), "extra"))
    rows += [(900, "", "e"), (901, None, "e"), (None, " ".join(items[0][1]), "e"), (902, " ".join(items[0][1]) * 1, "e"),
             (902, " ".join(items[0][1]), "e"), (903, "w " * 40_000, "e")]
    planted.add((902, 0))
    bench = frame([(i, " ".join(w)) for i, w in items] + [(50, ""), (51, None), (52, "too short"), (None, "x y z")],
                  "item_id bigint, text string")
    got = d.contaminated(frame(rows, "doc_id bigint, text string, tokens string"), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted and len(got) == len(planted)
    for r in got:
        assert r.matched >= min(12, 0.8 * r.item_tokens) and r.coverage == r.matched / r.item_tokens


def test_short_items_need_all_their_words(spark, frame):
    bench = frame([(1, "alpha beta gamma delta epsilon zeta")], "item_id bigint, text string")
    docs = frame([(1, "x alpha beta gamma delta epsilon zeta y"), (2, "alpha beta gamma delta epsilon eta")])
    assert [r.doc_id for r in d.contaminated(docs, bench).collect()] == [1]


def test_very_short_items_are_whole_documents(spark, frame):
    bench = frame([(1, "two words"), (2, "One!"), (3, "a b c d")], "item_id bigint, text string")
    docs = frame([(1, "Two, words"), (2, "here are two words"), (3, "one"), (4, "a b c d"), (5, "a b c d e"), (6, "two words two words")])
    assert {(r.doc_id, r.item_id) for r in d.contaminated(docs, bench).collect()} == {(1, 1), (3, 2), (4, 3)}


def test_recall_against_every_alignment(spark, frame):
    """All overlaps of a small fixture, found by trying every alignment of every document with every item."""
    rng = random.Random(8)
    items = {i: prose(rng, rng.randint(14, 40)) for i in range(12)}
    docs = {}
    for k in range(150):
        text = prose(rng, rng.randint(0, 80))
        if k % 2:
            words = items[rng.randrange(12)]
            a = rng.randrange(len(words))
            part = words[a:a + rng.randint(10, 40)]
            part = ["other" if rng.random() < 0.1 else w for w in part]
            at = rng.randint(0, len(text))
            text = text[:at] + part + text[at:]
        docs[k] = text
    want, doubtful = set(), set()
    for k, text in docs.items():
        for i, words in items.items():
            best = None
            for shift in range(-len(words) + 1, len(text)):
                lo, hi = max(0, -shift), min(len(words), len(text) - shift)
                same = np.array([text[shift + j] == words[j] for j in range(lo, hi)], bool)
                if same.sum() >= 8:
                    a, b, equal = d.best_segment(same)
                    need = min(12, -(-4 * len(words) // 5))
                    if equal >= need and 4 * equal >= 3 * (b - a):
                        best = max(best or 0, equal)
                        # a run of equal tokens as long as a mask is always hit; substitutions may hide a shorter one
                        runs = "".join("1" if x else "0" for x in same[a:b]).split("0")
                        if max(map(len, runs)) < d.SPAN:
                            doubtful.add((k, i))
            if best:
                want.add((k, i))
    got = {(r.doc_id, r.item_id) for r in d.contaminated(frame([(k, " ".join(t)) for k, t in docs.items()]),
                                                         frame([(i, " ".join(w)) for i, w in items.items()], "item_id bigint, text string")).collect()}
    assert got <= want and want - doubtful <= got
    assert len(got) >= 0.95 * len(want) and len(want) > 30, (len(got), len(want))


def test_empty_tables(spark, frame):
    empty = frame([], "item_id bigint, text string")
    assert d.contaminated(frame([(1, "a b c")]), empty).count() == 0
    assert d.contaminated(frame([]), frame([(1, "a " * 20)], "item_id bigint, text string")).count() == 0


def test_best_segment_by_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(300):
        same = rng.random(rng.integers(1, 25)) < 0.7
        score = lambda a, b: sum(1 if x else -2 for x in same[a:b])  # noqa: E731, B023
        best = max(score(a, b) for a in range(len(same) + 1) for b in range(a, len(same) + 1))
        a, b, equal = d.best_segment(same)
        assert score(a, b) == best and equal == same[a:b].sum()
