"""Mixing against targets computed step by step, and its edge cases."""

import math
import random

from tidal.llm import mixing


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Reshare the excess over the caps by weight until no source is above its cap."""
    names = sorted((k for k in sizes if k is not None), key=lambda k: k.encode()) + ([None] if None in sizes else [])
    w = {k: weights[i % len(weights)] for i, k in enumerate(names)}
    left, full, out = share * sum(sizes.values()), set(), {}
    while True:
        rest = [k for k in names if k not in full]
        if not rest:
            return out
        budget = left - sum(cap * sizes[k] for k in full)
        out |= {k: budget * w[k] / sum(w[x] for x in rest) for k in rest}
        above = [k for k in rest if out[k] > cap * sizes[k]]
        if not above:
            return out
        full |= set(above)
        out |= {k: cap * sizes[k] for k in above}


def run(frame, rows):
    docs = frame([(d, t, s, 1) for d, t, s in rows], "doc_id bigint, text string, source string, size int")
    return mixing.mix_documents(docs).collect()


def test_targets_and_words_taken(spark, frame):
    rng = random.Random(2)
    rows = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(int(rng.lognormvariate(3, 1)))), s)
            for i, s in enumerate(rng.choices(["a", "b", "B", "é", "z", None], [9, 3, 1, 1, 2, 1], k=900))]
    rows += [(9000, "", "a"), (9001, None, "b"), (9002, " \t\n", None), (None, "one two three", "a")]
    got = run(frame, rows)
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9)
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, words in taken.items():
        assert abs(words - want[s]) <= 0.005 * want[s] + 3, s
    again = run(frame, rows[::-1])
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.copies)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_rates_solve_the_dual(spark, frame):
    rows = [(i, "w " * (1 + i % 37), "s" if i % 3 else "t") for i in range(400)]
    got = run(frame, rows)
    for s in ("s", "t"):
        mine = [r for r in got if r.source == s]
        assert math.isclose(sum(r.rate * r.size for r in mine), mine[0].target, rel_tol=1e-5)
        if 0 < mine[0].rate < 2:
            # the log odds of the rates are proportional to the sizes
            slopes = {round(math.log(r.rate / (2 - r.rate)) / r.size, 6) for r in mine}
            assert max(slopes) - min(slopes) < 1e-5


def test_few_documents_come_near_their_target(spark, frame):
    """Twenty sources of fifty documents of very different sizes, some of them repeated: within half a percent."""
    rng = random.Random(11)
    rows = [(i, "w " * int(rng.lognormvariate(5, 1.2) + 1), f"src{i % 20}") for i in range(1000)] + [(3, "w w w", "src3")] * 4
    got = run(frame, rows)
    words, target = {}, {}
    for r in got:
        words[r.source], target[r.source] = words.get(r.source, 0) + r.taken, r.target
        assert 0 <= r.copies <= 2
    for s, t in target.items():
        assert abs(words[s] - t) <= 0.005 * t, (s, words[s], t)


def test_edges(spark, frame):
    assert run(frame, []) == []
    one = run(frame, [(1, "only one document here", "s")])
    assert [(r.source_size, r.target) for r in one] == [(4, 6.0)] and one[0].taken in (4, 8)
    none = run(frame, [(1, "", "s"), (2, None, None)])
    assert [(r.size, r.target, r.taken) for r in none] == [(0, 0.0, 0)] * 2


def test_copies_with_all_columns(spark, frame):
    rows = [(i, "w " * (i % 9), "ab"[i % 2], i) for i in range(60)]
    docs = frame(rows, "doc_id bigint, text string, source string, lam int")
    got = mixing.mixed_copies(docs).collect()
    plain = {r.doc_id: r.copies for r in mixing.mix_documents(docs).collect()}
    seen = {}
    for r in got:
        assert r.lam == r.doc_id and 1 <= r.copy <= r.copies == plain[r.doc_id]
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {d: c for d, c in plain.items() if c}
