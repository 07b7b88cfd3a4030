"""The n-gram join against all pairs in plain Python, and its edge cases."""

import random

from test_text import shingles

from tidal.llm import components, ngram_join


def brute(rows):
    """{(doc_id, text): least doc_id reachable} by comparing all pairs of texts."""
    sets = {t: shingles(t) for _, t in rows}
    texts = list(sets)
    parent = {t: t for t in texts}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t
    for i, a in enumerate(texts):
        for b in texts[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                parent[root(a)] = root(b)
    least = {}
    for d, t in rows:
        if d is not None:
            least[root(t)] = min(d, least.get(root(t), d))
    return {(d, t): (least.get(root(t)) if sets[t] else d) for d, t in rows}


def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows, i = [], 0
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 20, 60, 150]))]
        if rng.random() < 0.5:
            base += passage
        for _ in range(rng.choice([1, 2, 9])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                copy += [rng.choice(vocabulary) for _ in range(rng.randrange(1, 1 + len(copy) // 4 + 1))]
            rows.append((1000 - i, " ".join(copy)))
            i += 1
    # a chain: each text links with the next, the ends don't
    chain = [f"c{k}" for k in range(70)]
    rows += [(2000 + k, " ".join(chain[2 * k:2 * k + 50])) for k in range(10)]
    return rows


def test_matches_all_pairs(spark, frame):
    rows = corpus()
    rows += [(rows[0][0], rows[0][1]), (3000, ""), (3001, None), (3002, " \n"), (3003, "Hi There"), (3004, "hi  there"),
             (3005, "hi"), (None, rows[0][1]), (None, "nobody else has this text at all"), (3006, "long " * 5000)]
    docs = frame([(d, t, "x", "y") for d, t in rows], "doc_id bigint, text string, n string, component_id string")
    got = ngram_join.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    want = brute([(d, t or "") for d, t in rows])
    assert (sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in got)
            == sorted((d or -1, len(shingles(t)), want[(d, t or "")] or -1) for d, t in rows))


def test_hot_shingles_are_salted_and_still_linked(spark, frame):
    rows = corpus()
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(frame(rows), hot_over=2.0).collect()}
    want = brute(rows)
    assert got == {d: want[(d, t)] for d, t in rows}


def test_empty_table(spark, frame):
    assert ngram_join.near_duplicates(frame([])).collect() == []
    assert ngram_join.keep_one(frame([])).collect() == []


def test_keep_one_keeps_all_columns_and_one_of_each(spark, frame):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(5, long, "a"), (3, long + " more", "b"), (3, long + " more", "b"), (9, "", "c"), (9, "", "c"), (8, None, "d"),
            (None, long, "e"), (None, "alone here", "f"), (None, "alone here", "f"), (7, "other words entirely", "g")]
    got = ngram_join.keep_one(frame(rows, "doc_id bigint, text string, _x string")).collect()
    assert sorted((r.doc_id or -1, r._x) for r in got) == [(-1, "f"), (3, "b"), (7, "g"), (8, "d"), (9, "c")]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(200, 260)] + [(5, 5), (None, 7), (300, 301)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    want = {i: 0 for i in range(41)} | {k: 100 for k in [100, *range(200, 260)]} | {300: 300, 301: 300}
    assert got == want
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
