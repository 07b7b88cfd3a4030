"""The Merkle manifest against a plain Python tree."""

import hashlib
import random
import zlib

from tidal.llm import merkle
from tidal.llm.ordering import numbered

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes, fan):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + fan]) for i in range(0, len(last), fan)])
    return levels


def way(levels, i, fan):
    """(left siblings, right siblings) of leaf ``i`` level by level."""
    out = []
    for level in levels[:-1]:
        first = i - i % fan
        out.append(("".join(level[first:i]), "".join(level[i + 1:first + fan])))
        i //= fan
    return out


def brute(rows, fan):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in groups[s]], fan)
    top = tree([trees[s][-1][0] for s in names], fan)
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            path = way(trees[s], i, fan) + way(top, k, fan)
            at = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                at = leaf((*r[:4], r[4].translate(LOWER)))
            for left, right in path:
                at = h(left, at, right)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], h(*[a + b for a, b in path]), at, at == top[-1][0]))
    return sorted(out, key=str)


def rows_of(n, seed, sources):
    rng = random.Random(seed)
    texts = ["Ab C", "lower only", "", None, "ÄÖ Ünï X", "Z" * 5000]
    return [(rng.randrange(n), rng.choice(sources), rng.choice(["en", None]), rng.choice([None, 5]), rng.choice(texts))
            for _ in range(n)]


def check(spark, rows, fan, every):
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA), fan, every).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows, fan)


def test_against_a_plain_tree(spark):
    # many sources, a hot one, null and empty names, repeated ids and rows, sizes about the powers of the fan
    rows = rows_of(180, 1, ["hot"] * 9 + ["", None, "é", "z", "Z"]) + [(None, "hot", None, None, "A")] * 3
    rows += [(7, "one", "en", 1, "X")] + [(i, "nine", "en", 1, "X") for i in range(9)] + [(i, "eight", "en", 1, "X") for i in range(8)]
    for fan, every in ((2, 3), (3, 1), (16, 2)):
        check(spark, rows, fan, every)


def test_one_source_and_full_runs(spark):
    check(spark, [(i, "s", "en", i, f"T{i}") for i in range(256)], 16, 2)
    check(spark, [(i, None, "en", i, f"T{i}") for i in range(257)], 16, 2)
    check(spark, [(1, "s", "en", 1, None)], 16, 2)


def test_empty_table_and_clashing_columns(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(i, "s", "en", 1, "A") for i in range(20)]
    wide = spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], SCHEMA + ", idx int, g int, path string, node string")
    assert sorted([tuple(r) for r in merkle.manifest(wide).collect()], key=str) == brute(rows, 16)


def test_places_with_equal_rows(spark):
    rows = [("a", 1)] * 500 + [("b", i) for i in range(7)] + [("a", None)]
    got = numbered(spark.createDataFrame(rows, "g string, x int").repartition(5), "g", ["x"]).collect()
    assert sorted(r.idx for r in got if r.g == "a") == list(range(501))
    assert [r.x for r in sorted((r for r in got if r.g == "b"), key=lambda r: r.idx)] == list(range(7))
    assert {r.x for r in got if r.g == "a" and r.idx == 0} == {None} and {r.total for r in got} == {501, 7}
