"""Conversation repair against an exhaustive search in plain Python."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tidal.llm import conversations as c
from tidal.llm import lattice

SCHEMA = "conv_id bigint, turn bigint, role string, text string"

def best(initials, faults):
    """(cost, audit) by dynamic programming from the end over (cost, audit) pairs."""
    grammar = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    n = len(initials)
    table = {}
    for i in range(n, -1, -1):
        here = {}
        for q in range(4):
            ways = [(0, "")] if i == n and q in (0, 3) else []
            if i < n:
                extra = int(faults[i] == lattice.CUT)
                cost, audit = table[i + 1][q]
                ways.append((cost + 3, "D" + audit))
                if faults[i] != lattice.BAD:
                    for role, q2 in grammar[q].items():
                        cost, audit = table[i + 1][q2]
                        if initials[i] == role:
                            ways.append((cost + extra, "K" + audit))
                        if role != "s":
                            ways.append((cost + extra + 2, "R" + audit))
            here[q] = ways
        done = {q: min(w) if w else (10**9, "") for q, w in here.items()}
        for _ in range(4):      # inserts within the layer
            for q in range(4):
                for role, q2 in grammar[q].items():
                    if role != "s":
                        done[q] = min(done[q], (done[q2][0] + 2, "I" + done[q2][1]))
        table[i] = done
    return table[0][0]


def brute(rows, damaged=True):
    """Expected results by conv_id."""
    groups = {}
    for conv, turn, role, text in rows:
        kept = groups.setdefault(conv, [])
        v = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 19
        role, text = " " if role is None else role, " " if text is None else text
        if v == 0:
            continue
        text = "" if v == 1 else re.sub("[.!?]", "", text) if v == 2 else text
        role = "user" if v == 4 else role
        kept += [(turn, role, text)] * (2 if v == 3 else 1)
    out = {}
    for conv, kept in groups.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults, counts = set(), [], [0, 0, 0]
        for _, role, text in kept:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            fault = 0 if not last else 1 if (role, text) in seen else 2 if last[0] not in ".!?" else None
            if fault is not None:
                counts[fault] += 1
            faults.append({0: lattice.BAD, 1: lattice.BAD, 2: lattice.CUT, None: lattice.SOUND}[fault])
            seen.add((role, text))
        initials = [r[1][:1] for r in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = {r[0] for r in kept if r[0] is not None}
        cost, audit = best(initials, faults)
        lines, state, at = [], "a", 0
        for step in audit:
            want = "a" if state == "u" else "u"
            if step == "K":
                lines.append(f"{kept[at][1]}:{kept[at][2]}")
                state = kept[at][1][:1]
            elif step in "RI":
                lines.append(f"{'user' if want == 'u' else 'assistant'}:{kept[at][2] if step == 'R' else ''}")
                state = want
            at += step != "I"
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def test_lattice_against_all_paths():
    rng = random.Random(2)
    short = [x for n in range(4) for x in itertools.product(range(lattice.CODES), repeat=n)]
    longer = [tuple(rng.randrange(lattice.CODES) for _ in range(rng.randrange(4, 40))) for _ in range(3000)]
    for codes in short + longer:
        cost, audit = best([{0: "s", 1: "u", 2: "a", 3: "x"}[x // 3] for x in codes], [x % 3 for x in codes])
        assert lattice.cost(bytes(codes)) == cost
        labels = lattice.trace(bytes(codes))
        assert "".join(labels) == audit
        roles = "".join(r[:1] for r, _ in lattice.apply(labels, [({0: "s", 1: "u", 2: "a", 3: "x"}[x // 3], "") for x in codes]))
        assert re.fullmatch("(s?(ua)+)?", roles)


def test_auction_prices_are_distances():
    """On a graph of its own: prices equal shortest distances, whatever valid prices it starts from."""
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randrange(3, 9)
        arcs = [[("", rng.randrange(1, 9), j) for j in range(n) if j != i and rng.random() < 0.5] + [("", 20, n - 1)] for i in range(n - 1)] + [[]]
        far = [10**6] * (n - 1) + [0]
        for _ in range(n):
            far = [min([x + far[j] for _, x, j in arcs[i]]) if arcs[i] else 0 for i in range(n)]
        price = [rng.randrange(0, min(far[:-1]) + 1)] * (n - 1) + [0]
        if any(price[i] > x + price[j] for i in range(n) for _, x, j in arcs[i]):
            price = [0] * n
        settled = {n - 1}
        for i in rng.sample(range(n - 1), n - 1):
            if i not in settled:
                lattice.auction(arcs, price, settled, i)
        assert price == far


def random_rows(n, seed, convs):
    rng = random.Random(seed)
    texts = ["One.", "Two!", "three", "", None, " \t", "four?  ", "ünï.", "five\x0b", "x" * 3000 + "."]
    return [(rng.choice(convs), rng.choice([None, *range(30)]), rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]),
             rng.choice(texts) if rng.random() < 0.4 else f"text {rng.randrange(10**6)}{rng.choice(['.', ''])}") for _ in range(n)]


def got(df):
    rows = [tuple(r) for r in df.collect()]
    found = {r[0]: r[1:] for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("large", [(1024, 1 << 18, 512), (20, 1 << 18, 7), (0, 0, 3), (5, 2000, 1)])
def test_against_brute_force(spark, monkeypatch, large):
    for name, value in zip(("LARGE_ROWS", "LARGE_BYTES", "BLOCK"), large):
        monkeypatch.setattr(c, name, value)
    rows = random_rows(600, 3, [None, 1, 2, 3, 4, 5, 5, 5, 5, 5, -6]) + [(100 + i, i % 3, "user", "A.") for i in range(80)]
    df = spark.createDataFrame([(*r, 1, "x", False) for r in rows], SCHEMA + ", g int, block string, gone boolean")
    assert got(c.repair(c.damage(df), "gone")) == brute(rows)


def test_null_columns_and_empty_table(spark):
    assert c.repair(c.damage(spark.createDataFrame([], SCHEMA)), "gone").count() == 0
    rows = [(None, None, None, None)] * 3 + [(1, None, "user", None), (2, 5, None, "Yes.")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(c.repair(df)) == brute(rows, damaged=False)
    assert got(c.repair(c.damage(df), "gone")) == brute(rows)


def test_repaired_turns_are_those_of_the_digest(spark, monkeypatch):
    monkeypatch.setattr(c, "LARGE_ROWS", 10)
    monkeypatch.setattr(c, "BLOCK", 4)
    rows = random_rows(120, 8, [1, 2, 2, 2, 3, 4, 5, 6, 7])
    df = spark.createDataFrame(rows, SCHEMA)
    turns = {}
    for r in sorted(c.repaired_turns(df).collect(), key=lambda r: (r.conv_id, r.block, r.place)):
        turns.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    want = brute(rows, damaged=False)
    assert {k: hashlib.sha256("\n".join(turns.get(k, [])).encode()).hexdigest() for k in want} == {k: v[-1] for k, v in want.items()}
