"""Fingerprints against the texts and exact similarities computed in plain Python."""

import collections
import hashlib
import random
import re

from tidal.llm import fingerprints as f


def edited(text, after):
    n = len(text)
    return text[:n - n // 2] + after[:n // 2]


def likeness(a, b):
    a, b = (collections.Counter(re.findall(r"[^\x20\x09-\x0D]+", x.lower())) for x in (a, b))
    total = sum((a | b).values())
    return sum((a & b).values()) / total if total else 1.0


SCHEMA = "doc_id bigint, text string, block int, fingerprint string"


def compared(got, rows):
    """The edited texts are as expected; the errors of the likenesses."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    errors = []
    for (d, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        t, after = t or "", after or ""
        r, e = got[d], edited(t, after)
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        for value, want in ((r.near_edited, likeness(t, e)), (r.near_next, likeness(t, after))):
            assert 0 <= value <= 1
            errors.append(value - want)
    return errors


def test_edited_texts_and_likeness(spark, frame, monkeypatch):
    plain = f._block
    monkeypatch.setattr(f, "_block", lambda ids: plain(ids, rows_per_block=7, segments=5))
    rng = random.Random(5)
    means, squares, n = [], 0.0, 0
    # the draws of a term are shared by all texts that hold it, so errors are independent only between vocabularies
    for k in range(12):
        words = [f"w{k}ö{i}" for i in range(60)] + [f"the{k}"] * 20
        rows = [(rng.randrange(-10**6, 10**6), " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for _ in range(60)]
        if k == 0:
            rows += [(5_000_000, ""), (5_000_001, "äöü😀 x"), (5_000_002, None), (5_000_003, "w " * 20_000), (None, "no id here")]
        rows = list(dict(rows).items())
        got = {r.doc_id: r for r in f.fingerprint_documents(frame([(d, t, 1, "z") for d, t in rows], SCHEMA)).collect()}
        assert len(got) == len(rows)
        errors = compared(got, rows)
        means.append(sum(errors) / len(errors))
        squares, n = squares + sum(e * e for e in errors), n + len(errors)
    assert abs(sum(means) / len(means)) < 0.03
    assert squares / n < 0.25 / f.SAMPLES * 2


def test_equal_texts_have_equal_fingerprints(spark, frame):
    got = f.fingerprint_documents(frame([(i, t) for i, t in enumerate(["a b c", "a b c", "A  b\nc", "", None, " "])])).collect()
    prints = {r.doc_id: r.fingerprint for r in got}
    assert prints[0] == prints[1] == prints[2] and prints[3] == prints[4] == prints[5] != prints[0]
    assert next(r.near_next for r in got if r.doc_id == 0) == 1.0 and next(r.near_next for r in got if r.doc_id == 3) == 1.0


def test_small_and_repeated_tables(spark, frame):
    assert f.fingerprint_documents(frame([])).count() == 0
    one = f.fingerprint_documents(frame([(7, "just one text")])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(edited("just one text", "just one text").encode()).hexdigest()
    assert one[0].near_next == 1.0
    assert f.fingerprint_documents(frame([(1, "same"), (1, "same"), (1, "other")])).count() == 3


def test_collisions_are_generalised_jaccard(spark, frame):
    """Many samples of two weighted sets: the share of equal ones tends to sum(min) / sum(max)."""
    a, b = {1: 3, 2: 1, 3: 5, 4: 2}, {1: 1, 2: 4, 3: 5, 5: 2}
    rows = [(0, t, a.get(t, 0), b.get(t, 0)) for t in range(1, 6)]
    terms = spark.createDataFrame(rows, "k int, term bigint, x int, y int")
    r = f.signatures(terms, ["k"], ["x", "y"], samples=2000).first()
    same = sum(r.x[i:i + f.HEX] == r.y[i:i + f.HEX] for i in range(0, len(r.x), f.HEX)) / 2000
    want = sum(min(a.get(t, 0), b.get(t, 0)) for t in range(6)) / sum(max(a.get(t, 0), b.get(t, 0)) for t in range(6))
    assert abs(same - want) < 0.04
