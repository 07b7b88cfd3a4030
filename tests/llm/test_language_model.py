"""The language model: exact counts and base scores, normalised probabilities, plain-Python scores, held-out gain."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidal.llm import language_model as m

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [None]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def brute(rows):
    """(doc_id, held out, tokens, known, N, base) of every row."""
    c = collections.Counter(w for d, t in rows if not held(d) for w in words(t))
    n, v = sum(c.values()), len(c)
    out = []
    for d, t in rows:
        ws = words(t)
        out.append((d, held(d), len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)))
    return sorted(out, key=str)


def some_rows(n=150, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"wört{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(vocabulary[:1 + rng.randrange(60)]) for _ in range(rng.randrange(30)))) for i in range(n)]
    return rows + [(None, "only HERE"), (None, None), (7, ""), (7, "A a a"), (8, "x" * 10000), (9, " \t"), (10, "never seen " * 50)] + [(3, "copy it")] * 40


@pytest.mark.parametrize("table", [m.TABLE, 8, 0])
def test_base_scores_are_exact(spark, frame, table):
    rows = some_rows()
    df = frame([(d, t, 1, "z", 2.0) for d, t in rows], "doc_id bigint, text string, c int, h string, score double").repartition(4)
    got = m.score_documents(df, words=6, table=table).collect()
    assert got[0].__fields__ == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted((tuple(r)[:-1] for r in got), key=str)
    want = brute(rows)
    key = [g[:5] for g in got]
    assert sorted(key, key=str) == sorted((w[:5] for w in want), key=str)
    for g, w in zip(sorted(got, key=lambda r: (str(r[:5]), r[5])), sorted(want, key=lambda r: (str(r[:5]), r[5])), strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9)


def test_no_training_rows_and_empty_table(spark, frame):
    assert m.score_documents(frame([])).count() == 0
    apart = next(i for i in range(1000) if held(i))
    row = m.score_documents(frame([(apart, "two words")])).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0) and row.score <= 0
    row = m.score_documents(frame([(1, None)])).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (1, 1, 1)


def model_of(spark, frame, rows, **options):
    df = frame(rows)
    return df, m.fit(df, ~m.held_out("doc_id", 10, 0), **options)


def test_probabilities_add_up_to_one(spark, frame):
    _, model = model_of(spark, frame, some_rows(), words=40)
    v, p = model.vocabulary, model.parameters
    everything = np.arange(v.size + m.ENDINGS, dtype=np.int32)
    for w1, w2 in [(v.size + m.ENDINGS, v.size + m.ENDINGS), (0, 3), (v.size + 5, 1)]:
        logp = m.log_probabilities(p, np.full(len(everything), w1), np.full(len(everything), w2), everything)
        assert np.exp(logp).sum() == pytest.approx(1, abs=1e-5)
    # the words of an ending, one unseen word included
    mass = np.full(m.ENDINGS, m.SMOOTH)
    known = dict(zip(v.hashes.tolist(), v.number.tolist()))
    for r in model.counts.collect():
        if known[np.uint64(r.h & (2**64 - 1)).item()] >= v.size:
            mass[r.e] += r.c + m.SMOOTH
    assert np.allclose(mass, v.others)


def test_scores_follow_the_parameters(spark, frame):
    """Scores of whole texts against the two softmaxes spelt out in plain Python."""
    rows = some_rows(60)
    df, model = model_of(spark, frame, rows, words=20)
    v, p = model.vocabulary, model.parameters
    c, q, r, w = (x.astype(float) for x in p.parts())
    known = {h: (n, k) for h, n, k in zip(v.hashes.tolist(), v.number.tolist(), v.counts.tolist())}
    counts = {row.h & (2**64 - 1): row.c for row in model.counts.collect()}

    def plain(text):
        h, _, e = m.tokens(np.frombuffer((text or "").encode(), np.uint8), np.array([0, len((text or "").encode())]))
        y = [known[x][0] if x in known else v.size + int(k) for x, k in zip(h.tolist(), e)]
        start, total = v.size + m.ENDINGS, 0.0
        for i, n in enumerate(y):
            u = (r[y[i - 1] if i > 0 else start, :m.DIM] * w[0, :m.DIM] + r[y[i - 2] if i > 1 else start, :m.DIM] * w[1, :m.DIM])
            scores = [sum(a * b for a, b in zip(u, x)) + x[m.DIM] for x in c]
            k = n // m.CLASS if n < v.size else p.classes + n - v.size
            total += scores[k] - math.log(sum(map(math.exp, scores)))
            if n < v.size:
                block = q[k * m.CLASS:(k + 1) * m.CLASS]
                scores = [sum(a * b for a, b in zip(u, x)) + x[m.DIM] for x in block]
                total += scores[n - k * m.CLASS] - math.log(sum(map(math.exp, scores)))
            else:
                total += math.log((counts.get(h[i].item(), 0) + m.SMOOTH) / v.others[n - v.size])
        return total / math.log(10)
    got = sorted(((r.doc_id, r.score) for r in m.score(df, model).collect()), key=str)
    want = sorted(((d, plain(t)) for d, t in rows), key=str)
    for (d, a), (e, b) in zip(sorted(got, key=lambda x: (str(x[0]), x[1])), sorted(want, key=lambda x: (str(x[0]), x[1])), strict=True):
        assert d == e and a == pytest.approx(b, rel=1e-4, abs=1e-3)
    text = rows[5][1]
    assert sum(model.token_log10(text)) == pytest.approx(plain(text), rel=1e-4)


def test_context_helps_on_held_out_texts(spark, frame):
    """Texts in which a word tells the next one: held-out texts score better than by their words alone."""
    rng = random.Random(1)
    follow = {f"{a}{i}": [f"{b}{(i * 7 + j) % 40}" for j in range(3)] for a, b in ("xy", "yx") for i in range(40)}

    def text():
        w = rng.choice(sorted(follow))
        out = [w]
        for _ in range(80):
            w = rng.choice(follow[w])
            out.append(w)
        return " ".join(out)
    rows = m.score_documents(frame([(i, text()) for i in range(1500)]).repartition(3)).where("held_out").agg(
        F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert (rows.s - rows.b) / rows.n > 0.25


def test_a_training_step_lowers_the_contrastive_loss():
    """Steps on one repeated pattern make it likelier, and rows that aren't used stay as they are."""
    v = m.Vocabulary(np.arange(1, 301, dtype=np.uint64), np.full(300, 10), np.arange(300, dtype=np.int32), 300, 3000, 300, np.full(m.ENDINGS, 0.1))
    p = m.initial(v)
    trainer = m._Trainer(p, 0.05, 1)
    y = np.tile(np.arange(5, dtype=np.int32) + 130, 400)
    w1, w2 = m.contexts(y, np.zeros(len(y), int), 300)
    before = m.log_probabilities(p, w1, w2, y).mean()
    for _ in range(10):
        trainer.learn(w1, w2, y)
    assert m.log_probabilities(trainer.p, w1, w2, y).mean() > before + 1
    still = trainer.used == 0
    assert still.any() and (trainer.p.values[still] == p.values[still]).all()
