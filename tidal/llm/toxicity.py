"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A text is read as overlapping windows of ``window`` words. A window's embedding is the mean of its
words' character n-gram vectors (with word edges), so a misspelt word shares most of its vectors
with the word it stands for; n-gram dropout and copies of the training texts with misspelt words make
those shared vectors carry the meaning. A linear softmax over two classes scores the window; the text's logit
is a soft maximum over all its windows (a few toxic words in a long text count as much as in a short
one), sharpened while training goes on. Vectors and softmax are trained together by AdaGrad on a
bounded sample of labelled texts (``max_per_class`` of either label, taken in order of a hash of the
doc_id). One fifth of the sample is kept back to calibrate: a logistic fit turns the largest window
logit into the score; where fewer than ``CAUGHT`` of the toxic texts kept back reach 0.7, it is shifted until they do
or ``FALSE_ALARMS`` of the clean ones do as well.

Scoring reads whole texts in Arrow batches: the softmax is linear, so each bucket has one number
(its vector times the difference of the class weights) and a text costs a few array operations.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidal.llm.common import filtered, python_ready, release_memory, text_chunks
from tidal.llm.subwords import padded, word_lists, word_sums

ORDERS = (3, 4, 5, 6)
BITS = 18
EMPTY_SCORE = 0.0
DECIDED = 0.7                   # the score from which a text counts as toxic
CAUGHT = 0.95                   # share of toxic texts kept back that should reach it
FALSE_ALARMS = 0.008            # share of clean ones that may


@dataclass(frozen=True)
class ToxicityModel:
    table: np.ndarray           # per bucket: vector . (w1 - w0)
    bias: float
    slope: float
    shift: float
    window: int

    def score(self, logits: np.ndarray) -> np.ndarray:
        z = np.clip(self.slope * logits + self.shift, -40, 40)
        return np.where(np.isneginf(logits), EMPTY_SCORE, 1 / (1 + np.exp(-z)))


def _window_sums(x: np.ndarray, rows: np.ndarray, window: int) -> np.ndarray:
    """Sums of x over each word and the up to window - 1 words after it in its row."""
    total = x.copy()
    for j in range(1, window):
        total[:-j] += np.where(rows[j:] == rows[:-j], x[j:], 0) if len(x) > j else 0
    return total


def _whole(rows: np.ndarray, window: int) -> np.ndarray:
    """The windows that are as long as their row allows: full ones, or the row's first."""
    n = len(rows)
    full = np.zeros(n, bool)
    if n >= window:
        full[:n - window + 1] = rows[window - 1:] == rows[:n - window + 1]
    first = np.ones(n, bool)
    first[1:] = rows[1:] != rows[:-1]
    return full | first


def max_logits(column: pa.Array, model: ToxicityModel) -> np.ndarray:
    """The largest window logit of each text (minus infinity without words)."""
    out = np.full(len(column), -np.inf)
    for first, data, offsets in text_chunks(column):
        text, starts, ends, rows = padded(data, offsets)
        if not len(starts):
            continue
        sums, counts = word_sums(text, starts, ends, model.table, ORDERS, BITS)
        z = (_window_sums(sums, rows, model.window)
             / np.maximum(_window_sums(counts.astype(float), rows, model.window), 1)) + model.bias
        z = np.where(_whole(rows, model.window), z, -np.inf)
        edge = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        out[first + rows[edge]] = np.maximum.reduceat(z, edge)
    return out


class _Sample:
    """Texts as runs of word numbers, words as runs of buckets."""

    def __init__(self, texts: list[str], labels: list[int]):
        self.y = np.array(labels, float)
        column = pa.array(texts, pa.large_string())
        known: dict[bytes, int] = {}
        docs: list[list[np.ndarray]] = [[] for _ in texts]
        for first, data, offsets in text_chunks(column):
            text, starts, ends, rows = padded(data, offsets)
            raw = text.tobytes()
            ids = np.array([known.setdefault(raw[s:e], len(known)) for s, e in zip(starts, ends, strict=True)], np.int64)
            cuts = np.searchsorted(rows, np.arange(len(offsets)))
            for r in range(len(offsets) - 1):
                docs[first + r].append(ids[cuts[r]:cuts[r + 1]].astype(np.int32))
        self.docs = [np.concatenate(d) if d else np.zeros(0, np.int32) for d in docs]
        # the buckets of the words, made for some thousands of words at a time
        words, flat, counts = list(known), [], []
        del known
        for at in range(0, len(words), 8192):
            data = np.frombuffer(b" ".join(words[at:at + 8192]) + b" ", np.uint8)
            text, starts, ends, _ = padded(data, np.array([0, len(data)]))
            buckets, of = word_lists(text, starts, ends, ORDERS, BITS)
            flat.append(buckets.astype(np.int32))
            counts.append(np.bincount(of, minlength=len(starts)))
        self.flat = np.concatenate(flat) if flat else np.zeros(0, np.int32)
        self.cuts = np.r_[0, np.cumsum(np.concatenate(counts))] if counts else np.zeros(1, np.int64)

    def grams(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = self.cuts[words + 1] - self.cuts[words]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.cuts[words], n)
        return self.flat[at], n


# Signs that stand for letters in disguised words.
_LOOKS_LIKE = {"a": "@", "e": "3", "i": "1", "l": "1", "o": "0", "s": "$", "t": "7"}


def _misspelt(text: str, rng: np.random.Generator, share: float) -> str:
    """A copy of a text in which ``share`` of the longer words have one letter wrong."""
    words = text.split()
    hit = np.flatnonzero(rng.random(len(words)) < share)
    kinds, places = rng.integers(0, 4, len(hit)), rng.random(len(hit))
    for at, kind, place in zip(hit, kinds, places, strict=True):
        w = words[at]
        if len(w) < 4:
            continue
        i = 1 + int(place * (len(w) - 2))
        if kind == 0:
            w = w[:i] + w[i] + w[i:]
        elif kind == 1:
            w = w[:i] + w[i + 1:]
        elif kind == 2:
            w = w[:i] + _LOOKS_LIKE.get(w[i], "*") + w[i + 1:]
        else:
            w = w[:i] + w[i + 1:i + 2] + w[i] + w[i + 2:]
        words[at] = w
    return " ".join(words)


def train(texts: list[str], labels: list[int], window: int = 2, dim: int = 8, epochs: int = 8,
          dropout: float = 0.2, misspelt: float = 0.6, rate: float = 0.5, seed: int = 7) -> ToxicityModel:
    """Fit vectors and softmax on labelled texts. With one label only, every score is its share."""
    rng = np.random.default_rng(seed)
    size = 1 << BITS
    if len(set(labels)) < 2:
        share = float(np.mean(labels)) if labels else 0.0
        p = min(max(share, 1e-6), 1 - 1e-6)
        return ToxicityModel(np.zeros(size, np.float32), 0.0, 0.0, float(np.log(p / (1 - p))), window)
    total = len(texts)
    order = rng.permutation(total)
    apart = set(order[: max(2, total // 5)].tolist())
    # copies with misspelt words, of either label, join the texts learned from
    copied = [i for i in range(total) if i not in apart]
    s = _Sample(texts + [_misspelt(texts[i], rng, misspelt) for i in copied], labels + [labels[i] for i in copied])
    vectors = rng.normal(0, 0.05, (size, dim)).astype(np.float32)
    weights = rng.normal(0, 0.5, (dim, 2))
    bias = np.zeros(2)
    seen, seen_w = np.full(size, 1e-3), np.full((dim, 2), 1e-3)
    learn = np.array([i for i in range(len(s.docs)) if i not in apart and len(s.docs[i])])
    share = max(s.y[learn].mean() if len(learn) else 0.5, 1e-3)
    for epoch in range(epochs):
        sharp = 2.0 + 4.0 * epoch / max(1, epochs - 1)
        batches, batch, words = [], [], 0
        for i in rng.permutation(learn):
            batch.append(i)
            words += len(s.docs[i])
            if words >= 6000:
                batches.append(batch)
                batch, words = [], 0
        for group in batches + ([batch] if batch else []):
            seq = np.concatenate([s.docs[i] for i in group])
            rows = np.repeat(np.arange(len(group)), [len(s.docs[i]) for i in group])
            used, place = np.unique(seq, return_inverse=True)
            flat, n = s.grams(used)
            # some n-grams are left out each time, so that a part of a word's is enough (misspellings)
            left = rng.random(len(flat)) >= dropout
            n = np.add.reduceat(np.r_[left, False].astype(np.int64), np.cumsum(n) - n) * (n > 0)
            flat = flat[left]
            cut = np.r_[0, np.cumsum(n)]
            gathered = vectors[flat]
            sums = np.zeros((len(used), dim))
            some = n > 0
            if some.any():
                sums[some] = np.add.reduceat(gathered, cut[:-1][some], axis=0)
            count = _window_sums(n[place].astype(float), rows, window)
            count = np.maximum(count, 1)
            mean = np.stack([_window_sums(sums[place, d], rows, window) for d in range(dim)], 1) / count[:, None]
            u = weights[:, 1] - weights[:, 0]
            z = mean @ u + bias[1] - bias[0]
            z = np.where(_whole(rows, window), z, -60.0)
            edge = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            top = np.maximum.reduceat(z, edge)
            attention = np.exp(sharp * (z - top[rows]))
            attention /= np.add.reduceat(attention, edge)[rows]
            text_z = np.add.reduceat(attention * z, edge)
            y = s.y[np.array(group)]
            cost = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
            wrong = cost * (1 / (1 + np.exp(-np.clip(text_z, -40, 40))) - y)
            g = wrong[rows] * attention
            grad_u = (g[:, None] * mean).sum(0)
            per_word = g / count
            spread = per_word.copy()
            for j in range(1, window):
                spread[j:] += np.where(rows[j:] == rows[:-j], per_word[:-j], 0)
            by_word = np.bincount(place, spread, minlength=len(used))
            by_bucket = np.bincount(flat, np.repeat(by_word, n), minlength=size)
            hit = np.flatnonzero(by_bucket)
            scale = float(np.linalg.norm(u)) + 1e-9
            seen[hit] += (by_bucket[hit] * scale) ** 2
            vectors[hit] -= (rate * by_bucket[hit] / np.sqrt(seen[hit]))[:, None] * u[None, :]
            grad_w = np.stack([-grad_u, grad_u], 1)
            seen_w += grad_w ** 2
            weights -= 0.1 * grad_w / np.sqrt(seen_w)
            bias += 0.02 * np.array([wrong.sum(), -wrong.sum()]) / len(group)
    u = (weights[:, 1] - weights[:, 0]).astype(np.float32)
    model = ToxicityModel(vectors @ u, float(bias[1] - bias[0]), 1.0, 0.0, window)
    held = sorted(apart)
    known = [texts[i] for i in held]
    logits = max_logits(pa.array(known + [_misspelt(t, rng, misspelt) for t in known], pa.large_string()), model)
    y = np.r_[s.y[held], s.y[held]]
    slope, shift = _logistic(logits, y)
    plain = logits[:len(held)]
    shift = max(shift, _decided(*[plain[(s.y[held] == k) & np.isfinite(plain)] for k in (0, 1)], slope))
    return ToxicityModel(model.table, model.bias, slope, shift, window)


def _decided(clean: np.ndarray, toxic: np.ndarray, slope: float) -> float:
    """The shift that puts ``DECIDED`` at the logit that ``CAUGHT`` of the toxic texts kept back reach, or that no more than
    ``FALSE_ALARMS`` of the clean ones do, whichever is higher."""
    if len(clean) * FALSE_ALARMS < 2 or not len(toxic):       # too few to tell
        return -np.inf
    limit = max(np.quantile(clean, 1 - FALSE_ALARMS), np.quantile(toxic, 1 - CAUGHT))
    return float(np.log(DECIDED / (1 - DECIDED)) - slope * limit)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and intercept of a logistic fit (Newton, smoothed targets)."""
    ok = np.isfinite(x)
    x, y = x[ok], y[ok]
    if len(x) < 2 or len(set(y.tolist())) < 2:
        return 1.0, 0.0
    pos, neg = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, -float(np.median(x))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - t) * x).sum() + ridge * a, (p - t).sum()])
        h = np.array([[(w * x * x).sum() + ridge, (w * x).sum()], [(w * x).sum(), w.sum()]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5.0 / (np.abs(step).max() + 1e-9))
        a, b = a - step[0], b - step[1]
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def labelled_sample(docs: DataFrame, labels: DataFrame, max_per_class: int) -> tuple[list[str], list[int]]:
    """At most ``max_per_class`` texts of either label, in order of a hash of the doc_id."""
    lab = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
           .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").alias("toxic")))
    by_hash = lab.withColumn("k", F.xxhash64("doc_id"))
    chosen = [by_hash.where(F.col("toxic") == value).orderBy("k", "doc_id").limit(max_per_class).select("doc_id", "toxic")
              for value in (0, 1)]
    # of rows that repeat a doc_id one text is taken, before they meet, so the bound holds for texts too
    rows = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").groupBy("doc_id")
            .agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("toxic").alias("toxic")).collect())
    rows.sort(key=lambda r: (r["toxic"], r["doc_id"]))
    return [r["text"] for r in rows], [int(r["toxic"]) for r in rows]


def fit(docs: DataFrame, labels: DataFrame, max_per_class: int = 1500, **options) -> ToxicityModel:
    """Train on ``labels.toxic`` (0/1, other values ignored; a doc_id labelled twice is toxic if once so)."""
    model = train(*labelled_sample(docs, labels, max_per_class), **options)
    release_memory()
    return model


def _scorer(shared):
    def run(batches):
        model = shared.value
        for batch in batches:
            score = model.score(max_logits(batch.column("text"), model))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(batch.num_columns)], pa.array(score, pa.float64())],
                names=[*batch.schema.names, "score"])
    return run


def score(docs: DataFrame, model: ToxicityModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``text`` and ``score`` (0..1) for every row; a text without words scores 0.

    Only ``text`` is an input of the score. Null texts count as empty. Repeated rows score alike.
    """
    spark = docs.sparkSession
    python_ready(spark)
    cols = docs.select(*[c for c in keep if c != "text"], F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols.schema) + ", score double"
    return cols.mapInArrow(_scorer(spark.sparkContext.broadcast(model)), schema)


def below(docs: DataFrame, model: ToxicityModel, limit: float) -> DataFrame:
    """The rows of ``docs`` with all their columns whose score is below ``limit``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return filtered(docs, lambda texts: shared.value.score(max_logits(texts, shared.value)) < limit)
