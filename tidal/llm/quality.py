"""Quality classifier: a weak-label model over heuristic labellers, then a hashed linear scorer.

Ten labellers look at a whole text and vote good (+1), bad (-1) or abstain (0); they overlap on purpose.
Their votes are counted by pattern over the whole corpus. Expectation-maximisation on those counts
estimates each labeller's vote probabilities given the hidden class (so its accuracy) and the share of
good texts; the posterior of a pattern labels its texts. The posterior labels of a bounded sample of texts
(``max_rows`` distinct ones, in order of a hash of the text) train a logistic scorer on the mean of hashed byte n-grams
and the share of repeated words, which scores every text. No given label is used.

The votes of a text cost a few array operations in Arrow batches; the pattern table has at most 3**10 rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidal.llm.common import filtered, python_ready, release_memory, span_hashes, text_chunks, tidy, word_spans, written
from tidal.llm.subwords import padded, row_sums, word_lists

LABELLERS = ("signs", "signed words", "capitals", "marks", "bars", "repeats", "variety", "sentences", "starts", "lines")
ORDERS = (2, 3)
BITS = 16
EMPTY_SCORE = 0.0
FALSE_ALARM = 0.003
FALSE_ALARM_WORTH = 10.0        # times the texts that the prior of the good class is worth
MOST_SEEN = 0.7

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.array([chr(b).isalpha() and b < 128 or b >= 128 for b in range(256)])
_SIGN = np.array([chr(b) in "#$%&*+<=>@\\^_`{|}~!" for b in range(256)])
_STOP = np.array([chr(b) in ".?!" for b in range(256)])


def _vote(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    return np.where(bad, -1, np.where(good, 1, 0)).astype(np.int8)


def votes(column: pa.Array) -> np.ndarray:
    """Votes of the labellers, one row per text; all abstain on a text without words."""
    out = np.zeros((len(column), len(LABELLERS)), np.int8)
    for first, data, offsets in text_chunks(column):
        n = len(offsets) - 1
        starts, ends, rows = word_spans(data, offsets)
        if not len(starts):
            continue
        words = np.bincount(rows, minlength=n)
        per_word = np.maximum(words, 1)
        cum = lambda mask: np.r_[0, np.cumsum(mask)]
        bytes_in = lambda c: c[offsets[1:]] - c[offsets[:-1]]
        sign = cum(_SIGN[data])
        letters = np.maximum(bytes_in(cum(_LETTER[data])), 1)
        count = lambda mask: np.bincount(rows, mask, minlength=n)
        last = data[ends - 1]
        before = data[np.maximum(ends - 2, 0)]
        long = ends - starts > 1
        twice = long & (last == before)
        hashes = span_hashes(data, starts, ends)
        again = np.zeros(len(starts), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
        order = np.lexsort((hashes, rows))
        fresh = np.ones(len(starts), bool)
        fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (rows[order][1:] != rows[order][:-1])
        distinct = np.bincount(rows[order], fresh, minlength=n) / per_word
        # the share of distinct words that prose of this length has at least
        usual = 1 / (1 + 0.12 * np.log2(per_word) ** 1.5)
        bars = long == 0
        bars &= data[starts] == 0x7C
        signs = bytes_in(sign) / letters
        signed = count(twice & _SIGN[last]) / per_word
        capitals = bytes_in(cum(_UPPER[data])) / letters
        marks = count(twice & (last == 0x21)) / per_word
        bar = count(bars) / per_word
        repeat = count(again) / per_word
        stops = count(_STOP[last]) / per_word
        upper = count(_UPPER[data[starts]]) / per_word
        lines = np.maximum(bytes_in(cum(data == 0x0A)), 0) + 1
        some, many = words >= 5, words >= 30
        here = slice(first, first + n)
        have = words > 0
        table = [
            _vote(signs < 0.01, signs > 0.08), _vote(signed < 0.01, signed > 0.08), _vote(capitals < 0.2, capitals > 0.6),
            _vote(marks < 0.01, marks > 0.1), _vote(bar < 0.005, bar > 0.05), _vote(repeat < 0.03, repeat > 0.15),
            _vote(some & (distinct > 0.6 * usual), many & (distinct < 0.3 * usual)),
            _vote(some & (stops > 0.02) & (stops < 0.35), many & (stops < 0.004)),
            _vote(some & (upper > 0.01) & (upper < 0.4), many & ((upper < 0.003) | (upper > 0.8))),
            _vote(some & (words / lines > 6), many & (words / lines < 3)),
        ]
        out[here] = np.where(have[:, None], np.stack(table, 1), 0)
    return out


def _pattern_ids(v: np.ndarray) -> np.ndarray:
    return ((v.astype(np.int64) + 1) * 3 ** np.arange(len(LABELLERS))).sum(1)


def _patterns(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_pattern_ids(votes(batch.column("text"))))], names=["pattern"])


@dataclass(frozen=True)
class WeakModel:
    share_good: float
    bad_vote: np.ndarray        # class (bad, good) x labeller: probability of a bad vote, if it votes

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """Probability of good for rows of votes; an abstention says nothing."""
        against, for_ = (v == -1).astype(float), (v == 1).astype(float)
        log_bad, log_good = np.log(self.bad_vote), np.log1p(-self.bad_vote)
        odds = (against @ (log_bad[1] - log_bad[0]) + for_ @ (log_good[1] - log_good[0])
                + np.log(self.share_good) - np.log1p(-self.share_good))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def accuracies(self) -> dict[str, tuple[float, float]]:
        """Per labeller: share of bad texts it votes bad, share of good texts it votes good (if it votes)."""
        return {k: (float(b), float(1 - g)) for k, b, g in zip(LABELLERS, *self.bad_vote, strict=True)}


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, steps: int = 500,
                             worth: float = FALSE_ALARM_WORTH, most: float = MOST_SEEN) -> WeakModel:
    """Fit the weak-label model to counted vote patterns (rows of -1, 0, 1).

    Each labeller catches only some kinds of bad text, but hardly ever accuses a good one: the rate of that
    has a strong prior (``FALSE_ALARM``, worth ``worth`` times the texts) and no labeller is taken to see more than
    ``most`` of all bad texts, so that a rarer kind of bad text isn't taken for good with a wrong
    labeller. So the accuracies on good texts are largely set by the prior, those on bad texts by the data; the README
    has the estimates under weak priors too. The other rates have a prior worth a thousandth of the texts.
    """
    n = len(LABELLERS)
    model = WeakModel(0.85, np.array([[0.4] * n, [FALSE_ALARM] * n]))
    total = float(counts.sum())
    if not total:
        return model
    against, for_ = (patterns == -1).astype(float), (patterns == 1).astype(float)
    for _ in range(steps):
        p = model.posterior(patterns)
        rates = []
        for q, start, prior in ((1 - p, 0.4, max(1.0, total / 1000)), (p, FALSE_ALARM, max(1.0, worth * total))):
            w = counts * q
            rates.append((w @ against + prior * start) / (w @ (against + for_) + prior))
        rates[0] = np.minimum(rates[0], most)
        new = WeakModel(float(np.clip((counts @ p + 1) / (total + 2), 1e-4, 1 - 1e-4)), np.stack(rates))
        done = abs(new.share_good - model.share_good) < 1e-9 and np.abs(new.bad_vote - model.bad_vote).max() < 1e-8
        model = new
        if done:
            break
    return model


def _repetition(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text: the share of words equal to the word before (n-grams can't see that)."""
    n = len(offsets) - 1
    starts, ends, rows = word_spans(data, offsets)
    hashes = span_hashes(data, starts, ends)
    again = np.zeros(len(starts), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    return np.bincount(rows, again, minlength=n) / np.maximum(np.bincount(rows, minlength=n), 1)


@dataclass(frozen=True)
class QualityModel:
    weak: WeakModel
    weights: np.ndarray
    repeat_weight: float
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.full(len(column), EMPTY_SCORE)
        for first, data, offsets in text_chunks(column):
            text, starts, _, rows = padded(data, offsets)
            if not len(starts):
                continue
            at, sums, counts = row_sums(text, starts, rows, [self.weights], ORDERS, BITS)
            z = (sums[:, 0] / np.maximum(counts, 1) + self.repeat_weight * _repetition(data, offsets)[at] + self.bias)
            out[first + at] = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        return out


def train(texts: list[str], weak: WeakModel, epochs: int = 15, rate: float = 1.0, seed: int = 3) -> QualityModel:
    """A logistic scorer on mean hashed n-grams, fitted to the posterior labels of texts."""
    size = 1 << BITS
    texts = [t for t in texts if t.strip()]
    weights, repeat_weight, bias = np.zeros(size), 0.0, 0.0
    if not texts:
        return QualityModel(weak, weights.astype(np.float32), repeat_weight, bias)
    target = weak.posterior(votes(pa.array(texts, pa.large_string())))
    bags, repeats = [], []
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        text, starts, ends, _ = padded(data, np.array([0, len(data)]))
        used, n = np.unique(word_lists(text, starts, ends, ORDERS, BITS)[0], return_counts=True)
        bags.append((used.astype(np.int32), (n / max(1, n.sum())).astype(np.float32)))
        repeats.append(_repetition(data, np.array([0, len(data)]))[0])
    repeats = np.array(repeats)
    rng = np.random.default_rng(seed)
    seen, seen_r = np.full(size, 1e-6), 1e-6
    share = float(np.clip(target.mean(), 0.02, 0.98))
    cost = np.where(target >= 0.5, 0.5 / share, 0.5 / (1 - share))
    for _ in range(epochs):
        turn = rng.permutation(len(bags))
        for at in range(0, len(turn), 16):
            group = turn[at:at + 16]
            flat = np.concatenate([bags[i][0] for i in group])
            part = np.concatenate([bags[i][1] for i in group])
            n = np.array([len(bags[i][0]) for i in group])
            z = np.add.reduceat(weights[flat] * part, np.cumsum(n) - n) + repeat_weight * repeats[group] + bias
            wrong = cost[group] * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target[group]) / len(group)
            used, place = np.unique(flat, return_inverse=True)
            grad = np.bincount(place, np.repeat(wrong, n) * part, minlength=len(used))
            seen[used] += grad ** 2
            weights[used] -= rate * grad / np.sqrt(seen[used])
            grad_r = float(wrong @ repeats[group])
            seen_r += grad_r ** 2
            repeat_weight -= rate * grad_r / np.sqrt(seen_r)
            bias -= 0.2 * float(wrong.sum())
    return QualityModel(weak, weights.astype(np.float32), repeat_weight, bias)


def fit(docs: DataFrame, max_rows: int = 3000) -> QualityModel:
    """Weak labels from the votes on all texts; a scorer trained on at most ``max_rows`` distinct ones."""
    spark = docs.sparkSession
    python_ready(spark)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(tidy(_patterns), "pattern bigint").groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    rows = written(counted, "patterns").orderBy("pattern").collect()            # at most 3**10
    ids = np.array([r["pattern"] for r in rows], np.int64)
    patterns = (ids[:, None] // 3 ** np.arange(len(LABELLERS))) % 3 - 1 if len(ids) else np.zeros((0, len(LABELLERS)))
    voted = (patterns != 0).any(1) if len(ids) else np.zeros(0, bool)           # texts without words don't count
    weak = expectation_maximisation(patterns[voted], np.array([r["n"] for r in rows])[voted] if len(ids) else np.zeros(0))
    # the least distinct hashes first (8 bytes each), then only their texts
    keyed = texts.where("text is not null").select("text", F.xxhash64("text").alias("k"))
    last = keyed.select("k").distinct().orderBy("k").limit(max_rows).agg(F.max("k")).first()[0]
    sample = (keyed.where(F.col("k") <= last).dropDuplicates(["k"]).orderBy("k").collect() if last is not None else [])
    model = train([r["text"] for r in sample], weak)
    del sample
    release_memory()
    return model


def _scorer(shared):
    def run(batches):
        model = shared.value
        for batch in batches:
            texts = batch.column("text")
            keep = [i for i, name in enumerate(batch.schema.names) if name != "text"]
            v = votes(texts)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in keep], pa.array(model.scores(texts)),
                 pa.array(np.where((v != 0).any(1), model.weak.posterior(v), EMPTY_SCORE))],
                names=[*[batch.schema.names[i] for i in keep], "score", "weak_posterior"])
    return run


def score(docs: DataFrame, model: QualityModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, score (0..1, higher is better) and weak_posterior of every row.

    Only ``text`` is an input. A null, empty or blank text scores 0. Repeated rows score alike; other
    columns don't matter; an empty table gives no rows.
    """
    spark = docs.sparkSession
    python_ready(spark)
    cols = docs.select(*keep, F.col("text").cast("string").alias("text"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in cols.schema if f.name != "text")
    return cols.mapInArrow(_scorer(spark.sparkContext.broadcast(model)), schema + "score double, weak_posterior double")


def at_least(docs: DataFrame, model: QualityModel, limit: float) -> DataFrame:
    """The rows of ``docs`` with all their columns whose score is ``limit`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return filtered(docs, lambda texts: shared.value.scores(texts) >= limit)
