"""A log-bilinear neural language model, trained with noise-contrastive estimation, scoring whole texts.

Tokens are lower-cased (A-Z) words and one end per text. The model predicts a vector from the two words before a token,
``h = c1 * r(w1) + c2 * r(w2)`` (element by element), and scores a word by ``h . q + b``. To be normalised at a cost of the
square root of the vocabulary, a word is predicted in two log-bilinear steps: its class among all classes, then the word
among those of the class. Both steps are exact softmaxes by batched matrix products when texts are scored, so the probabilities of all
words add up to 1.

*Vocabulary.* The ``words`` most frequent training words (ties by hash) have vectors of their own; their classes are runs of
``CLASS`` words of like frequency. All others fall into ``ENDINGS`` classes by a hash of their last three bytes, and a class has one
vector for its words; within it a word has its smoothed unigram share, ``(c + 0.1) / sum``, an unseen word counting as one with
c = 0 in each class. The counts are those of every distinct word of all training texts.

*Training.* Each task reads its training texts once and takes NCE steps (noise: classes and words of the target's class by their
training frequency; AdaGrad) from the common parameters; the tasks' parameters are averaged, weighing each row by how
often a task used it. ``ROUNDS`` disjoint shares of the training texts are read one after the other, each from the average so far: every
training text is used once, whatever their number, and what a task holds is the model (a few hundred KB).

Scale: texts are read, never shuffled. Shuffled are (word hash, count) pairs added up in the task before, parameter slices,
and, for words beyond a table of the ``TABLE`` most frequent ones (a few MB, sent to every task), one row per document
and distinct rare word, which meets its count by a join on the word's hash. Words are told apart by a 64-bit hash.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidal.llm.common import long_id, lower_ascii, python_ready, span_hashes, text_chunks, word_spans, written
from tidal.llm.language import held_out

WORDS = 4096                # words with vectors of their own
CLASS = 128                 # words of a class
ENDINGS = 64                # classes of the other words
TABLE = 1 << 18             # words whose counts go to every task
DIM = 16
ROUNDS = 2
BATCH = 2048                # tokens of a training step
RATE = 0.05                 # step size of the first round
NOISE_CLASSES, NOISE_WORDS = 24, 8
FLUSH = 1 << 21             # token hashes counted together in a task
SLICE = 128                 # parameter rows in one row of the averaging shuffle
END = np.uint64(0x8D3F2A9C5B17E604)     # stands for the hash of the end of a text
SMOOTH = 0.1


@dataclass(frozen=True)
class Vocabulary:
    """The table of frequent words: sorted hashes, their counts and number. Words with a vector of their own have numbers
    below ``size``, all others ``size`` + the class of their ending."""
    hashes: np.ndarray
    counts: np.ndarray
    number: np.ndarray
    size: int               # words with vectors
    total: int              # N: training tokens
    distinct: int           # V: distinct training tokens
    others: np.ndarray      # smoothed mass of the words of each ending

    def __post_init__(self):
        bits = max(4, int(len(self.hashes)).bit_length() + 2)
        tops = np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(64 - bits) if len(self.hashes) else np.zeros(1, np.uint64)
        starts = np.searchsorted(self.hashes, tops[:-1])
        # where the hashes with each leading bits begin (the one past the last bits: their number)
        object.__setattr__(self, "starts", np.r_[starts, len(self.hashes)].astype(np.int32))
        object.__setattr__(self, "shift", np.uint64(64 - bits))

    def own(self) -> Vocabulary:
        """The words with vectors only."""
        keep = self.number < self.size
        return Vocabulary(self.hashes[keep], self.counts[keep], self.number[keep], self.size, self.total, self.distinct, self.others)

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the table, found) of word hashes."""
        if not len(self.hashes):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        top = h >> self.shift
        at, end = self.starts[top], self.starts[1:][top]
        found = at < end
        np.minimum(at, len(self.hashes) - 1, out=at)
        found &= self.hashes[at] == h
        left = np.flatnonzero(~found & (at + 1 < end))
        while len(left):
            at[left] += 1
            hit = self.hashes[at[left]] == h[left]
            found[left] = hit
            left = left[~hit & (at[left] + 1 < end[left])]
        return at, found

    def numbers(self, at: np.ndarray, found: np.ndarray, endings: np.ndarray) -> np.ndarray:
        own = self.number[at] if len(self.hashes) else 0
        return np.where(found, own, self.size + endings).astype(np.int32)


@dataclass
class Parameters:
    """One matrix: rows of class vectors (with bias), word vectors (with bias), context vectors, two position weights."""
    values: np.ndarray
    size: int               # words with vectors
    class_p: np.ndarray = field(repr=False)     # noise: classes, and words in all
    word_p: np.ndarray = field(repr=False)

    @property
    def classes(self) -> int:
        return -(-self.size // CLASS)

    def class_of(self, y: np.ndarray) -> np.ndarray:
        return np.where(y < self.size, y // CLASS, y + (self.classes - self.size))

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Views of class rows (endings last), word rows, context rows (words, endings, the start), position weights."""
        c, m = self.classes + ENDINGS, self.size
        at = np.cumsum([c, m, m + ENDINGS + 1])
        return tuple(np.split(self.values, at))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, class of the ending) of every token of a chunk of texts, ends included, in order."""
    low = lower_ascii(data)
    starts, ends, rows = word_spans(low, offsets)
    n = len(offsets) - 1
    counts = np.bincount(rows, minlength=n)
    place = np.arange(len(starts)) + rows
    hashes, endings = np.full(len(starts) + n, END), np.zeros(len(starts) + n, np.int32)
    hashes[place] = span_hashes(low, starts, ends)
    last = np.zeros(len(starts), np.uint32)
    for k in range(1, 4):
        last = last * np.uint32(257) + np.where(ends - k >= starts, low[np.maximum(ends - k, 0)], 0).astype(np.uint32)
    endings[place] = ((last * np.uint32(0x9E3779B1)) >> np.uint32(16)) % np.uint32(ENDINGS)
    return hashes, np.repeat(np.arange(n), counts + 1), endings


def contexts(numbers: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the word before each token and of the one before that; ``size + ENDINGS`` before the start."""
    out = []
    for back in (1, 2):
        w = np.full(len(numbers), size + ENDINGS, np.int32)
        same = rows[back:] == rows[:-back] if len(rows) > back else np.zeros(0, bool)
        w[back:][same] = numbers[:-back][same]
        out.append(w)
    return out[0], out[1]


# --- counts ---------------------------------------------------------------------------------

def _count(batches):
    held, n = [], 0

    def counted():
        h, e = (np.concatenate(x) for x in zip(*held, strict=True))
        words, first, times = np.unique(h, return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(times.astype(np.int64)), pa.array(e[first])],
                                          names=["h", "c", "e"])
    for batch in batches:
        for _, data, offsets in text_chunks(batch.column("text")):
            h, _, e = tokens(data, offsets)
            held.append((h, e))
            n += len(h)
            if n >= FLUSH:
                yield counted()
                held, n = [], 0
    if n:
        yield counted()


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, c, e): how often each distinct token stands in all ``texts``, and the class of its ending."""
    return written(texts.mapInArrow(_count, "h bigint, c bigint, e int").groupBy("h").agg(
        F.sum("c").alias("c"), F.max("e").alias("e")), "word-counts")


def vocabulary(counts: DataFrame, words: int = WORDS, table: int = TABLE) -> Vocabulary:
    """The frequent words, as far as whole steps of frequency (a 16th of a power of 2) fit into ``table``."""
    step = F.floor(F.log2("c") * 16).cast("int")
    steps = sorted((tuple(r) for r in counts.groupBy(step.alias("s")).agg(
        F.count(F.lit(1)), F.sum("c")).collect()), reverse=True)        # at most 1,024 rows
    total, distinct = sum(r[2] for r in steps), sum(r[1] for r in steps)
    least, have = None, 0
    for s, n, _ in steps:
        if have + n > table:
            break
        least, have = s, have + n
    end = int(END.view(np.int64))
    frequent = F.col("h") == end
    if least is not None:
        frequent |= step >= least
    found = counts.where(frequent).select("h", "c", "e").toArrow()      # at most ``table`` + 1 rows
    h, c, e = found["h"].to_numpy().view(np.uint64), found["c"].to_numpy(), found["e"].to_numpy()
    order = np.lexsort((h, -c, h != END))           # the end always has a vector
    size = min(words, len(h))
    chosen = order[:size]
    number = size + e
    number[chosen[np.lexsort((h[chosen], -c[chosen]))]] = np.arange(size)
    by_hash = np.argsort(h)
    others = np.full(ENDINGS, SMOOTH)
    for row in counts.groupBy("e").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        others[row["e"]] += row["c"] + SMOOTH * row["n"]
    others -= np.bincount(e[chosen], c[chosen] + SMOOTH, minlength=ENDINGS)
    others = np.maximum(others, SMOOTH)
    return Vocabulary(h[by_hash], c[by_hash], number[by_hash], size, total, distinct, others)


# --- training -------------------------------------------------------------------------------

def initial(v: Vocabulary, seed: int = 11) -> Parameters:
    """Small random vectors; biases that give the smoothed unigram model."""
    rng = np.random.default_rng(seed)
    size = v.size
    classes = -(-size // CLASS)
    word = np.zeros(size)
    known = v.number < size
    word[v.number[known]] = v.counts[known] + SMOOTH
    of = np.arange(size) // CLASS
    mass = np.r_[np.bincount(of, word, minlength=classes)[:classes], v.others]
    values = np.zeros((classes + 2 * ENDINGS + 2 * size + 3, DIM + 1), np.float32)
    p = Parameters(values, size, mass / mass.sum(), word / max(word.sum(), 1e-9))
    c, q, r, w = p.parts()
    for part in (c, q, r):
        part[:, :DIM] = rng.normal(0, 0.1, (len(part), DIM))
    c[:, DIM] = np.log(p.class_p)
    q[:, DIM] = np.log(word / mass[of])
    w[:, :DIM] = 1.0
    return p


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)) in place."""
    np.negative(x, out=x)
    np.minimum(x, 60, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _order(numbers: np.ndarray) -> np.ndarray:
    """A stable sorting order (of 16-bit numbers by radix, where they fit)."""
    return np.argsort(numbers.astype(np.uint16) if not len(numbers) or numbers.max() < 1 << 16 else numbers, kind="stable")


class _Trainer:
    """NCE steps on one task's tokens."""

    def __init__(self, start: Parameters, rate: float, seed: int):
        self.p = Parameters(start.values.copy(), start.size, start.class_p, start.word_p)
        self.rate, self.rng = rate, np.random.default_rng(seed)
        self.squares = np.full(len(start.values), 1e-6, np.float32)
        self.used = np.zeros(len(start.values), np.float32)
        self.class_sums = np.cumsum(start.class_p)
        word_sums = np.r_[0, np.cumsum(start.word_p)]
        self.word_sums = word_sums[1:]
        edges = np.minimum(np.arange(start.classes + 1) * CLASS, start.size)
        self.low, self.mass = word_sums[edges[:-1]], np.diff(word_sums[edges])
        self.class_odds = np.log(NOISE_CLASSES * start.class_p).astype(np.float32)
        of = np.arange(start.size) // CLASS
        self.word_odds = np.log(NOISE_WORDS * start.word_p / np.maximum(self.mass[of], 1e-12)).astype(np.float32)

    def _move(self, first: int, rows: np.ndarray, gradient: np.ndarray, used: np.ndarray) -> None:
        """An AdaGrad step (one step size per row) for distinct rows of the matrix."""
        rows = rows + first
        self.squares[rows] += np.einsum("ij,ij->i", gradient, gradient) / gradient.shape[1]
        self.p.values[rows] -= (self.rate / np.sqrt(self.squares[rows]))[:, None] * gradient
        self.used[rows] += used

    def step(self, w1: np.ndarray, w2: np.ndarray, y: np.ndarray) -> None:
        p, rng, n = self.p, self.rng, len(y)
        order = _order(y)
        w1, w2, y = w1[order], w2[order], y[order]
        c, q, r, w = (x[:, :DIM] for x in p.parts())
        cb, qb = p.parts()[0][:, DIM], p.parts()[1][:, DIM]
        r1, r2 = r[w1], r[w2]
        h = r1 * w[0] + r2 * w[1]
        of = p.class_of(y)
        known = int(np.searchsorted(y, p.size))
        # the class: its own score against that of noise classes, which the batch shares
        noise = np.minimum(np.searchsorted(self.class_sums, rng.random(NOISE_CLASSES)), len(c) - 1)
        mine = c[of]
        g = _sigmoid(np.einsum("ij,ij->i", h, mine) + cb[of] - self.class_odds[of]) - 1
        gn = _sigmoid(h @ c[noise].T + (cb[noise] - self.class_odds[noise]))
        dh = g[:, None] * mine + gn @ c[noise]
        dc = np.zeros((len(c), DIM + 1), np.float32)
        edge = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        dc[of[edge], :DIM] = np.add.reduceat(g[:, None] * h, edge)
        dc[of[edge], DIM] = np.add.reduceat(g, edge)
        np.add.at(dc, noise, np.c_[gn.T @ h, gn.sum(0)])
        times = np.bincount(of, minlength=len(c)).astype(np.float32)
        times[noise] += 1
        touched = np.flatnonzero(times)
        # the word among those of its class: noise words drawn for each class of the batch
        if known:
            yk, hk = y[:known], h[:known]
            mine = q[yk]
            gw = _sigmoid(np.einsum("ij,ij->i", hk, mine) + qb[yk] - self.word_odds[yk]) - 1
            dh[:known] += gw[:, None] * mine
            starts = edge[edge < known]
            there = of[starts]
            draw = self.low[there, None] + rng.random((len(there), NOISE_WORDS)) * self.mass[there, None]
            noise = np.minimum(np.searchsorted(self.word_sums, draw),
                               np.minimum((there[:, None] + 1) * CLASS, p.size) - 1)
            noise = np.maximum(noise, there[:, None] * CLASS)
            vectors, bias = q[noise], qb[noise] - self.word_odds[noise]
            runs = list(zip(starts.tolist(), [*starts[1:].tolist(), known], vectors, strict=True))
            gk = np.empty((known, NOISE_WORDS), np.float32)
            for lo, hi, x in runs:
                np.matmul(hk[lo:hi], x.T, out=gk[lo:hi])
            gk = _sigmoid(gk + np.repeat(bias, np.diff(np.r_[starts, known]), axis=0))
            dn = np.empty((len(there), NOISE_WORDS, DIM + 1), np.float32)
            for k, (lo, hi, x) in enumerate(runs):
                dh[lo:hi] += gk[lo:hi] @ x
                np.matmul(gk[lo:hi].T, hk[lo:hi], out=dn[k, :, :DIM])
            dn[:, :, DIM] = np.add.reduceat(gk, starts)
            at = np.flatnonzero(np.r_[True, yk[1:] != yk[:-1]])
            rows = np.concatenate([yk[at], noise.reshape(-1)])
            grads = np.concatenate([np.c_[np.add.reduceat(gw[:, None] * hk, at), np.add.reduceat(gw, at)],
                                    dn.reshape(-1, DIM + 1)])
            order = _order(rows)
            rows = rows[order]
            at2 = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            word_step = rows[at2], np.add.reduceat(grads[order], at2), np.add.reduceat(
                np.r_[np.diff(np.r_[at, known]), np.ones(noise.size)][order], at2)
        both, rows = np.concatenate([dh * w[0], dh * w[1]]), np.concatenate([w1, w2])
        dw = np.stack([(dh * r1).sum(0), (dh * r2).sum(0)])
        order = _order(rows)
        rows = rows[order]
        at = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        dr = np.zeros((len(at), DIM + 1), np.float32)
        dr[:, :DIM] = np.add.reduceat(both[order], at)
        first = len(c)
        self._move(0, touched, dc[touched], times[touched])
        if known:
            self._move(first, *word_step)
        self._move(first + p.size, rows[at], dr, np.diff(np.r_[at, 2 * n]))
        self._move(first + p.size + len(r), np.arange(2), np.c_[dw, np.zeros(2)].astype(np.float32) / 30, np.full(2, n))

    def learn(self, w1: np.ndarray, w2: np.ndarray, y: np.ndarray) -> None:
        order = self.rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            k = order[at:at + BATCH]
            self.step(w1[k], w2[k], y[k])


def _train(shared, rate: float, seed: int):
    """A task's texts -> its parameters, in slices, each row times its use."""
    def run(batches):
        v, start = shared.value
        v = v.own()
        context = TaskContext.get()
        trainer = _Trainer(start, rate, seed + 7919 * (context.partitionId() if context else 0))
        for batch in batches:
            for _, data, offsets in text_chunks(batch.column("text")):
                h, rows, endings = tokens(data, offsets)
                y = v.numbers(*v.look_up(h), endings)
                trainer.learn(*contexts(y, rows, v.size), y)
        used = trainer.used
        if used.any():
            sums = np.c_[trainer.p.values * used[:, None], used].astype("<f4")
            cuts = [sums[at:at + SLICE] for at in range(0, len(sums), SLICE)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(cuts)), pa.int32()), pa.array([c.tobytes() for c in cuts], pa.binary())],
                                             names=["slice", "sums"])
    return run


def _added(batches):
    """Slices added up, one row per slice in this partition."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, b in zip(batch.column("slice").to_pylist(), batch.column("sums"), strict=True):
            a = np.frombuffer(b.as_buffer(), "<f4").astype(np.float64)
            total[i] = total[i] + a if i in total else a
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
                                         names=["slice", "sums"])


def train(texts: DataFrame, v: Vocabulary, rounds: int = ROUNDS, rate: float = RATE, seed: int = 5) -> Parameters:
    """The parameters after reading every one of ``texts`` once (``share`` tells the round that reads a text)."""
    spark = texts.sparkSession
    p = initial(v)
    for k in range(rounds):
        shared = spark.sparkContext.broadcast((v, p))
        sums = texts.where(F.col("share") == k).select("text").mapInArrow(
            _train(shared, rate / (1 + k), seed + k), "slice int, sums binary")
        width, values = DIM + 2, p.values.copy()
        n = -(-len(values) // SLICE)
        for row in sums.repartition(n, "slice").mapInArrow(_added, "slice int, sums binary").collect():
            a = np.frombuffer(row["sums"], np.float64).reshape(-1, width)
            some = a[:, -1] > 0
            values[row["slice"] * SLICE:][:len(a)][some] = (a[some, :-1] / a[some, -1:]).astype(np.float32)
        p = Parameters(values, p.size, p.class_p, p.word_p)
        shared.destroy()
    return p


# --- scoring --------------------------------------------------------------------------------

def _log_sum(x: np.ndarray) -> np.ndarray:
    """Log of the sum of exponentials of each row; ``x`` is used up."""
    top = x.max()
    if x.min() > top - 60:          # one shift will do for all rows
        x -= top
        np.exp(x, out=x)
        return np.log(x @ np.ones(x.shape[1], x.dtype)) + top
    top = x.max(1)
    x -= top[:, None]
    np.exp(x, out=x)
    return np.log(x @ np.ones(x.shape[1], x.dtype)) + top


def log_probabilities(p: Parameters, w1: np.ndarray, w2: np.ndarray, y: np.ndarray, block: int = 1 << 14) -> np.ndarray:
    """Natural log-probability of each token number after its context (of an ending for words without a vector)."""
    out = np.empty(len(y))
    c, q, r, w = p.parts()
    for at in range(0, len(y), block):
        order = _order(y[at:at + block])
        yk = y[at:at + block][order]
        h = r[w1[at:at + block][order], :DIM] * w[0, :DIM] + r[w2[at:at + block][order], :DIM] * w[1, :DIM]
        of = p.class_of(yk)
        logits = h @ c[:, :DIM].T + c[:, DIM]
        logp = logits[np.arange(len(yk)), of].astype(np.float64)
        logp -= _log_sum(logits)
        known = int(np.searchsorted(yk, p.size))
        starts = np.flatnonzero(np.r_[True, of[1:known] != of[:known - 1]]) if known else []
        for lo, hi in zip(starts, [*starts[1:], known], strict=False):
            first = of[lo] * CLASS
            rows = q[first:first + CLASS]
            logits = h[lo:hi] @ rows[:, :DIM].T + rows[:, DIM]
            logp[lo:hi] += logits[np.arange(hi - lo), yk[lo:hi] - first]
            logp[lo:hi] -= _log_sum(logits)
        out[at + order] = logp
    return out


def _rare_words(h: np.ndarray, rows: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
    """Per row: the distinct words and how often each stands there."""
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    edge = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])]) if len(h) else np.zeros(0, np.int64)
    offsets = np.r_[0, np.cumsum(np.bincount(rows[edge], minlength=n))].astype(np.int32)
    times = np.diff(np.r_[edge, len(h)]).astype(np.int32)
    return (pa.ListArray.from_arrays(offsets, pa.array(h[edge].view(np.int64))), pa.ListArray.from_arrays(offsets, pa.array(times)))


_SUMS = ("n_tokens bigint, n_known bigint, base double, score double, rare array<bigint>, times array<int>")


def _score(shared):
    def run(batches):
        v, p = shared.value
        logs = np.log10(v.counts + SMOOTH)
        others = np.log10(v.others)
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column("text")):
                n = len(offsets) - 1
                h, rows, endings = tokens(data, offsets)
                at, found = v.look_up(h)
                y = v.numbers(at, found, endings)
                count_log = np.where(found, logs[at], 0.0) if len(logs) else np.zeros(len(h))
                score = log_probabilities(p, *contexts(y, rows, v.size), y) / np.log(10)
                other = y >= v.size
                score[other] += count_log[other] - others[y[other] - v.size]
                rare, times = _rare_words(h[~found], rows[~found], n)
                sums = [np.bincount(rows, minlength=n), np.bincount(rows[found], minlength=n)]
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(first, n) for c in batch.columns[:-1]], *[pa.array(s.astype(np.int64)) for s in sums],
                     pa.array(np.bincount(rows, count_log, minlength=n)), pa.array(np.bincount(rows, score, minlength=n)), rare, times],
                    names=[*batch.schema.names[:-1], "n_tokens", "n_known", "base", "score", "rare", "times"])
    return run


@dataclass(frozen=True)
class LanguageModel:
    vocabulary: Vocabulary
    parameters: Parameters
    counts: DataFrame       # (h, c) of every distinct training token, written

    def token_log10(self, text: str) -> list[float]:
        """The model's log10 probability of each token of a text; NaN for a word whose count isn't in the table."""
        column = pa.array([text])
        out = []
        for _, data, offsets in text_chunks(column):
            v = self.vocabulary
            h, rows, endings = tokens(data, offsets)
            at, found = v.look_up(h)
            y = v.numbers(at, found, endings)
            logp = log_probabilities(self.parameters, *contexts(y, rows, v.size), y) / np.log(10)
            other = y >= v.size
            counts = np.where(found[other], np.log10(v.counts[at[other]] + SMOOTH), np.nan) if len(v.counts) else np.nan
            logp[other] += counts - np.log10(v.others[y[other] - v.size])
            out += logp.tolist()
        return out


def fit(docs: DataFrame, training: Column, words: int = WORDS, table: int = TABLE, rounds: int = ROUNDS, rate: float = RATE) -> LanguageModel:
    """The model of the texts of ``docs`` for which ``training`` holds. Without any, every word has the same probability."""
    python_ready(docs.sparkSession)
    texts = docs.where(training).select(F.col("text").cast("string").alias("text"), F.pmod(
        F.xxhash64(F.col("doc_id"), F.col("text")), F.lit(rounds)).alias("share"))
    counts = word_counts(texts.select("text"))
    v = vocabulary(counts, words, table)
    return LanguageModel(v, train(texts, v, rounds, rate), counts)


def score(docs: DataFrame, model: LanguageModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, n_tokens, n_known, train_tokens, base_score and score (log10) of every row of ``docs``.

    A null text is empty: its only token is the end. Repeated rows score alike. Rows don't need a doc_id.
    """
    spark, v = docs.sparkSession, model.vocabulary
    python_ready(spark)
    cols = docs.select(*keep, F.monotonically_increasing_id().alias("row_id"), F.col("text").cast("string").alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols.schema if f.name != "text")
    shared = spark.sparkContext.broadcast((v, model.parameters))
    sums = written(cols.mapInArrow(_score(shared), f"{kinds}, {_SUMS}"), "text-scores")
    rare = sums.select("row_id", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row_id", F.col("w.rare").alias("h"), "w.times")
    c = F.coalesce("c", F.lit(0))
    rare = rare.join(model.counts, "h", "left").groupBy("row_id").agg(
        F.sum(F.col("times") * F.log10(c + SMOOTH)).alias("rare_log"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_known"), F.sum("times").alias("rare_n"))
    out = sums.drop("rare", "times").join(rare, "row_id", "left").fillna(0, ["rare_known", "rare_n"]).fillna(0.0, ["rare_log"])
    whole = float(np.log10(v.total + SMOOTH * (v.distinct + 1)))
    return out.select(*keep, "n_tokens", (F.col("n_known") + F.col("rare_known")).alias("n_known"),
                      F.lit(v.total).cast("bigint").alias("train_tokens"),
                      (F.col("base") + F.col("rare_log") - F.col("n_tokens") * whole).alias("base_score"),
                      (F.col("score") + F.col("rare_log")).alias("score"))


def score_documents(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row, with a model of the rows whose
    crc32(doc_id as text) mod 10 is not 0 (a null doc_id is a training row)."""
    docs = docs.select(long_id(docs, "doc_id"), F.col("text").cast("string").alias("text"))
    apart = held_out("doc_id", 10, 0)
    return score(docs.withColumn("held_out", apart), fit(docs, ~apart, **options), ("doc_id", "held_out"))
