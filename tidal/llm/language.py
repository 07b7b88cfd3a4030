"""Language ID: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

A text is the mean of the vectors of its words' byte n-grams (orders 2 to 4, with word edges, hashed
into 2**16 buckets); a linear softmax over the learned languages scores the mean. Vectors and softmax
are trained together by stochastic gradient descent (AdaGrad steps) on a bounded sample of labelled
texts (``max_rows``, dealt evenly over the languages, in order of a hash of the doc_id), each text once whole and once by a short piece,
so that short texts are scored sensibly too. One fifth of each language is kept back to calibrate: a
temperature is fitted, and the rejection limit is the least score at which kept-back predictions are right
with the wanted precision.

As the softmax is linear, scoring sums one row of class scores per n-gram over the whole text. A text
without a letter is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidal.llm.common import python_ready, release_memory, text_chunks, written
from tidal.llm.subwords import padded, row_sums, word_lists

ORDERS = (2, 3, 4)
BITS = 16
UNKNOWN = "und"
LEAST_ROWS = 50
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    table: np.ndarray           # buckets x languages: vectors times class weights
    bias: np.ndarray
    temperature: float
    reject_below: float

    def scores(self, means: np.ndarray) -> np.ndarray:
        z = (means + self.bias) / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def mean_rows(column: pa.Array, table: np.ndarray) -> np.ndarray:
    """The mean of ``table`` rows over all n-grams of each text (zeros without words)."""
    out = np.zeros((len(column), table.shape[1]))
    tables = [np.ascontiguousarray(table[:, k]) for k in range(table.shape[1])]
    for first, data, offsets in text_chunks(column):
        text, starts, _, rows = padded(data, offsets)
        if not len(starts):
            continue
        at, sums, counts = row_sums(text, starts, rows, tables, ORDERS, BITS)
        out[first + at] = sums / np.maximum(counts, 1)[:, None]
    return out


def _bags(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(distinct buckets, share of each) per text."""
    out = []
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        text, starts, ends, _ = padded(data, np.array([0, len(data)]))
        flat, _ = word_lists(text, starts, ends, ORDERS, BITS)
        used, n = np.unique(flat, return_counts=True)
        out.append((used.astype(np.int32), (n / max(1, n.sum())).astype(np.float32)))
    return out


def train(texts: list[str], languages: list[str], dim: int = 12, epochs: int = 12, rate: float = 0.3,
          precision: float = 0.99, seed: int = 5) -> LanguageModel:
    """Fit on labelled texts. Without any, the only language is ``und``; with one, it is always that."""
    rng = np.random.default_rng(seed)
    known = tuple(sorted(set(languages))) or (UNKNOWN,)
    size = 1 << BITS
    if len(known) == 1:
        return LanguageModel(known, np.zeros((size, 1), np.float32), np.zeros(1), 1.0, 0.0)
    y_all = np.array([known.index(v) for v in languages])
    order = rng.permutation(len(texts))
    by_language = [order[y_all[order] == k] for k in range(len(known))]
    apart = np.concatenate([i[:len(i) // 5] for i in by_language])
    learn = rng.permutation(np.concatenate([i[len(i) // 5:] for i in by_language]))
    if not len(apart):          # a few texts: calibrated on those learned from
        apart = learn
    pieces, y = [], []
    for i in learn:
        words = texts[i].split()
        pieces.append(texts[i])
        start, length = int(rng.integers(0, max(1, len(words)))), int(rng.integers(1, 12))
        pieces.append(" ".join(words[start:start + length]))
        y += [y_all[i]] * 2
    bags, y = _bags(pieces), np.array(y)
    # a rare language counts as much as a frequent one
    weight = len(y) / (len(known) * np.maximum(np.bincount(y, minlength=len(known)), 1))
    vectors = rng.normal(0, 0.1, (size, dim)).astype(np.float32)
    heads = rng.normal(0, 0.3, (dim, len(known)))
    bias = np.zeros(len(known))
    seen, seen_h = np.full(size, 1e-4), np.full(heads.shape, 1e-4)
    for _ in range(epochs):
        turn = rng.permutation(len(bags))
        for at in range(0, len(turn), 32):
            group = [i for i in turn[at:at + 32] if len(bags[i][0])]
            if not group:
                continue
            flat = np.concatenate([bags[i][0] for i in group])
            share = np.concatenate([bags[i][1] for i in group])
            n = np.array([len(bags[i][0]) for i in group])
            cut = np.cumsum(n) - n
            mean = np.add.reduceat(vectors[flat] * share[:, None], cut, axis=0)
            z = mean @ heads + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(group)), y[group]] -= 1
            p *= weight[y[group]][:, None] / len(group)
            back = p @ heads.T
            grad = np.repeat(back, n, axis=0) * share[:, None]
            used, place = np.unique(flat, return_inverse=True)
            total = np.stack([np.bincount(place, grad[:, d], minlength=len(used)) for d in range(dim)], 1)
            seen[used] += (total ** 2).sum(1)
            vectors[used] -= (rate * total / np.sqrt(seen[used])[:, None]).astype(np.float32)
            grad_h = mean.T @ p
            seen_h += grad_h ** 2
            heads -= rate * grad_h / np.sqrt(seen_h)
            bias -= 0.05 * p.sum(0)
    model = LanguageModel(known, (vectors @ heads).astype(np.float32), bias, 1.0, 0.0)
    held = [texts[i] for i in apart] + [" ".join(texts[i].split()[:6]) for i in apart]
    truth = np.r_[y_all[apart], y_all[apart]]
    z = mean_rows(pa.array(held, pa.large_string()), model.table) + bias
    losses = []
    for t in np.geomspace(0.1, 4, 30):
        q = z / t
        q = q - q.max(1, keepdims=True)
        losses.append(-(q[np.arange(len(truth)), truth] - np.log(np.exp(q).sum(1))).mean())
    temperature = float(np.geomspace(0.1, 4, 30)[int(np.argmin(losses))])
    model = LanguageModel(known, model.table, bias, temperature, 0.0)
    p = model.scores(z - bias)
    return LanguageModel(known, model.table, bias, temperature,
                         _limit(p.max(1), p.argmax(1) == truth, precision))


def _limit(score: np.ndarray, right: np.ndarray, precision: float) -> float:
    """The least score at or above which at least ``precision`` of the predictions are right."""
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(share >= precision)
    return float(score[order][good[-1]]) if len(good) else 1.0


def _quotas(counts: dict[str, int], max_rows: int) -> dict[str, int]:
    """Rows to take per language: equal shares of ``max_rows``, what a rare one leaves going to the others,
    and ``LEAST_ROWS`` of any language that has them."""
    out, left = {}, max_rows
    for k, (lang, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        share = min(n, -(-max(left, 0) // (len(counts) - k)))
        left -= share
        out[lang] = max(share, min(n, LEAST_ROWS))
    return out


def labelled_sample(docs: DataFrame, held_out: Column, max_rows: int) -> tuple[list[str], list[str]]:
    """Texts with their language that aren't held out: of every language its quota, in order of a hash of
    doc_id. At most ``max_rows`` in all, or ``LEAST_ROWS`` per language where that is more. Of rows that
    repeat a doc_id and language one text is taken, by its hash."""
    learn = docs.where(~held_out & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = written(learn.select("doc_id", "lang").distinct(), "ids").withColumn("k", F.xxhash64(F.lit("lang"), "doc_id"))
    counts = {r["lang"]: r["n"] for r in ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return [], []
    quotas = _quotas(counts, max_rows)
    # hashes are spread evenly: a few more than the quota lie below its share of the range
    bounds = [(lang, min(2**63 - 1, int(-2**63 + 2**64 * min(1.0, (q + 6 * q ** 0.5 + 20) / counts[lang]))))
              for lang, q in quotas.items()]
    spark = docs.sparkSession
    below = F.broadcast(spark.createDataFrame(bounds, "lang string, below bigint"))
    chosen, taken = [], dict.fromkeys(quotas, 0)
    for r in sorted(ids.join(below, "lang").where("k <= below").select("k", "doc_id", "lang").collect()):
        if taken[r["lang"]] < quotas[r["lang"]]:
            taken[r["lang"]] += 1
            chosen.append((r["doc_id"], r["lang"]))
    picked = F.broadcast(spark.createDataFrame(chosen, "doc_id bigint, lang string"))
    rows = learn.select("doc_id", "lang", "text").join(picked, ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(
        F.min(F.struct(F.xxhash64("text"), "text")).alias("m")).select("doc_id", "lang", "m.text").collect()
    rows = sorted((r["doc_id"], r["lang"], r["text"]) for r in rows)
    return [t for _, _, t in rows], [v for _, v, _ in rows]


def _predictor(shared):
    def run(batches):
        model = shared.value
        names = np.array(model.languages)
        for batch in batches:
            texts = batch.column("text")
            p = model.scores(mean_rows(texts, model.table))
            lettered = np.array([bool(t) and _LETTER.search(t) is not None for t in texts.to_pylist()], bool)
            best = p.argmax(1)
            score = np.where(lettered, p[np.arange(len(p)), best], 0.0)
            lang = np.where(lettered, names[best], UNKNOWN)
            keep = [i for i, name in enumerate(batch.schema.names) if name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in keep], pa.array(lang.tolist(), pa.string()), pa.array(score, pa.float64()),
                 pa.array(lettered & (score >= model.reject_below), pa.bool_())],
                names=[*[batch.schema.names[i] for i in keep], "lang_pred", "score", "accepted"])
    return run


def predict(docs: DataFrame, model: LanguageModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, lang_pred, score (0..1) and accepted (the score passes the calibrated limit).

    Only ``text`` is an input. Null texts and texts without a letter are ``und`` with score 0. Repeated
    rows score alike; columns that aren't kept don't matter; an empty table gives no rows.
    """
    spark = docs.sparkSession
    python_ready(spark)
    cols = docs.select(*keep, F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols.schema if f.name != "text")
    return cols.mapInArrow(_predictor(spark.sparkContext.broadcast(model)),
                           schema + ", lang_pred string, score double, accepted boolean")


def held_out(doc_id: str, mod: int, rest: int) -> Column:
    """crc32 of the id as text, modulo ``mod``, is ``rest`` (false for a null id)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod == rest, F.lit(False))


def identify(docs: DataFrame, max_rows: int = 4000, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted of every row, with a model fitted on the rows that
    aren't held out (crc32(doc_id) mod 4 is not 2)."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("text").cast("string").alias("text"))
    apart = held_out("doc_id", 4, 2)
    model = train(*labelled_sample(docs, apart, max_rows), **options)
    release_memory()
    return predict(docs.withColumn("held_out", apart), model, ("doc_id", "held_out"))
