"""Benchmark decontamination: spaced-seed hashing with substitution-tolerant verification.

Texts are read as lower-cased runs of letters and digits. Four fixed masks of nine tokens look at
six of them each and ignore the other three, so a copied passage is hit even where single words were
replaced. The steps:

1. seeds of every benchmark item (mask, place) -> hash; a bitmap of those hashes goes to all tasks (16 MB at
   most whatever the benchmark's size; a fuller bitmap only lets more rows through);
2. seeds of every document that pass the bitmap join the benchmark's by hash, giving distinct
   alignments (doc_id, item_id, shift);
3. documents with an alignment are read again, and the aligned tokens compared: the best segment,
   scoring +1 for an equal token and -2 for another, is an overlap when it has ``min_match`` equal
   tokens (or four fifths of a shorter item) and three quarters of its tokens are equal.

Items of 5 to 8 tokens have one seed of all their tokens, so they are found without substitutions. Items of
1 to 4 tokens stand in many texts by chance: they are found in a document that is the item and nothing else.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidal.llm.common import NOT_ALNUM, U64, _PLACES, bitmap, in_bitmap, mix, python_ready, split_by_ids, text_chunks, tidy, word_hashes, written

MASKS = ((0, 1, 2, 6, 7, 8), (0, 1, 3, 4, 7, 8), (0, 2, 4, 5, 6, 8), (0, 1, 3, 5, 6, 8))
SPAN = 9
SHORTEST = 5


def _tokens(column: pa.Array):
    """(first row, token hashes, their rows, number of rows) of chunks of a text column."""
    for first, data, offsets in text_chunks(column):
        hashes, rows = word_hashes(data, offsets, NOT_ALNUM)
        yield first, hashes, rows, len(offsets) - 1


def _seeds(hashes: np.ndarray, rows: np.ndarray, mask: tuple[int, ...], number: int):
    """(place, hash) of one mask at every place where it fits into its row."""
    span = mask[-1] + 1
    n = len(hashes) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.full(n, number + 1, np.uint64) * U64(0x9E3779B97F4A7C15)
    for place, j in enumerate(mask):
        total += hashes[j:j + n] * _PLACES[place]
    fits = np.flatnonzero(rows[:n] == rows[span - 1:])
    return fits, mix(total[fits])


def _short_mask(length: int) -> tuple[tuple[int, ...], int]:
    return tuple(range(length)), 100 + length


def _all_masks(short: list[int]):
    return [(m, i) for i, m in enumerate(MASKS)] + [_short_mask(k) for k in short]


def _item_seeds(batches):
    for batch in batches:
        ids = batch.column("item_id").to_numpy(zero_copy_only=False)
        for first, hashes, rows, n in _tokens(batch.column("text")):
            counts = np.bincount(rows, minlength=n)
            begin = np.cumsum(counts) - counts
            out = [_seeds(hashes, rows, m, i) for i, m in enumerate(MASKS)]
            for k in range(1, SPAN):
                at, h = _seeds(hashes, rows, *_short_mask(k))
                own = counts[rows[at]] == k
                out.append((at[own], h[own]))
            at, h = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(ids[first + rows[at]].astype(np.int64)),
                 pa.array((at - begin[rows[at]]).astype(np.int32)), pa.array(counts[rows[at]].astype(np.int32))],
                names=["h", "item_id", "off", "length"])


def _doc_seeds(shared, short: list[int]):
    def run(batches):
        bits = shared.value
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for first, hashes, rows, n in _tokens(batch.column("text")):
                counts = np.bincount(rows, minlength=n)
                begin = np.cumsum(counts) - counts
                found = []
                for mask, number in _all_masks(short):
                    at, h = _seeds(hashes, rows, mask, number)
                    hit = in_bitmap(bits, h)
                    if len(mask) < SHORTEST:
                        hit &= counts[rows[at]] == len(mask)
                    found.append((at[hit], h[hit]))
                at, h = (np.concatenate(x) for x in zip(*found, strict=True))
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array(ids[first + rows[at]]),
                         pa.array((at - begin[rows[at]]).astype(np.int32))], names=["h", "doc_id", "pos"])
    return run


def _token_arrays(key: str):
    def run(batches):
        for batch in batches:
            ids = batch.column(key)
            for first, hashes, rows, n in _tokens(batch.column("text")):
                ends = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, n), pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64)))],
                    names=[key, "tokens"])
    return run


def best_segment(same: np.ndarray) -> tuple[int, int, int]:
    """(start, end, equal tokens) of the best run of an alignment: +1 for equal, -2 for different."""
    sums = np.r_[0, np.cumsum(np.where(same, 1, -2))]
    least = np.minimum.accumulate(sums)
    end = int(np.argmax(sums - least))
    start = int(np.argmin(sums[:end + 1]))
    return start, end, int(same[start:end].sum())


def _compare(min_match: int):
    def run(batches):
        for batch in batches:
            docs, items = batch.column("part"), batch.column("item_tokens")
            skip = batch.column("skip").to_pylist()
            size = batch.column("length").to_pylist()
            rows = []
            for r in range(batch.num_rows):
                d = docs[r].values.to_numpy()
                i = items[r].values.to_numpy()[skip[r]:skip[r] + len(d)]
                start, end, equal = best_segment(d[:len(i)] == i)
                need = min(min_match, -(-4 * size[r] // 5))
                rows.append((start + skip[r], end + skip[r], equal, equal >= need and 4 * equal >= 3 * (end - start)))
            start, end, equal, ok = (list(x) for x in zip(*rows, strict=True)) if rows else ([], [], [], [])
            out = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("item_id"), batch.column("shift"), batch.column("length"),
                 pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(equal, pa.int32())],
                names=["doc_id", "item_id", "shift", "length", "start", "end", "matched"])
            yield out.filter(pa.array(ok, pa.bool_()))
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = 12) -> DataFrame:
    """One row per document and benchmark item that overlap, with the best overlap of the two.

    Columns: doc_id, item_id, item_tokens, item_start, item_end (token places in the item), doc_start
    (token place in the document), matched (equal tokens there), coverage (matched / item_tokens).
    Null texts are empty and match nothing; rows without an id are left out; rows repeating an id
    count as one (their best overlap). Empty tables give no rows. Extra columns are ignored.
    """
    spark = docs.sparkSession
    python_ready(spark)
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).where("doc_id is not null")
    items = (benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
             .where("item_id is not null"))
    seeds = written(items.mapInArrow(tidy(_item_seeds), "h bigint, item_id bigint, off int, length int"), "seeds")
    short = [r[0] for r in seeds.where(F.col("length") < SPAN).select("length").distinct().orderBy("length").collect()]
    hits = docs.mapInArrow(tidy(_doc_seeds(spark.sparkContext.broadcast(bitmap(seeds.select("h"))), short)), "h bigint, doc_id bigint, pos int")
    aligned = written(hits.join(seeds, "h").select("doc_id", "item_id", (F.col("pos") - F.col("off")).alias("shift"),
                                                   "length").distinct(), "aligned")
    mine = written(aligned.select("doc_id").distinct(), "aligned-ids")
    texts = split_by_ids(docs, mine)[1].join(mine, "doc_id", "left_semi")
    tokens = texts.mapInArrow(tidy(_token_arrays("doc_id")), "doc_id bigint, tokens array<bigint>")
    item_tokens = items.mapInArrow(_token_arrays("item_id"), "item_id bigint, tokens array<bigint>").withColumnRenamed(
        "tokens", "item_tokens")
    skip = F.greatest(F.lit(0), -F.col("shift"))
    pairs = (aligned.join(tokens, "doc_id")
             .select("doc_id", "item_id", "shift", "length", skip.alias("skip"),
                     F.slice("tokens", F.greatest(F.lit(1), F.col("shift") + 1), F.col("length") - skip).alias("part"))
             .join(item_tokens, "item_id"))
    found = pairs.mapInArrow(tidy(_compare(min_match)), "doc_id bigint, item_id bigint, shift int, length int, "
                                                  "start int, end int, matched int")
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct(
        F.col("matched"), -F.col("start"), "end", "shift", "length")).alias("m"))
    return best.select("doc_id", "item_id", F.col("m.length").alias("item_tokens"),
                       (-F.col("m.col2")).alias("item_start"), F.col("m.end").alias("item_end"),
                       (F.col("m.shift") - F.col("m.col2")).alias("doc_start"), F.col("m.matched").alias("matched"),
                       (F.col("m.matched") / F.col("m.length")).alias("coverage"))
