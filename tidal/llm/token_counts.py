"""Token counts: an exact histogram of encoded lengths and what its suffix sums answer.

Every whole text is encoded with a public byte-pair tokenizer; documents are counted by length. From the
histogram, suffix sums give, for every length L seen, the documents at least that long and their tokens,
and so the total when texts are cut to a context of L tokens, the tokens lost, and quantiles. A limit
between two lengths has the sums of the next longer one.

Only the histogram is shuffled (map-side counted, at most one row per distinct length). Suffix sums run
in blocks of lengths: inside each block, and over the block totals (one row per 256 lengths).
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidal.llm.common import python_ready, written

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: how byte-level tokenizers of this kind cut a text before merging (fixed value)
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK = 256


def _encoder(ranks: bytes, pattern: str):
    import tiktoken
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def _lengths(shared, pattern: str):
    def run(batches):
        encode = _encoder(shared.value, pattern).encode_ordinary
        for batch in batches:
            column = batch.column("text")
            out = np.zeros(len(column), np.int64)
            for i, text in enumerate(column):
                value = text.as_py()
                if value:
                    out[i] = len(encode(value))
            keep = [i for i, name in enumerate(batch.schema.names) if name != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in keep], pa.array(out)],
                                             names=[*[batch.schema.names[i] for i in keep], "n_tokens"])
    return run


def token_lengths(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN,
                  keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and n_tokens of every row. Null and empty texts have 0 tokens.

    ``vocabulary`` is a file of base64 tokens and ranks that the driver reads; tasks get it broadcast (a
    megabyte or so). No special tokens: their strings are ordinary text.
    """
    spark = docs.sparkSession
    python_ready(spark)
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    cols = docs.select(*keep, F.col("text").cast("string").alias("text"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in cols.schema if f.name != "text")
    return cols.mapInArrow(_lengths(shared, pattern), schema + "n_tokens bigint")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, docs): the number of rows of each length."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("docs"))


def suffix_table(histogram: DataFrame) -> DataFrame:
    """One row per length L of the histogram, with sums over all documents.

    docs, tokens (of length L); docs_from, tokens_from (of length L or more); docs_share (share of
    documents of at most L tokens, the quantile of L); kept_tokens (all tokens with every text cut to L);
    lost_tokens. An empty histogram gives no rows.
    """
    block = F.floor(F.col("n_tokens") / BLOCK)
    rows = histogram.withColumn("block", block).withColumn("tokens", F.col("n_tokens") * F.col("docs"))
    blocks = rows.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)     # one row a block
    whole = Window.partitionBy()
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_later"),
                           F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_later"),
                           F.sum("d").over(whole).alias("d_all"), F.sum("t").over(whole).alias("t_all"))
    inside = Window.partitionBy("block").orderBy(F.col("n_tokens").desc())
    s = rows.join(blocks, "block")
    s = (s.withColumn("docs_from", F.sum("docs").over(inside) + F.col("d_later"))
         .withColumn("tokens_from", F.sum("tokens").over(inside) + F.col("t_later")))
    kept = F.col("t_all") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")
    return s.select("n_tokens", "docs", "tokens", "docs_from", "tokens_from",
                    ((F.col("d_all") - F.col("docs_from") + F.col("docs")) / F.col("d_all")).alias("docs_share"),
                    kept.alias("kept_tokens"), (F.col("t_all") - kept).alias("lost_tokens"))


def at_limits(table: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, docs_over, kept_tokens, lost_tokens) for any context limits, from a suffix table.

    One pass over the table; the sums of a limit are those of the next length above it.
    """
    rows = []
    for x in limits:
        above = F.col("n_tokens") > int(x)
        docs, tokens = (F.coalesce(F.max(F.when(above, F.col(c))), F.lit(0)) for c in ("docs_from", "tokens_from"))
        lost = tokens - int(x) * docs
        rows.append(F.struct(F.lit(int(x)).cast("bigint").alias("limit"), docs.alias("docs_over"),
                             (F.coalesce(F.sum("tokens"), F.lit(0)) - lost).alias("kept_tokens"), lost.alias("lost_tokens")))
    return table.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def quantiles(table: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the least length L such that ``share`` of the documents have at most L tokens."""
    rows = [F.struct(F.lit(float(x)).alias("share"),
                     F.min(F.when(F.col("docs_share") >= float(x), F.col("n_tokens"))).alias("n_tokens")) for x in shares]
    return table.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def token_table(docs: DataFrame, **options) -> DataFrame:
    """The suffix table of all documents."""
    histogram = written(length_histogram(token_lengths(docs, keep=(), **options)), "lengths")
    return suffix_table(histogram)
