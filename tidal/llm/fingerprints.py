"""Document fingerprints by consistent weighted sampling (DataFrame functions only).

A text is a weighted set: its lower-cased words with their counts. For sample j and term t, with
gamma(2, 1) variates r, c and a uniform b drawn from a hash of (t, j), a weight w gives

    k = floor(ln w / r + b),   ln a = ln c - r (k - b + 1)

and the sample is the (t, k) of least a. Two texts share a sample with probability equal to their
generalised Jaccard similarity (sum of lesser counts over sum of greater ones). A fingerprint holds
``samples`` 20-bit hashes of such (t, k) as hex, so equal texts have equal fingerprints; the share of
equal samples estimates the similarity.

Words are exploded and counted within the partition that holds the document, so one shuffle (the
documents by block) serves the neighbour, the counting and the minima. The draws of a term serve both
texts of a document. A minimum of a and its sample's hash travel in one long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidal.llm.common import partitions, written

SAMPLES = 32
GROUP = 4                       # samples made by one row
HASH_BITS = 20
HEX = HASH_BITS // 4
#: ln a is held as an integer of 42 bits: (ln a + LIFT) * SCALE
LIFT, SCALE = 1024.0, float(1 << 31)
NO_TERMS = "0" * HEX
SPACE = r"[\x20\x09-\x0D]+"


def _unit(h: Column, shift: int) -> Column:
    """20 bits of a hash as a number in (0, 1)."""
    return (F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << 20) - 1)).cast("double") + 0.5) / float(1 << 20)


def _sample(term: Column, log_weights: list[Column], j: Column) -> list[Column]:
    """For one sample, one long per weight: a (upper bits) and the hash of (term, k)."""
    h = F.xxhash64(term, j)
    g = F.xxhash64(h)
    r = -F.log(_unit(h, 0) * _unit(h, 20))
    log_c = F.log(-F.log(_unit(h, 40) * _unit(g, 0)))
    b = _unit(g, 20)
    out = []
    for log_w in log_weights:
        k = F.floor(log_w / r + b)
        log_a = log_c - r * (k - b + 1)
        order = ((log_a + LIFT) * SCALE).cast("bigint")
        tag = F.xxhash64(h, k).bitwiseAND(F.lit((1 << HASH_BITS) - 1))
        out.append(F.shiftleft(order, HASH_BITS).bitwiseOR(tag))
    return out


def signatures(terms: DataFrame, keys: list[str], weights: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys`` and one fingerprint string per column of ``weights``, from rows (keys, term, weights).

    A weight of 0 or null means that the term isn't in that set; a set without terms has no string (null).
    Aggregates by ``keys``; rows that are already together by a part of ``keys`` aren't moved.
    """
    groups = samples // GROUP
    logs = [f"_l{i}" for i in range(len(weights))]
    rows = terms.select(*keys, "term", *[F.when(F.col(w) > 0, F.log(F.col(w).cast("double"))).alias(x)
                                         for w, x in zip(weights, logs, strict=True)],
                        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_g"))
    for i in range(GROUP):
        for n, c in enumerate(_sample(F.col("term"), [F.col(x) for x in logs], F.col("_g") * GROUP + i)):
            rows = rows.withColumn(f"_s{n}_{i}", c)
    least = rows.groupBy(*keys, "_g").agg(*[F.min(f"_s{n}_{i}").alias(f"_s{n}_{i}")
                                           for n in range(len(weights)) for i in range(GROUP)])
    part = lambda n: F.concat(*[F.lpad(F.lower(F.hex(F.col(f"_s{n}_{i}").bitwiseAND(
        F.lit((1 << HASH_BITS) - 1)))), HEX, "0") for i in range(GROUP)])
    parts = least.select(*keys, "_g", *[part(n).alias(w) for n, w in enumerate(weights)])
    gathered = parts.groupBy(*keys).agg(*[F.sort_array(F.collect_list(F.when(F.col(w).isNotNull(), F.struct(
        "_g", F.col(w).alias("p"))))).alias(w) for w in weights])
    return gathered.select(*keys, *[F.when(F.size(w) > 0, F.concat_ws("", F.transform(
        F.col(w), lambda x: x["p"]))).alias(w) for w in weights])


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints."""
    same = [F.when(F.substring(a, i * HEX + 1, HEX) == F.substring(b, i * HEX + 1, HEX), 1).otherwise(0)
            for i in range(samples)]
    total = same[0]
    for x in same[1:]:
        total = total + x
    return total / float(samples)


def _block(ids: DataFrame, rows_per_block: int = 500, most: int = 100_000, segments: int = 256) -> Column:
    """The block of a doc_id: ascending runs of ids, about ``rows_per_block`` rows each, at most ``most``.

    Segments are cut at approximate quantiles; each is cut into equal widths of ids. Null is in block 0.
    """
    size = ids.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    wanted = min(-(-size["n"] // rows_per_block), most)
    if wanted < 2 or size["lo"] is None:
        return F.lit(0)
    count = min(wanted, segments)
    each = -(-wanted // count)
    found = ids.stat.approxQuantile("doc_id", [i / count for i in range(1, count)], 0.2 / count)
    cuts = sorted({int(c) for c in found if size["lo"] < int(c) <= size["hi"]})
    starts = [size["lo"], *cuts]
    ends = [*cuts, size["hi"] + 1]
    step = [max(1, -(-(b - a) // each)) for a, b in zip(starts, ends, strict=True)]

    def place(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo * each) + F.floor((F.col("doc_id") - starts[lo]) / step[lo]).cast("int")
        mid = (lo + hi) // 2
        return F.when(F.col("doc_id") >= starts[mid + 1], place(mid + 1, hi)).otherwise(place(lo, mid))
    return F.coalesce(place(0, len(starts) - 1), F.lit(0))


def _first_rows(placed: DataFrame) -> DataFrame:
    """The first row of each block (least doc_id, nulls first, then least text), put at the end of the
    block before; that of the first block closes the last one. One row per block."""
    spark = placed.sparkSession
    least = placed.groupBy("block").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id")).alias("m"))
    rows = sorted((r["block"], r["m"]["doc_id"]) for r in least.collect())      # at most 100,000 blocks
    ends = [(rows[i - 1][0], b, d) for i, (b, d) in enumerate(rows)]
    at = F.broadcast(spark.createDataFrame(ends, "ends int, b int, d bigint"))
    found = placed.join(at, (placed["block"] == at["b"]) & placed["doc_id"].eqNullSafe(at["d"]))
    return found.groupBy("ends", "doc_id").agg(F.min("text").alias("text")).select(
        F.coalesce("ends", F.lit(0)).alias("block"), "doc_id", "text", F.lit(1).alias("ghost"))


def with_next(docs: DataFrame) -> DataFrame:
    """(block, rn, ghost, doc_id, text, next_text): rows in order of (doc_id nulls first, text).

    Rows are sorted within blocks (runs of doc_ids). Each block ends with a ghost row, a copy of the
    first row of the next block, so that its last row has a next text as well.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    placed = docs.withColumn("block", _block(docs.select("doc_id")).cast("int"))
    # read back as never null, so that both readers of the shuffle below have one plan and share it
    ghosts = written(_first_rows(placed), "ghosts").withColumns(
        {c: F.coalesce(c, F.lit(v)) for c, v in (("block", 0), ("ghost", 1))})
    rows = (placed.withColumn("ghost", F.lit(0)).unionByName(ghosts)
            .repartition(2 * partitions(docs.sparkSession), "block"))
    order = Window.partitionBy("block").orderBy("ghost", F.col("doc_id").asc_nulls_first(), "text")
    return rows.select("block", F.row_number().over(order).alias("rn"), "ghost", "doc_id", "text",
                       F.lead("text").over(order).alias("next_text"))


def fingerprint_documents(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has the last floor(n_chars / 2) code points replaced by as many of the first of the
    next document (or all it has), in order of doc_id (nulls first, then by text); after the last row
    comes the first. Null texts are empty. A text without words has the fingerprint of an empty set
    (all zeros), which is like every other empty one (1.0) and unlike any text. One row per row of
    ``docs``; rows repeating an id are told apart by their place. An empty table gives no rows. Extra
    columns are ignored.
    """
    led = with_next(docs)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half),
                      F.coalesce(F.substr("next_text", F.lit(1), half), F.lit("")))
    led = led.withColumn("edited", edited)
    words = (led.select("block", "rn", F.posexplode(F.array("text", "edited")).alias("v", "t"))
             .select("block", "rn", "v", F.explode(F.split(F.lower("t"), SPACE)).alias("word")).where("word <> ''"))
    terms = words.groupBy("block", "rn", F.xxhash64("word").alias("term")).agg(
        F.sum(F.when(F.col("v") == 0, 1).otherwise(0)).alias("w0"), F.sum("v").alias("w1"))
    sig = signatures(terms, ["block", "rn"], ["w0", "w1"], samples)
    empty = F.lit(NO_TERMS * samples)
    meta = led.select("block", "rn", "ghost", "doc_id", F.length("text").cast("bigint").alias("n_chars"),
                      F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    out = meta.join(sig, ["block", "rn"], "left").select(
        "block", "rn", "ghost", "doc_id", "n_chars", "edited_sha256",
        F.coalesce("w0", empty).alias("fingerprint"), F.coalesce("w1", empty).alias("edited_fingerprint"))
    out = out.withColumn("next_fingerprint", F.lead("fingerprint").over(Window.partitionBy("block").orderBy("rn")))
    return out.where("ghost = 0").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        _near(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        _near(F.col("fingerprint"), F.col("next_fingerprint"), samples).alias("near_next"))


def _near(a: Column, b: Column, samples: int) -> Column:
    empty = F.lit(NO_TERMS * samples)
    return F.when((a == empty) | (b == empty), (a == b).cast("double")).otherwise(likeness(a, b, samples))
