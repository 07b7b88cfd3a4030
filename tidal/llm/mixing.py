"""Mixing sources to target weights by entropy balancing (DataFrame functions only).

Every document i of source s gets a rate r_i, the copies it is to have. Among all rates between 0 and
``cap`` that meet the token constraints ``sum(r_i * size_i) = target_s``, those closest to one copy
each in (bounded) relative entropy are exponentially tilted by the constraint's coefficient:

    r_i = cap * e / (cap - 1 + e),   e = exp(lambda_s * size_i)

The dual is convex in one lambda per source. Newton's steps, kept inside a shrinking bracket, run for
all sources at once; each step is one aggregate over the documents' (source, size) histogram. A source
at its cap has the rate ``cap`` outright.

Rates become copies by sequential Poisson rounding: a document has ``floor(r)`` copies, and one more if
its hash in (0, 1) is at most ``t_s`` times the rest of its rate. The cut ``t_s`` (about 1) is searched
in rounds of histograms so that the words come as near to the target as one document allows: first over
the source's larger documents, then over those below a quarter of its mean size, which make good what
the larger ones left. What a source of few documents is off by then is made up by up to ``FLIPS`` of its documents, one
after the other: that whose size comes nearest to the words missing gets a copy more (or less). Nothing is ordered or
numbered in a single task but the table of sources (one row each).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidal.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
STEPS = 60
TOLERANCE = 1e-7              # of the target, for the rates; rounding is far coarser
ROUNDS = 2
BINS = 4096
FLIPS = 4
NEAR = 5e-4                     # of the target: a source this near is left alone
KEYS = 4.0                      # keys of hash / rest are searched from 0 to here; the cut is about 1


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def _by_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """left joined with right on source, null being a source like any other."""
    r = right.withColumnRenamed("source", "_source")
    return left.join(r, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Sources in code point order, null last, have the weights in turn and share ``share`` of all words;
    a target stops at ``cap`` times its source's size and the rest of it is shared by weight again.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())          # one row per source
    turn = F.array(*[F.lit(float(w)) for w in weights])
    s = total.withColumn("w", F.element_at(turn, (F.row_number().over(order) - 1) % len(weights) + 1))
    s = s.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    # level k: sources sorted by how soon they fill up; the first that does not fill sets the level
    soon = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = soon.rowsBetween(Window.unboundedPreceding, -1)
    after = soon.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = s.withColumn("level", (F.sum("source_size").over(everything) * F.lit(float(share))
                               - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("w").over(after))
    s = s.withColumn("o", F.row_number().over(soon))
    s = s.withColumn("level", F.min(F.when(F.col("level") * F.col("w") <= F.col("most"), F.struct(
        "o", F.col("level").alias("v")))).over(everything)["v"])
    return s.select("source", "source_size", F.coalesce(F.least(F.col("most"), F.col("level") * F.col("w")),
                                                        F.col("most")).alias("target"))


def tilted(size: Column, lam: Column, cap: float) -> Column:
    """The rate of a document (exponents are held within the range of doubles)."""
    e = F.exp(F.least(F.greatest(lam * size, F.lit(-700.0)), F.lit(700.0)))
    return F.when(lam == float("inf"), F.lit(cap)).otherwise(F.lit(cap) * e / (F.lit(cap - 1) + e))


def _tilts(hist: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """targets with ``lam``: Newton's steps on the dual, one aggregate over ``hist`` each."""
    mean = F.col("source_size") / F.greatest(F.col("docs"), F.lit(1))
    docs = hist.groupBy("source").agg(F.sum("n").alias("docs"))
    full = (F.col("target") >= F.col("source_size") * F.lit(cap) * (1 - 1e-12))
    at = _by_source(targets, docs)
    at = (at.withColumn("full", full).withColumn("lam", F.lit(0.0))
          .withColumn("lo", -1e3 / F.greatest(mean, F.lit(1e-9))).withColumn("hi", 1e3 / F.greatest(mean, F.lit(1e-9)))
          .withColumn("gap", F.lit(float("inf"))))
    at = written(at, "tilts")
    for _ in range(STEPS):
        h = _by_source(hist, at)
        r = tilted(F.col("size"), F.col("lam"), cap)
        x = F.col("size").cast("double")
        sums = h.groupBy(*at.columns).agg(F.sum(F.col("n") * x * r).alias("g"),
                                          F.sum(F.col("n") * x * x * r * (1 - r / F.lit(cap))).alias("h"))
        off = F.col("g") - F.col("target")
        step = F.col("lam") - F.try_divide(off, F.col("h"))
        lo = F.when(off < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(off >= 0, F.col("lam")).otherwise(F.col("hi"))
        nxt = (sums.withColumn("lo2", lo).withColumn("hi2", hi).withColumn("step", step)
               .withColumn("new", F.when(F.col("step").isNotNull() & (F.col("step") > F.col("lo2"))
                                         & (F.col("step") < F.col("hi2")), F.col("step"))
                           .otherwise((F.col("lo2") + F.col("hi2")) / 2))
               .withColumn("gap2", F.when(F.col("full"), 0.0).otherwise(F.abs(off) / F.greatest(F.col("target"), F.lit(1.0)))))
        at = written(nxt.select("source", "source_size", "target", "docs", "full",
                                F.when(F.col("gap2") < TOLERANCE, F.col("lam")).otherwise(F.col("new")).alias("lam"),
                                F.col("lo2").alias("lo"), F.col("hi2").alias("hi"), F.col("gap2").alias("gap")), "tilts")
        worst = at.agg(F.max("gap")).first()[0]
        if worst is None or worst < TOLERANCE:
            break
    return at.select("source", "source_size", "target", "docs",
                     F.when(F.col("full"), F.lit(float("inf"))).otherwise(F.col("lam")).alias("lam"))


def _cuts(rows: DataFrame, at: DataFrame) -> DataFrame:
    """(source, cut, words): the cut on ``key`` at which the words of the rows below it, added to ``words``,
    come nearest to ``target``. ``rows``: source, size, key. ``at``: source, target, words."""
    at = at.withColumn("lo", F.lit(0.0)).withColumn("width", F.lit(KEYS))
    there = (F.col("key") >= F.col("lo")) & (F.col("key") < F.col("lo") + F.col("width"))
    for _ in range(ROUNDS):
        inside = _by_source(rows, at).where(there)
        place = F.least(F.floor((F.col("key") - F.col("lo")) / F.col("width") * BINS), F.lit(BINS - 1))
        bins = inside.withColumn("bin", place).groupBy(
            "source", "target", "lo", "width", "words", "bin").agg(F.sum("size").alias("s"))
        run = Window.partitionBy("source").orderBy("bin")            # at most BINS rows a source
        passed = bins.withColumn("upto", F.col("words") + F.sum("s").over(run))
        found = passed.groupBy("source").agg(
            F.max(F.when(F.col("upto") <= F.col("target"), F.struct("bin", "upto"))).alias("last"),
            F.min(F.when(F.col("upto") > F.col("target"), F.struct("bin", "s"))).alias("next"))
        joined = _by_source(at, found, "left")
        at = written(joined.select(
            "source", "target",
            (F.col("lo") + F.coalesce(F.col("next.bin"), F.lit(BINS)) * F.col("width") / BINS).alias("lo"),
            (F.col("width") / BINS).alias("width"),
            F.coalesce(F.col("last.upto"), F.col("words")).alias("words"),
            F.coalesce(F.col("next.s"), F.lit(0)).alias("s")), "cuts")
    # the bin in which the target is passed holds one row, or a few with the same hash
    take = (F.col("words") + F.col("s") - F.col("target") <= F.col("target") - F.col("words")) & (F.col("s") > 0)
    return at.select("source", F.when(take, F.col("lo") + F.col("width")).otherwise(F.col("lo")).alias("cut"),
                     (F.col("words") + F.when(take, F.col("s")).otherwise(0)).alias("words"))


def _rated(rows: DataFrame, plan: DataFrame, cap: float) -> DataFrame:
    """Rows (doc_id, source, size, ...) with the plan's columns and rate, base, rest, key, small."""
    rate = tilted(F.col("size"), F.col("lam"), cap)
    unit = (F.shiftrightunsigned(F.xxhash64(F.lit("mix"), F.col("doc_id")), 12).cast("double") + 0.5) / float(1 << 52)
    return (_by_source(rows, plan).withColumn("rate", rate).withColumn("base", F.floor("rate").cast("bigint"))
            .withColumn("rest", F.col("rate") - F.col("base"))
            .withColumn("key", F.when(F.col("rest") > 0, unit / F.col("rest")))
            .withColumn("small", F.col("size") * F.col("docs") * 4 <= F.col("source_size")))


def mixing_plan(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per source: source_size, target, docs, lam and the rounding cuts, from (doc_id, source, size)."""
    hist = written(sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    targets = written(source_targets(hist.select("source", (F.col("size") * F.col("n")).alias("size")),
                                     weights, share, cap), "targets")
    tilts = written(_tilts(hist, targets, cap), "tilts")
    rated = written(_rated(sizes, tilts, cap).select("source", "size", "base", "rest", "key", "small", "target"), "rated")
    open_rows = rated.where("rest > 0")
    due = written(rated.groupBy("source").agg(
        F.max("target").alias("target"), F.sum(F.col("size") * F.col("base")).alias("base"),
        F.sum(F.when(F.col("small"), 0.0).otherwise(F.col("rest") * F.col("size"))).alias("large")), "due")
    large = written(_cuts(open_rows.where("not small").select("source", "size", "key"),
                          due.select("source", (F.col("base") + F.col("large")).alias("target"),
                                     F.col("base").alias("words"))), "large")
    left = _by_source(due.select("source", "target"), large)
    small = _cuts(open_rows.where("small").select("source", "size", "key"), left.select("source", "target", "words"))
    plan = _by_source(_by_source(tilts, large.select("source", "cut")),
                      small.select("source", F.col("cut").alias("small_cut")))
    return _with_flips(sizes, written(plan, "plan"), cap)


def _with_flips(sizes: DataFrame, plan: DataFrame, cap: float) -> DataFrame:
    """``plan`` with ``flips``: per source up to ``FLIPS`` doc_ids that get a copy more or less."""
    none = F.expr("cast(array() as array<struct<doc_id:bigint,change:int>>)")
    plan = plan.withColumn("flips", none)
    rows = written(apply_plan(sizes.select("doc_id", "source", "size"), plan, cap).where("size > 0").select(
        "doc_id", "source", "size", "copies"), "rounded")
    taken = rows.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("words"))
    at = written(_by_source(plan.select("source", "target", "flips"), taken).select(
        "source", "target", "flips", (F.col("target") - F.col("words")).alias("missing")), "missing")
    most = F.lit(math.ceil(cap))
    sign = F.when(F.col("missing") > 0, 1).otherwise(-1)
    changed = F.greatest(F.lit(0), F.least(most, F.col("copies") + sign)) - F.col("copies")
    for _ in range(FLIPS):
        far = at.where(F.abs("missing") > F.col("target") * NEAR)
        if far.isEmpty():
            break
        met = _by_source(rows, far).where(F.col("doc_id").isNotNull() & ~F.exists("flips", lambda f: f["doc_id"] == F.col("doc_id")))
        after = F.abs(F.col("missing") - F.col("size") * changed)
        best = met.where((changed != 0) & (after < F.abs("missing"))).groupBy("source").agg(
            F.min(F.struct(after.alias("after"), F.xxhash64(F.lit("flip"), "doc_id").alias("h"), "doc_id")).alias("best"))
        best = written(_by_source(far, best).withColumn("chosen", F.col("best.doc_id")).drop("best"), "flips")
        # rows that repeat the doc_id change as well: the flip stays if the source comes nearer all the same
        effect = _by_source(rows, best).where(F.col("doc_id") == F.col("chosen")).groupBy("source").agg(
            F.sum(F.col("size") * changed).alias("effect"))
        done = _by_source(best, effect).where(F.abs(F.col("missing") - F.col("effect")) < F.abs("missing"))
        done = done.select("source", "chosen", sign.cast("int").alias("change"), "effect")
        one = F.array(F.struct(F.col("chosen").alias("doc_id"), "change"))
        at = written(_by_source(at, done, "left").select(
            "source", "target", F.when(F.col("chosen").isNotNull(), F.concat("flips", one)).otherwise(F.col("flips")).alias("flips"),
            (F.col("missing") - F.coalesce("effect", F.lit(0))).alias("missing")), "missing")
    flips = at.select("source", F.col("flips").alias("flipped"))
    return written(_by_source(plan, flips, "left").withColumn("flips", F.coalesce("flipped", "flips")).drop("flipped"), "plan")


def apply_plan(rows: DataFrame, plan: DataFrame, cap: float = 2.0) -> DataFrame:
    """``rows`` (with doc_id, source, size) and source_size, target, rate, copies, taken. Row by row."""
    out = _rated(rows, plan, cap)
    cut = F.when(F.col("small"), F.col("small_cut")).otherwise(F.col("cut"))
    copies = F.col("base") + F.when((F.col("rest") > 0) & (F.col("key") < cut), 1).otherwise(0)
    flip = F.get(F.filter("flips", lambda f: f["doc_id"] == F.col("doc_id")), F.lit(0))["change"]
    copies = F.greatest(F.lit(0), F.least(F.lit(math.ceil(cap)), copies + F.coalesce(flip, F.lit(0)))).cast("bigint")
    return out.select(*rows.columns, "source_size", "target", "rate", copies.alias("copies"),
                      (copies * F.col("size")).alias("taken"))


def mixed(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(doc_id, source, size) rows with source_size, target, rate, copies and taken (words, long).

    Rows are told apart by ``doc_id`` alone when rounding: rows that repeat a doc_id in one source get
    the same extra copy or none of them does. A null source is a source; a null doc_id hashes like any
    other. Sizes of 0 take nothing. An empty table gives no rows. Rows of equal input get equal copies,
    on every run.
    """
    return apply_plan(sizes, mixing_plan(sizes, weights, share, cap), cap)


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix of a table of documents; size is the number of words of ``text`` (null: 0)."""
    return mixed(document_sizes(docs), **options)


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) of documents, counted once."""
    return written(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                               F.col("source").cast("string").alias("source"),
                               word_count("text").alias("size")), "sizes")


def mixed_copies(docs: DataFrame, cap: float = 2.0, **options) -> DataFrame:
    """The mix itself: every document as many times as it has copies, with ``copy`` 1, 2, ... and its rate."""
    plan = mixing_plan(document_sizes(docs), cap=cap, **options)
    rows = docs.withColumnsRenamed({c: f"_d_{c}" for c in docs.columns}).select(
        "*", F.col("_d_doc_id").cast("bigint").alias("doc_id"), F.col("_d_source").cast("string").alias("source"),
        word_count("_d_text").alias("size"))
    out = apply_plan(rows, plan, cap).where("copies > 0")
    taken = [c for c in docs.columns if c not in ("copy", "copies", "rate")]
    return out.select(*[F.col(f"_d_{c}").alias(c) for c in taken], F.col("copies"), F.col("rate"),
                      F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
