"""N-gram Jaccard join: all links between texts whose word-shingle sets are similar enough.

Two sets x, y link when ``100 |x and y| >= 75 |x or y|``. Method:

* *Rare first.* A fixed-size table of shingle counts (2**18 hash buckets over the whole corpus)
  orders the shingles of every set by (bucket count, hash). Any order common to all sets keeps the
  join exact; this one puts rare shingles first.
* *Prefix and length filter.* With a = ceil(3 (n + m) / 7) shared shingles needed, similar sets
  share a shingle within the first n - a + 1 of one and m - a + 1 of the other. A set therefore
  posts its first n - ceil(3n/4) + 1 shingles, and is met as the smaller side only through its
  first n - ceil(6n/7) + 1.
* *Positional filter.* A meeting at positions (p, q) can only be the first one of a similar pair if
  ``p <= n - a`` and ``q <= m - a``.
* *Suffix filter.* Each set keeps its shingle counts over 256 hash parts; the sum of the lesser
  counts bounds the overlap from above.
* *Verification once per pair*: the distinct pairs left are checked on their whole sets.

Equal sets are one class (a 64-bit hash of the set), joined through one representative. Links are
needed only up to connectivity, so the join runs in two steps. First every posting meets one hub of
its posting list (the set that comes earliest in it), which ties large groups of copies together in
linear work. Then only sets of *different* components meet each other, in full, by shingle and size band. No link
between components is lost, and the pairs inside a large group of copies are never listed.

Scale: a task posts a class once, however many copies it reads, and postings are shuffled once by shingle hash;
one sort there drops the copies of other tasks, leaves out shingles of one class and finds the hubs. Shingles
whose bucket count is far above the mean are salted, so no task gets all postings of a hot shingle. Later joins are
equi-joins that adaptive execution splits. Only the bucket table (1 MB, whatever the input), bitmaps of 16 MB
at most and, if they are few (``FEW_LABELS``), the components found first go to all tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidal.llm.common import (U64, arrow_rows, bitmap, in_bitmap, mix, partitions, python_ready,
                              shingle_sets, spare_names, split_by_ids, tidy, written)
from tidal.llm.components import components

BUCKET_BITS = 18
PARTS = 256
SLICE = 1 << 14                 # bucket counts in one row of the partial tables
HOT = 8                         # times the mean bucket count: a shingle beyond this is salted
FEW_LABELS = 500_000            # classes with a component (16 bytes each) that are sent to every task

_SETS = ("doc_id bigint, n int, cid bigint, parts array<int>, slice int, counts binary")


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> U64(64 - BUCKET_BITS)).astype(np.int64)


def _class_id(s: np.ndarray) -> int:
    total = mix(s ^ U64(0xA24BAED4963EE407)).sum(dtype=np.uint64, keepdims=True)
    return int(mix(total ^ U64(len(s))).view(np.int64)[0])


def _parts(s: np.ndarray) -> np.ndarray:
    return np.bincount((s & U64(PARTS - 1)).astype(np.int64), minlength=PARTS).astype(np.int32)


def _summaries(width: int):
    """Per text: set size and class; per task: its bucket counts, in slices."""
    def run(batches):
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            n, cid, parts = [], [], []
            for _, s in shingle_sets(batch.column("text"), width):
                n.append(len(s))
                cid.append(_class_id(s) if len(s) else None)
                parts.append(_parts(s) if len(s) else None)
                if len(s):
                    np.add.at(total, _bucket(s), 1)
            k = len(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int32()), pa.array(cid, pa.int64()),
                 pa.array(parts, pa.list_(pa.int32())), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())],
                names=["doc_id", "n", "cid", "parts", "slice", "counts"])
        if total.any():
            cuts = total.astype("<i8").reshape(-1, SLICE)
            used = [i for i in range(len(cuts)) if cuts[i].any()]
            k = len(used)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()),
                 pa.nulls(k, pa.list_(pa.int32())), pa.array(used, pa.int32()),
                 pa.array([cuts[i].tobytes() for i in used], pa.binary())],
                names=["doc_id", "n", "cid", "parts", "slice", "counts"])
    return run


def _added(batches):
    """Partial bucket tables added up, one row per slice in this partition."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, c in zip(batch.column("slice").to_pylist(), batch.column("counts"), strict=True):
            a = np.frombuffer(c.as_buffer(), "<i8")
            if i in total:
                total[i] += a
            else:
                total[i] = a.copy()
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
        names=["slice", "counts"])


def _bucket_counts(sums: DataFrame) -> np.ndarray:
    parts = (sums.where("slice is not null").select("slice", "counts")
             .repartition(1 << (BUCKET_BITS - 14), "slice").mapInArrow(_added, "slice int, counts binary"))
    out = np.zeros((1 << (BUCKET_BITS - 14), SLICE), np.int64)
    for row in parts.collect():         # a fixed 16 slices of 128 KB
        out[row["slice"]] += np.frombuffer(row["counts"], "<i8")
    return out.reshape(-1)


def _postings(width: int, counts, hot_over: float, salts: int):
    """The rare-first prefix of every set: (h, salt, cid, n, pos)."""
    def run(batches):
        order = counts.value
        posted: set[int] = set()            # classes of this task, at most one per row it reads
        for batch in batches:
            cols: list[list[np.ndarray]] = [[], [], [], [], []]
            for _, s in shingle_sets(batch.column("text"), width):
                n = len(s)
                if n == 0 or (cid := _class_id(s)) in posted:
                    continue
                posted.add(cid)
                seen = order[_bucket(s)]
                keep = n - (3 * n + 3) // 4 + 1
                first = np.lexsort((s, seen))[:keep]
                hot = seen[first] > hot_over
                cols[0].append(s[first].view(np.int64))
                cols[1].append(np.where(hot, cid % salts, -1).astype(np.int32))
                cols[2].append(np.full(keep, cid, np.int64))
                cols[3].append(np.full(keep, n, np.int32))
                cols[4].append(np.arange(keep, dtype=np.int32))
                if sum(map(len, cols[0][-64:])) > 1 << 17:
                    yield _batch(cols)
                    cols = [[], [], [], [], []]
            if cols[0]:
                yield _batch(cols)
    return run


def _batch(cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols],
                                      names=["h", "salt", "cid", "n", "pos"])


def _of_wanted(wanted, width: int):
    """(doc_id, cid, text) of the wanted doc_ids (the bitmap lets a few more through)."""
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            there = ids.is_valid().to_numpy(zero_copy_only=False)
            there[there] = in_bitmap(wanted.value, ids.drop_null().to_numpy())
            kept = batch.filter(pa.array(there))
            cid = [_class_id(s) if len(s) else None for _, s in shingle_sets(kept.column("text"), width)]
            yield pa.RecordBatch.from_arrays([kept.column("doc_id"), pa.array(cid, pa.int64()), kept.column("text")],
                                             names=["doc_id", "cid", "text"])
    return run


def _compare(width: int):
    """Pairs with both texts -> the pairs whose shingle sets link."""
    def run(batches):
        for batch in batches:
            left, right = shingle_sets(batch.column("ta"), width), shingle_sets(batch.column("tb"), width)
            ok = []
            for (_, x), (_, y) in zip(left, right, strict=True):
                o = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * o >= 75 * (len(x) + len(y) - o))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def _needed(n, m):
    """ceil(3 (n + m) / 7): the shared shingles a similar pair of sizes n, m has."""
    return F.expr(f"(3 * ({n} + {m}) + 6) div 7")


def _meet(n, m, p, q):
    """Length and positional filter on a meeting of two prefixes."""
    a = _needed(n, m)
    return ((F.col(n) * 4 >= F.col(m) * 3) & (F.col(m) * 4 >= F.col(n) * 3)
            & (F.col(p) <= F.col(n) - a) & (F.col(q) <= F.col(m) - a))


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """The pairs (a, b) of classes that truly link. Suffix filter first, then whole sets."""
    side = classes.select("cid", "n", "parts")
    left = side.toDF("a", "na", "pa")
    right = side.toDF("b", "nb", "pb")
    bound = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    spark = docs.sparkSession
    left_over = written(pairs.join(left, "a").join(right, "b").where(bound >= _needed("na", "nb"))
                        .select("a", "b"), "pairs")
    wanted = left_over.select(F.col("a").alias("cid")).union(left_over.select("b")).distinct()
    ids = written(wanted.join(classes.select("cid", "rep"), "cid").select(F.col("rep").alias("doc_id")).distinct(), "ids")
    bits = spark.sparkContext.broadcast(bitmap(ids))
    texts = docs.mapInArrow(tidy(_of_wanted(bits, width)), "doc_id bigint, cid bigint, text string").where("cid is not null")
    texts = written(texts.join(ids, "doc_id", "left_semi").select("cid", "text"), "texts")
    bits.destroy()
    both = (left_over.join(texts.toDF("b", "tb"), "b").join(texts.toDF("a", "ta"), "a"))
    with arrow_rows(spark, 250):
        return written(both.mapInArrow(tidy(_compare(width)), "a bigint, b bigint"), "links")


def _labelled(shared: DataFrame, links: DataFrame) -> DataFrame:
    """Each posting with the component of its class among ``links``."""
    found = written(components(links, "a", "b").toDF("cid", "found"), "labels")
    if found.count() <= FEW_LABELS:
        found = F.broadcast(found)
    return shared.join(found, "cid", "left").withColumn("comp", F.coalesce("found", "cid")).drop("found")


def _index_side() -> str:
    return "pos <= n - (6 * n + 6) div 7"


def _band(n: str):
    """Sizes of similar sets lie in one band or in neighbouring ones."""
    return F.floor(F.log(F.col(n).cast("double")) / F.log(F.lit(4 / 3))).cast("int")


def _shared(post: DataFrame) -> DataFrame:
    """The postings of shingles that two classes or more have, once per class, with a hub: the earliest posting
    of the list in the posting's size band or the one below. One sort by (h, salt, band, cid) serves all windows."""
    lists = Window.partitionBy("h", "salt")
    band = lists.orderBy("band")
    banded = post.withColumn("band", _band("n"))
    once = banded.withColumn("again", F.col("cid") == F.lag("cid").over(lists.orderBy("band", "cid")))
    hubs = once.withColumn("hub", F.min(F.when(F.expr(_index_side()), F.struct("pos", "n", "cid"))).over(band.rangeBetween(-1, 0)))
    both = hubs.withColumn("lo", F.min("cid").over(lists)).withColumn("hi", F.max("cid").over(lists))
    return both.where("(lo <> hi or salt >= 0) and again is not true").select(
        "h", "salt", "cid", "n", "pos", "band", F.col("hub.cid").alias("b"), F.col("hub.n").alias("nb"), F.col("hub.pos").alias("qb"))


def _hub_pairs(lists: DataFrame) -> DataFrame:
    """Each posting with its hub, if they may be the first meeting of a similar pair. The sub-lists of a salted shingle
    share the earliest of their hubs: one hub ties a large group together by one link each."""
    hot = lists.where("salt >= 0")
    hubs = hot.where("b is not null").groupBy("h", "band").agg(F.min(F.struct("qb", "nb", "b")).alias("hub"))
    hot = hot.drop("b", "nb", "qb").join(hubs, ["h", "band"]).select(
        "cid", "n", "pos", F.col("hub.b").alias("b"), F.col("hub.nb").alias("nb"), F.col("hub.qb").alias("qb"))
    every = lists.where("salt < 0").select("cid", "n", "pos", "b", "nb", "qb").unionByName(hot)
    met = every.where((F.col("cid") != F.col("b")) & _meet("n", "nb", "pos", "qb"))
    return met.select(F.greatest("cid", "b").alias("a"), F.least("cid", "b").alias("b")).distinct()


def _cross_pairs(lists: DataFrame) -> DataFrame:
    """Every meeting of two sets of different components: the smaller set by its index prefix, with the larger ones of its
    own size band and the one above."""
    mixed = (lists.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .where("lo <> hi").select("h"))
    kept = written(lists.join(mixed, "h", "left_semi").select("h", "band", "cid", "n", "pos", "comp"), "mixed")
    x = kept.where(_index_side()).select("h", F.explode(F.array("band", F.expr("band + 1"))).alias("band"), F.col("cid").alias("a"),
                                         F.col("n").alias("na"), F.col("pos").alias("qa"), F.col("comp").alias("ca"))
    y = kept.select("h", "band", F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("qb"),
                    F.col("comp").alias("cb"))
    smaller = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    met = x.join(y, ["h", "band"]).where((F.col("ca") != F.col("cb")) & smaller & _meet("na", "nb", "qa", "qb"))
    return met.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def jaccard_links(docs: DataFrame, width: int = 5, hot_over: float | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sets, classes, links) of a table with ``doc_id`` and ``text``.

    ``sets``: doc_id, n, cid per row. ``classes``: cid, n, rep (least doc_id), members, parts per
    distinct set. ``links``: pairs (a, b) of class ids, enough to connect all that links connect.
    ``hot_over``: bucket counts beyond which postings are salted (by default from the mean count).
    """
    spark = docs.sparkSession
    python_ready(spark)
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    sums = written(docs.mapInArrow(tidy(_summaries(width)), _SETS), "summaries")
    sets = sums.where("n is not null").select("doc_id", "n", "cid")
    classes = written(sums.where("cid is not null").groupBy("cid").agg(
        F.max("n").alias("n"), F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("members"),
        F.first("parts").alias("parts")), "classes")
    counts = _bucket_counts(sums)
    total = int(counts.sum())
    if hot_over is None:
        hot_over = max(HOT * total / len(counts), 1000.0)
    order = spark.sparkContext.broadcast(counts)
    post = docs.select("text").mapInArrow(tidy(_postings(width, order, hot_over, partitions(spark))),
                                          "h bigint, salt int, cid bigint, n int, pos int")
    shared = written(_shared(post), "postings")
    order.destroy()
    # classes whose members all lack a doc_id take no part in links
    real = classes.where("rep is not null")
    links = _verified(_hub_pairs(shared), real, docs, width)
    lists = _labelled(shared, links)
    more = _verified(_cross_pairs(lists), real, docs, width)
    return sets, classes, links.union(more)


def near_duplicates(docs: DataFrame, width: int = 5, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, class_id, class_size.

    ``component_id`` is the least doc_id reachable by links, itself included. An empty or null text
    has no shingles and is linked with nothing. A text with fewer than ``width`` words is one
    shingle (its whole sequence). Equal texts are linked. A row without doc_id gets the component of
    equal texts that have one, else null. Rows that repeat a doc_id are compared by their own text.
    """
    sets, classes, links = jaccard_links(docs, width, **options)
    found = components(links, "a", "b").toDF("cid", "root")
    rooted = classes.join(found, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = rooted.join(least, "root").select("cid", "component_id", "members")
    full = sets.where("cid is not null").join(named, "cid").select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"), "component_id",
        F.col("cid").alias("class_id"), F.col("members").alias("class_size"))
    bare = sets.where("cid is null").select(
        "doc_id", F.lit(0).cast("bigint").alias("n_shingles"), F.col("doc_id").alias("component_id"),
        F.lit(None).cast("bigint").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"))
    return full.unionByName(bare)


def _doubtful_with_class(shared, width: int, key: str, text: str, cid: str):
    """The rows without an id or with one in the bitmap, and the class of their text."""
    def run(batches):
        for batch in batches:
            ids = batch.column(key)
            perhaps = np.ones(len(ids), bool)
            valid = ids.is_valid().to_numpy(zero_copy_only=False)
            perhaps[valid] = in_bitmap(shared.value, ids.drop_null().to_numpy())
            kept = batch.filter(pa.array(perhaps))
            found = [_class_id(s) if len(s) else None for _, s in shingle_sets(kept.column(text), width)]
            rest = kept.drop_columns([text])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(found, pa.int64())], names=[*rest.schema.names, cid])
    return run


def keep_one(docs: DataFrame, width: int = 5) -> DataFrame:
    """The rows of ``docs`` with one document left of each component: that of the least doc_id.

    Texts without shingles are no copies and all stay, but rows repeating doc_id and text stay once. Rows
    without a doc_id stay unless an equal text has one; of equal ones, one stays. Columns of any name go along.
    """
    found = written(near_duplicates(docs, width), "components")
    again = found.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"),
                                                                    F.min("component_id").alias("c"))
    doubtful = written(again.where("n > 1 or c <> doc_id").select("doc_id"), "doubtful")
    surely, _ = split_by_ids(docs.where("doc_id is not null"), doubtful)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(doubtful))
    text, key, cid, kept_key, kept_cid, place = spare_names(docs, "_text", "_id", "_cid", "_kid", "_kcid", "_n")
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    rows = docs.withColumn(text, F.col("text").cast("string")).withColumn(key, F.col("doc_id").cast("bigint"))
    rows = rows.mapInArrow(tidy(_doubtful_with_class(shared, width, key, text, cid)), f"{kind}, `{key}` bigint, `{cid}` bigint")
    kept = found.where(F.col("component_id").eqNullSafe(F.col("doc_id"))).select(
        F.col("doc_id").alias(kept_key), F.col("class_id").alias(kept_cid)).distinct()
    left = rows.join(kept, F.col(key).eqNullSafe(F.col(kept_key)) & F.col(cid).eqNullSafe(F.col(kept_cid)), "left_semi")
    same = Window.partitionBy(key, cid).orderBy(*[F.xxhash64(c) for c in docs.columns])
    once = left.withColumn(place, F.row_number().over(same)).where(F.col(place) == 1).drop(place, key, cid)
    return surely.unionByName(once)
