"""Merkle manifest of a table: leaves, roots and a membership proof of every row, few levels stored.

A row's leaf is the digest of its fields. Within a group, leaves stand in order; every ``fan`` consecutive nodes
(the last run fewer, even one) are hashed into a node of the next level until one is left, the group's root.
The group roots make the last tree in the same way.

*Checkpoint and recompute.* Only every ``every``-th level is written. The nodes between two stored levels
belong to aligned subtrees of ``fan ** every`` stored nodes; such a subtree is gathered as one small row, its
missing levels are hashed anew on the way up (to get the next stored level) and again on the way down (to emit
the siblings on each node's way to the root), and are then dropped.

Scale: texts are read once and never shuffled; a leaf row is some 200 bytes. Places in a group come from
range-partitioned blocks, and subtrees are keyed by (group, number of the subtree), so a group with a third of
all rows spreads like any other. The way down joins a subtree with the proof of its top, one row to one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidal.llm.common import written
from tidal.llm.ordering import numbered

FAN = 16
EVERY = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts' concatenated texts."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A field as ``bytes:value`` (length in UTF-8 bytes), or ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def lower_a_z(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _height(n: Column, fan: int) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves."""
    h, reach = F.lit(None).cast("int"), 1
    steps = []
    while reach < 1 << 62:
        steps.append(reach)
        reach *= fan
    for k in reversed(range(len(steps))):
        h = F.when(n <= steps[k], F.lit(k)).otherwise(h)
    return h


def _subtrees(nodes: DataFrame, fan: int, every: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """Aligned subtrees of a stored level: g, up (number of the subtree), h, m (its stored nodes), their ``rows``
    and ``l0`` ... ``l<every>``, the digests of each level, regenerated."""
    out = (nodes.groupBy("g", F.expr(f"idx div {fan ** every}").alias("up"))
           .agg(F.first("h").alias("h"), F.sort_array(F.collect_list(F.struct("idx", "node", *extra))).alias("rows")))
    out = out.select("g", "up", "h", F.size("rows").alias("m"), "rows", F.expr("transform(rows, r -> r.node)").alias("l0"))
    for k in range(every):
        out = out.withColumn(f"l{k + 1}", F.expr(
            f"transform(sequence(0, (size(l{k}) - 1) div {fan}), r -> sha2(array_join(slice(l{k}, r * {fan} + 1, {fan}), ''), 256))"))
    return out


def _up(nodes: DataFrame, level: int, fan: int, every: int) -> DataFrame:
    """The next stored level; a group that has come to its root keeps it."""
    top = F.col(f"l{every}")[0]
    for k in reversed(range(every)):
        top = F.when(F.col("h") <= level + k, F.col(f"l{k}")[0]).otherwise(top)
    return _subtrees(nodes, fan, every).select("g", F.col("up").alias("idx"), "h", top.alias("node"))


def _down(nodes: DataFrame, above: DataFrame, level: int, fan: int, every: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """The siblings on the way from every node of a stored level to the root, given those of the subtrees' tops."""
    trees = _subtrees(nodes, fan, every, extra).join(above.withColumnRenamed("idx", "up").drop("node"), ["g", "up"])
    each = trees.select("*", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("p"))
    steps = []
    for k in range(every):
        at = f"(p div {fan ** k})"
        steps.append(F.expr(
            f"if(h > {level + k}, array(struct(array_join(slice(l{k}, {at} - {at} % {fan} + 1, {at} % {fan}), '') as left, "
            f"array_join(slice(l{k}, {at} + 2, {fan - 1} - {at} % {fan}), '') as right)), cast(array() as {_PATH}))"))
    row = F.expr("rows[p]")
    return each.select("g", row["idx"].alias("idx"), row["node"].alias("node"), *[row[c].alias(c) for c in extra],
                       *[c for c in above.columns if c not in ("g", "idx", "node", "path")],
                       F.concat(*steps, F.col("path")).alias("path"))


def stored_levels(leaves: DataFrame, fan: int = FAN, every: int = EVERY) -> list[DataFrame]:
    """The stored levels over ``leaves`` (g, idx, total, node, written); the last has each group's root only."""
    base = leaves.withColumn("h", _height(F.col("total"), fan))
    top = base.agg(F.max("h")).first()[0] or 0
    out, level = [base], 0
    while level < top:
        out.append(written(_up(out[-1].select("g", "idx", "h", "node"), level, fan, every), "level"))
        level += every
    return out


def proofs(levels: list[DataFrame], above: DataFrame, fan: int = FAN, every: int = EVERY,
           extra: tuple[str, ...] = ()) -> DataFrame:
    """g, idx, node, ``extra`` columns, path and further columns of ``above`` of every leaf; ``above`` has the path
    over each group's root (g, path)."""
    path = above.withColumn("idx", F.lit(0).cast("bigint"))
    if len(levels) == 1:
        return levels[0].select("g", "idx", "node", *extra).join(path.drop("idx"), "g")
    for k in reversed(range(len(levels) - 1)):
        path = _down(levels[k], path, k * every, fan, every, extra if k == 0 else ())
    return path


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def manifest(docs: DataFrame, fan: int = FAN, every: int = EVERY) -> DataFrame:
    """A proof of every row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves stand by doc_id (null first; rows that repeat one by their leaf) within each source; sources by UTF-8
    bytes, null first (an empty source is a source of its own). Where 5 divides the unsigned crc32 of the decimal
    doc_id, the row is held to have been tampered with: ``folded_root`` is made from the leaf of the text with A-Z
    lower-cased (a null text or doc_id stays). Empty texts are fields of 0 bytes. An empty table gives no rows.
    """
    docs = docs.select(*[F.col(c).cast("bigint" if c in ("doc_id", "n_chars") else "string").alias(c) for c in FIELDS])
    fields = {c: field(F.col(c)) for c in FIELDS}
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    changed = digest(*(fields | {"text": field(lower_a_z(F.col("text")))}).values())
    leaves = written(docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("g"), "doc_id",
        digest(*fields.values()).alias("node"), F.when(chosen & F.col("text").isNotNull(), changed).alias("tampered")), "leaves")
    levels = stored_levels(numbered(leaves, "g", ["doc_id", "node"]), fan, every)
    subroots = levels[-1].select("g", F.col("node").alias("subroot"))
    # the tree of the sources: one group, its leaves the subroots in order of their source
    tops = written(subroots.select(F.lit("").alias("g"), F.col("g").alias("key"), F.col("subroot").alias("node")), "subroots")
    top_levels = stored_levels(numbered(tops, "g", ["key"]), fan, every)
    empty = F.expr(f"cast(array() as {_PATH})")
    roots = top_levels[-1].select(F.col("node").alias("root"))
    whole = proofs(top_levels, top_levels[-1].select("g", empty.alias("path")), fan, every, ("key",))
    above = written(whole.select(F.col("key").alias("g"), F.col("node").alias("subroot"), "path"), "tops")
    root = roots.first()
    rows = proofs(levels, above, fan, every, ("doc_id", "tampered"))
    rows = rows.withColumn("root", F.lit(root["root"] if root else None).cast("string"))
    return rows.select(
        "doc_id", F.col("node").alias("leaf"), "subroot", "root",
        F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""), 256).alias("proof_sha256"),
        folded(F.coalesce("tampered", "node"), F.col("path")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def _tree_sql(name: str, leaves: str, levels: int) -> str:
    """CTEs of a tree over ``leaves`` (g, idx, node, total): its levels, and each leaf's siblings level by level."""
    out = [f"{name}0 AS (SELECT g, idx, node, total AS n FROM {leaves})"]
    for k in range(1, levels + 1):
        out.append(f"{name}{k} AS (SELECT g, idx // 16 AS idx, CASE WHEN min(n) > 1 THEN sha256(string_agg(node, '' ORDER BY idx)) "
                   f"ELSE min(node) END AS node, (min(n) + 15) // 16 AS n FROM {name}{k - 1} GROUP BY g, idx // 16)")
    for k in range(levels):
        out.append(f"{name}s{k} AS (SELECT a.g, a.idx, coalesce(string_agg(b.node, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l, "
                   f"coalesce(string_agg(b.node, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r, min(a.n) > 1 AS up "
                   f"FROM {name}{k} a JOIN {name}{k} b ON a.g = b.g AND a.idx // 16 = b.idx // 16 GROUP BY a.g, a.idx)")
    return ", ".join(out)


def oracle(levels: int = 8, top_levels: int = 5) -> str:
    """The manifest of ``documents`` in DuckDB SQL (sources of up to 16**levels rows, up to 16**top_levels sources)."""
    def leaf(text: str) -> str:
        parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in
                 ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(parts)})"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # a decimal id byte by byte: -1 stands for one of the eight shifts of the checksum after each byte
    crc = ("xor(4294967295, list_reduce(flatten([[4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))]), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) "
           "WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))")
    here, tops = [f"s{k}" for k in range(levels)], [f"t{k}" for k in range(top_levels)]
    # each step of the fold is its own column, else the text of the formula would double with every level
    steps = [*here, *tops]
    fold_ctes = ["f0 AS (SELECT *, CASE WHEN tampered THEN changed ELSE node END AS folded FROM paths)"]
    fold_ctes += [f"f{k + 1} AS (SELECT * EXCLUDE (folded), CASE WHEN {s}_up THEN sha256({s}_l || folded || {s}_r) ELSE folded END AS folded FROM f{k})"
                  for k, s in enumerate(steps)]
    cols = ", ".join(f"{s}.l AS {s}_l, {s}.r AS {s}_r, {s}.up AS {s}_up" for s in steps)
    joins = " ".join(f"JOIN ss{k} s{k} ON s{k}.g = d.g AND s{k}.idx = d.idx // {16 ** k}" for k in range(levels))
    joins += " JOIN tl ON tl.key = d.g " + " ".join(f"JOIN ts{k} t{k} ON t{k}.idx = tl.idx // {16 ** k}" for k in range(top_levels))
    proof = " || ".join(f"CASE WHEN {s}_up THEN {s}_l || {s}_r ELSE '' END" for s in steps)
    return f"""WITH base AS (SELECT doc_id, coalesce('=' || source, '') AS g, {leaf('text')} AS node, {leaf(lower)} AS changed,
coalesce({crc} % 5 = 0, FALSE) AND text IS NOT NULL AS tampered FROM documents),
d AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, node) - 1 AS idx, count(*) OVER (PARTITION BY g) AS total
FROM base), {_tree_sql('s', 'd', levels)},
tl AS (SELECT '' AS g, g AS key, node, row_number() OVER (ORDER BY encode(g)) - 1 AS idx, count(*) OVER () AS total FROM s{levels}),
{_tree_sql('t', 'tl', top_levels)},
paths AS (SELECT d.*, tl.node AS subroot, {cols} FROM d {joins}), {', '.join(fold_ctes)}
SELECT f.doc_id, f.node AS leaf, f.subroot, r.node AS root, sha256({proof}) AS proof_sha256, f.folded AS folded_root,
f.folded = r.node AS verified FROM f{len(steps)} f, t{top_levels} r"""
