"""Conversation structure repair: the cheapest edits that make a conversation's roles legal.

A legal conversation's role initials read ``(s?(ua)+)?``. ``lattice`` has the method: the auction algorithm for
shortest paths over (rows read, state), and the ASCII-least trace of the tight arcs.

A conversation of ordinary size is one row (its turns gathered in order) and solved at once. One with more than
``LARGE_ROWS`` rows or ``LARGE_BYTES`` of text is never gathered: its rows get their places from range-partitioned blocks
and are solved block by block. A block is a map between the few vectors of relative prices, so prices run from the
last block to the first, and states from the first to the last, over one small row per block; the blocks' own edits are
then traced in parallel. What is sequential by contract, the SHA-256 of a whole repaired conversation, streams over its
sorted blocks and holds one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidal.llm import lattice
from tidal.llm.common import arrow_rows, partitions, python_ready, written
from tidal.llm.ordering import numbered

LARGE_ROWS = 1024
LARGE_BYTES = 256 << 10
BLOCK = 512
SPACE = "\t\n\x0b\x0c\r "
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_RESULT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
           "audit string, repaired_sha256 string")
LEGAL_PAIRS = {"su", "ua", "au"}


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: rows damaged by crc32(``conv_id:turn``) % 20 (a null is one space): 0 drops a
    row (``gone``), 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 sets its role to user."""
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20).cast("int")
    rows = conversations.select(F.col("conv_id"), F.col("turn").cast("bigint").alias("turn"), text("role").alias("role"),
                                text("text").alias("text"), kind.alias("kind"))
    words = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       words.alias("text"), (F.col("kind") == 0).alias("gone"),
                       F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"))
    return rows.drop("again")


def _prepared(rows: DataFrame, gone: str | None) -> DataFrame:
    """g (the conversation's key, no null), conv_id, turn, role, text, gone, fault (before duplicates are known)."""
    flag = F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)
    rows = rows.select(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("g"), "conv_id",
                       F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), flag.alias("gone"))
    inner = F.btrim("text", F.lit(SPACE))
    fault = (F.when(inner == "", lattice.BAD).when(~F.right(inner, F.lit(1)).isin(".", "!", "?"), lattice.CUT)
             .otherwise(lattice.SOUND))
    return rows.withColumn("fault", fault)


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:], strict=False))


def _line(turn: tuple[str, str]) -> bytes:
    return f"{turn[0]}:{turn[1]}".encode()


def _faults(turns: list[dict]) -> tuple[dict, bytes]:
    """Counts of first faults, and the row codes, of a whole conversation in order."""
    seen, counts, codes = set(), dict.fromkeys(_COUNTS, 0), bytearray()
    for t in turns:
        key, fault = (t["role"], t["text"]), t["fault"]
        if fault == lattice.BAD:
            counts["blank"] += 1
        elif key in seen:
            fault = lattice.BAD
            counts["duplicate"] += 1
        elif fault == lattice.CUT:
            counts["truncated"] += 1
        seen.add(key)
        codes.append(lattice.code(t["role"][:1], fault))
    counts["illegal"] = _illegal([t["role"][:1] for t in turns])
    return counts, bytes(codes)


def _gaps(turns: list[dict]) -> int:
    known = {t["turn"] for t in turns if t["turn"] is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


def _solve_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gathered conversations (conv_id, turns) -> their results and repaired turns."""
    for batch in batches:
        out: dict[str, list] = {n: [] for n in ("gaps", *_COUNTS, "cost", "audit", "repaired_sha256", "repaired")}
        for turns in batch.column("turns"):
            turns = [t for t in turns.as_py() if not t["gone"]]
            counts, codes = _faults(turns)
            labels = lattice.trace(codes)
            repaired = lattice.apply(labels, [(t["role"], t["text"]) for t in turns])
            row = counts | {"gaps": _gaps(turns), "cost": lattice.cost(codes), "audit": "".join(labels),
                            "repaired_sha256": hashlib.sha256(b"\n".join(map(_line, repaired))).hexdigest(),
                            "repaired": [{"role": r, "text": t} for r, t in repaired]}
            for n, v in row.items():
                out[n].append(v)
        kinds = dict.fromkeys(("gaps", *_COUNTS, "cost"), pa.int64()) | {"audit": pa.string(), "repaired_sha256": pa.string(),
                                                                         "repaired": pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))}
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *[pa.array(out[n], kinds[n]) for n in out]],
                                         names=["conv_id", *out])


_TURNS = "repaired array<struct<role:string,text:string>>"


def _whole(rows: DataFrame) -> DataFrame:
    kind = rows.schema["conv_id"].dataType.simpleString()
    gathered = rows.groupBy("g").agg(F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(
        F.struct("turn", "role", "text", "gone", "fault"))).alias("turns")).select("conv_id", "turns")
    return gathered.mapInArrow(_solve_whole, f"conv_id {kind}, {_RESULT}, {_TURNS}")


# --- large conversations, block by block ----------------------------------------------------

def _block_maps(batches):
    for batch in batches:
        before, rise = [], []
        for codes in batch.column("codes"):
            at, up = lattice.block_map(codes.as_py())
            before.append(at.tolist())
            rise.append(up.tolist())
        yield pa.RecordBatch.from_arrays([batch.column("g"), batch.column("block"), pa.array(before, pa.list_(pa.int32())),
                                          pa.array(rise, pa.list_(pa.int64()))], names=["g", "block", "before", "rise"])


def _run_prices(batches):
    """Blocks from the last to the first: the vector behind each block, and at the first one the cost."""
    g = behind = total = None
    for batch in batches:
        out = [], [], [], []
        for row in batch.to_pylist():
            if row["g"] != g:
                g, behind, total = row["g"], 0, 0
            total += row["rise"][behind]
            here, behind = behind, row["before"][behind]
            done = total + lattice.VECTORS[behind][lattice.START] if row["block"] == 0 else None
            for column, value in zip(out, (g, row["block"], here, done), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            out, (pa.string(), pa.int64(), pa.int32(), pa.int64()), strict=True)], names=["g", "block", "behind", "cost"])


def _block_exits(batches):
    for batch in batches:
        found = [lattice.exits(c.as_py(), b.as_py()) for c, b in zip(batch.column("codes"), batch.column("behind"), strict=True)]
        names = ["g", "block", "behind", "cost"]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(found, pa.list_(pa.int32()))],
                                         names=[*names, "exits"])


def _run_states(batches):
    """Blocks from the first to the last: the state before each."""
    g = state = None
    for batch in batches:
        states = []
        for row in batch.select(["g", "exits"]).to_pylist():
            if row["g"] != g:
                g, state = row["g"], lattice.START
            states.append(state)
            state = row["exits"][state]
        names = ["g", "block", "behind", "cost"]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(states, pa.int32())], names=[*names, "state"])


def _block_edits(batches):
    """Solved blocks: their audit and repaired turns, counts, first and last initial."""
    for batch in batches:
        out = [], [], [], []
        for row in batch.to_pylist():
            turns = row["turns"]
            labels = lattice.trace(row["codes"], row["behind"], row["state"], row["final"])
            repaired = lattice.apply(labels, [(t["role"], t["text"]) for t in turns], row["state"])
            initials = ([row["previous"]] if row["previous"] is not None else []) + [t["role"][:1] for t in turns]
            for column, value in zip(out, ("".join(labels), [{"role": r, "text": t} for r, t in repaired], _illegal(initials),
                                           row["block"]), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column("g"), pa.array(out[3], pa.int64()), pa.array(out[0], pa.string()),
             pa.array(out[1], pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))), pa.array(out[2], pa.int64())],
            names=["g", "block", "audit", "repaired", "illegal"])


def _run_digests(batches):
    """Edited blocks in order -> audit, digest and illegal pairs of each conversation; one block's text is held at a time."""
    g, state = None, None

    def ended():
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(
            (g, "".join(state["audit"]), state["sha"].hexdigest(), state["illegal"]),
            (pa.string(), pa.string(), pa.string(), pa.int64()), strict=True)], names=["g", "audit", "repaired_sha256", "illegal"])
    for batch in batches:
        for i in range(batch.num_rows):
            if (key := batch.column("g")[i].as_py()) != g:
                if state:
                    yield ended()
                g, state = key, {"audit": [], "sha": hashlib.sha256(), "illegal": 0, "any": False}
            state["audit"].append(batch.column("audit")[i].as_py())
            state["illegal"] += batch.column("illegal")[i].as_py()
            for turn in batch.column("repaired")[i]:
                t = turn.as_py()
                state["sha"].update(b"\n" * state["any"] + _line((t["role"], t["text"])))
                state["any"] = True
    if state:
        yield ended()


def _in_order(df: DataFrame, *order) -> DataFrame:
    return df.repartition(partitions(df.sparkSession), "g").sortWithinPartitions("g", *order)


def _large_blocks(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edited blocks: g, block, audit, repaired, illegal; per conversation: g, conv_id, gaps, counts, cost)."""
    base = written(rows.where("not gone").drop("gone"), "large")
    placed = written(numbered(base, "g", ["turn", "role", "text"]), "placed")
    first = placed.groupBy("g", F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
                           ).agg(F.min("idx").alias("idx")).select("g", "idx", F.lit(True).alias("new"))
    # a row is the first of its kind or a duplicate; the join's key is unique on either side
    marked = placed.join(first, ["g", "idx"], "left")
    again = F.col("new").isNull() & (F.col("fault") != lattice.BAD)
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    final_fault = F.when(again, lattice.BAD).otherwise(F.col("fault"))
    marked = marked.select(
        "g", "conv_id", "turn", "role", "text", "idx", "total", F.expr(f"idx div {BLOCK}").alias("block"),
        (number * 3 + final_fault).alias("code"), (F.col("fault") == lattice.BAD).alias("blank"), again.alias("duplicate"),
        (final_fault == lattice.CUT).alias("truncated"))
    blocks = written(marked.groupBy("g", "block").agg(
        F.sort_array(F.collect_list(F.struct("idx", "role", "text", "code"))).alias("turns"), F.first("conv_id").alias("conv_id"),
        F.first("total").alias("total"), *[F.sum(F.col(c).cast("bigint")).alias(c) for c in ("blank", "duplicate", "truncated")])
        .withColumn("codes", F.unhex(F.array_join(F.expr("transform(turns, t -> lpad(hex(t.code), 2, '0'))"), ""))), "blocks")
    small = blocks.select("g", "block", "codes")
    maps = written(small.mapInArrow(_block_maps, "g string, block bigint, before array<int>, rise array<bigint>"), "maps")
    prices = written(_in_order(maps, F.desc("block")).mapInArrow(_run_prices, "g string, block bigint, behind int, cost bigint"), "prices")
    exits = small.join(prices, ["g", "block"]).mapInArrow(
        _block_exits, "g string, block bigint, behind int, cost bigint, exits array<int>")
    states = written(_in_order(exits, "block").mapInArrow(
        _run_states, "g string, block bigint, behind int, cost bigint, state int"), "states")
    last = blocks.select("g", (F.col("block") + 1).alias("block"), F.expr("substring(element_at(turns, -1).role, 1, 1)").alias("previous"))
    ready = (blocks.join(states.drop("cost"), ["g", "block"]).join(last, ["g", "block"], "left")
             .withColumn("final", (F.col("block") + 1) * BLOCK >= F.col("total")))
    with arrow_rows(rows.sparkSession, 8):
        edits = written(ready.select("g", "block", "turns", "codes", "behind", "state", "final", "previous").mapInArrow(
            _block_edits, f"g string, block bigint, audit string, {_TURNS}, illegal bigint"), "edits")
    turns = placed.groupBy("g", "turn").agg(F.lit(1)).groupBy("g").agg(
        (F.coalesce(F.max("turn") - F.min("turn") + 1, F.lit(0)) - F.count("turn")).alias("gaps"))
    per = blocks.groupBy("g").agg(F.first("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    per = per.join(turns, "g").join(states.where("cost is not null").select("g", "cost"), "g")
    return edits, written(per, "large-stats")


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(rows of conversations to be gathered, rows of the large ones or None)."""
    sizes = rows.groupBy("g").agg(F.sum(F.when(~F.col("gone"), 1).otherwise(0)).alias("n"), F.count(F.lit(1)).alias("all"),
                                  F.sum(F.when(~F.col("gone"), F.octet_length("text").cast("bigint"))).alias("bytes"))
    large = written(sizes.where((F.col("all") > LARGE_ROWS) | (F.col("bytes") > LARGE_BYTES)).select("g", "n"), "large-ids")
    if large.isEmpty():
        return rows, None
    # of a large conversation, dropped rows matter only when nothing else is left of it
    empty = rows.join(large.where("n = 0").select("g"), "g", "left_semi").dropDuplicates(["g"])
    return rows.join(large.select("g"), "g", "left_anti").unionByName(empty), rows.join(
        large.where("n > 0").select("g"), "g", "left_semi")


def repair(rows: DataFrame, gone: str | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows`` has conv_id (any type that casts to text), turn, role and text; further columns are ignored. ``gone`` names a
    boolean column of rows that count as dropped (their conversation stays in the result). A null role or text is one space;
    a null conv_id is a conversation of its own. Rows stand by turn (nulls first); at equal turns by role, then text, in UTF-8
    order; repeated rows are duplicates. Without rows: zeros, an empty audit, the digest of nothing. An empty table gives no rows.
    """
    python_ready(rows.sparkSession)
    whole, large = _split(_prepared(rows, gone))
    out = _whole(whole).drop("repaired")
    if large is None:
        return out
    edits, per = _large_blocks(large)
    ends = _in_order(edits, "block").mapInArrow(_run_digests, "g string, audit string, repaired_sha256 string, illegal bigint")
    return out.unionByName(per.join(ends, "g").select(out.columns))


def repaired_turns(rows: DataFrame, gone: str | None = None) -> DataFrame:
    """The repaired conversations themselves: conv_id, block, place, role, text (in order of block and place)."""
    python_ready(rows.sparkSession)
    whole, large = _split(_prepared(rows, gone))
    out = _whole(whole).select("conv_id", F.lit(0).cast("bigint").alias("block"), "repaired")
    if large is not None:
        edits, per = _large_blocks(large)
        out = out.unionByName(edits.join(per.select("g", "conv_id"), "g").select("conv_id", "block", "repaired"))
    turns = out.select("conv_id", "block", F.posexplode("repaired").alias("place", "turn"))
    return turns.select("conv_id", "block", "place", "turn.role", "turn.text")


def _crc32_sql(text: str) -> str:
    """The unsigned crc32 of an ASCII text in DuckDB SQL; -1 stands for one of the eight shifts after each byte."""
    return (f"xor(4294967295, list_reduce(flatten([[4294967295], flatten(list_transform(string_split({text}, ''), "
            "lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))]), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) "
            "WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))")


def oracle() -> str:
    """The repair of damaged ``conversations`` in DuckDB SQL: one row back per step, the best (cost, audit, lines) per state."""
    def way(cost, label, line, rest):
        lines = f"list_prepend({line}, {rest}.t)" if line else f"{rest}.t"
        return f"{{'c': {rest}.c + {cost}, 'a': '{label}' || {rest}.a, 't': {lines}}}"

    def least(*ways):
        return f"list_min([{', '.join(ways)}])"
    keep = "CASE WHEN ini = '{}' AND NOT bad THEN 0 ELSE 1000000 END + cut"
    rerole = "CASE WHEN bad THEN 1000000 ELSE 2 END + cut"

    def read(q, turns):
        ways = [way("3", "D", "", f"s{q}")]
        for ini, role, to in turns:
            ways.append(way(keep.format(ini), "K", "role || ':' || text", to))
            if role:
                ways.append(way(rerole, "R", f"'{role}:' || text", to))
        return least(*ways)
    user, assistant = ("u", "user", "su"), ("a", "assistant", "sa")
    return f"""WITH RECURSIVE raw AS (
SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
{_crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS k FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
FROM (SELECT *, unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS again FROM raw) WHERE k <> 0),
o AS (SELECT *, coalesce('=' || CAST(conv_id AS VARCHAR), '') AS g, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM d),
f AS (SELECT *, left(role, 1) AS ini, lag(left(role, 1)) OVER (PARTITION BY g ORDER BY n) || left(role, 1) AS pair,
NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, row_number() OVER (PARTITION BY g, role, text ORDER BY n) > 1 AS seen,
regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) NOT IN ('.', '!', '?') AS open FROM o),
r AS (SELECT *, blank OR seen AS bad, CASE WHEN open AND NOT blank AND NOT seen THEN 1 ELSE 0 END AS cut FROM f),
step AS (SELECT g, max(n) + 1 AS n, {{'c': 0, 'a': '', 't': CAST([] AS VARCHAR[])}} AS s0,
{{'c': 4, 'a': 'II', 't': ['user:', 'assistant:']}} AS ss, {{'c': 2, 'a': 'I', 't': ['assistant:']}} AS su,
{{'c': 0, 'a': '', 't': CAST([] AS VARCHAR[])}} AS sa FROM r GROUP BY g
UNION ALL SELECT g, n, {least('b0', way(2, 'I', "'user:'", 'bu'))}, {least('bs', way(2, 'I', "'user:'", 'bu'))}, bu, ba
FROM (SELECT g, n, b0, bs, {least('bu', way(2, 'I', "'assistant:'", 'ba'))} AS bu, {least('ba', way(2, 'I', "'user:'", 'bu'))} AS ba
FROM (SELECT r.g, r.n, {read('0', [user, ('s', '', 'ss')])} AS b0, {read('s', [user])} AS bs,
{read('u', [assistant])} AS bu, {read('a', [user])} AS ba FROM step JOIN r ON r.g = step.g AND r.n = step.n - 1))),
totals AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
count(*) FILTER (seen AND NOT blank) AS duplicate, sum(cut) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
FROM r GROUP BY g),
ids AS (SELECT DISTINCT conv_id, coalesce('=' || CAST(conv_id AS VARCHAR), '') AS g FROM conversations)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(s0.c, 0) AS BIGINT) AS cost,
coalesce(s0.a, '') AS audit, sha256(coalesce(array_to_string(s0.t, chr(10)), '')) AS repaired_sha256
FROM ids LEFT JOIN totals USING (g) LEFT JOIN (SELECT * FROM step WHERE n = 1) s USING (g)"""
