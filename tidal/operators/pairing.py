"""Keyed pairing of a user stream with an action stream (batch form).

Per user id two cells are remembered, a user U and an action A, and never both at once:

=========  =============================================  ==============================
state      user record arrives                            action record arrives
=========  =============================================  ==============================
empty      U := user                                      A := action
A held     emit (user, A); clear A; the user is NOT kept  A := action (earlier one lost)
U held     U := user (latest wins)                        emit (U, action); U kept
=========  =============================================  ==============================

This is not a join: actions before the first user collapse to the last one, a user that
consumed a waiting action is forgotten, and an action pairs with the latest user only.

Closed form over one user's events in order (kind u or a; ``pk``/``pa`` = previous event's kind
and action; an u event is *locking* when ``pk`` is null or u -- from then on a user is held):

* an u event emits ``(user, pa)`` when ``pk = a`` and no locking event came before it;
* an a event emits ``(latest user so far, action)`` when a locking event came before it.

Everything is a forward scan of each user's events. Users are split by size first: a partial
aggregate counts rows per user, and a user holding more than ``rows / (4 x blocks)`` rows (and
more than one block's worth, which one task windows in seconds) is hot. The hot ids stay a frame
that both parts join; its size decides how. Cold users run the closed form with windows partitioned
by user -- one shuffle, groups bounded by the threshold. Hot users' rows are cut into ordered blocks
(``tidal.operators.blocks``) so that a user holding a third of all rows is spread over many tasks; the
windows then run per (user, block), stitched across blocks with a carry table of at most one row
per block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidal.operators.blocks import BLOCK, ROWS_PER_BLOCK, ordered_blocks
from tidal.session import default_blocks, written

USER_RANK, ACTION_RANK = 0, 1          # on equal ``ts`` a user record sorts before an action
# the order of a user's events; of ``PLACED_ORDER``, a column that the input lacks is left out. ``HELD`` puts a
# state carried in first.
HELD = "_held"
ORDER = ["ts", "_rank", "seq"]
PLACED_ORDER = [HELD, "ts", "_rank", "topic", "partition", "seq"]
POSITION = ("topic", "partition")
OUTPUT = ["userId", "name", "action", "ts", "seq"]
HOT_ROWS_FLOOR = ROWS_PER_BLOCK      # a hot user always fills at least two blocks
TAGGED_COLUMNS = ["userId", "_rank", "ts", "seq", "name", "action"]


def positions(*frames: DataFrame) -> list[str]:
    """The columns of a record's place (topic, partition) that all ``frames`` have."""
    return [c for c in POSITION if all(c in df.columns for df in frames)]


def order_of(ev: DataFrame) -> list[str]:
    return [c for c in PLACED_ORDER if c in ev.columns]


def _tagged(users: DataFrame, actions: DataFrame) -> DataFrame:
    null = F.lit(None).cast("string")
    place = positions(users, actions)
    aside = [c for c in ("_reason", "_raw") if c in users.columns and c in actions.columns]     # of a decode
    u = users.select("userId", F.lit(USER_RANK).alias("_rank"), "ts", *place, "seq", "name",
                     null.alias("action"), *aside)
    a = actions.select("userId", F.lit(ACTION_RANK).alias("_rank"), "ts", *place, "seq",
                       null.alias("name"), "action", *aside)
    # Null ids are dropped by the operators: keyed partitioning of the source rejects them.
    return u.unionByName(a)


def _local_scan(blocked: DataFrame) -> DataFrame:
    """Per (user, block) forward scan; every column is local to the block."""
    w = Window.partitionBy("userId", BLOCK).orderBy(*order_of(blocked))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    is_u = F.col("_rank") == USER_RANK
    step1 = blocked.select(
        "*",
        F.lag("_rank").over(w).alias("_pk"),
        F.lag("action").over(w).alias("_pa"),
        F.last(F.when(is_u, F.struct("name")), ignorenulls=True).over(upto).alias("_lu"),
        F.first("_rank").over(upto).alias("_fk"),
        F.lead("_rank").over(w).isNull().alias("_end"))
    # locking events after the group's first row (the first row depends on the previous block)
    inner_lock = (is_u & (F.col("_pk") == USER_RANK)).cast("int")
    return step1.select(
        "*",
        F.coalesce(F.max(inner_lock).over(before), F.lit(0)).alias("_lock_before"),
        F.max(inner_lock).over(upto).alias("_lock_upto"))


def _carry(local: DataFrame) -> DataFrame:
    """Carry-in state for the first user of each block that continues from the block before.

    One row per block at most: (block, userId, pk_in, pa_in, lu_in, lock_in).
    """
    # Only the last row of each (user, block) group matters: the block's first user is the least
    # user among them, its last row the one of the greatest user.
    last_row = F.max_by(
        F.struct(F.col("userId").alias("user"), F.col("_rank").alias("kind"),
                 F.col("action").alias("act"), F.col("_lu").alias("lu"),
                 F.col("_fk").alias("fk"), F.col("_lock_upto").alias("lock")),
        F.col("userId"))
    summary = local.where("_end").groupBy(BLOCK).agg(F.min("userId").alias("fu"),
                                                     last_row.alias("last"))
    by_block = Window.orderBy(BLOCK)         # over one row per block: bounded, tiny
    s = summary.select(
        BLOCK, "fu", "last",
        F.lag("last").over(by_block).alias("prev"))
    cont = F.col("fu") == F.col("prev.user")
    # pk of the first row of the block's last group: the previous block's last kind when that
    # group is the block's first group and continues from the previous block.
    first_pk = F.when(cont & (F.col("fu") == F.col("last.user")), F.col("prev.kind"))
    own_lock = ((F.col("last.lock") == 1)
                | ((F.col("last.fk") == USER_RANK)
                   & (first_pk.isNull() | (first_pk == USER_RANK))))
    run = Window.partitionBy("last.user").orderBy(BLOCK).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    s = s.select("*", cont.alias("cont"),
                 F.max(own_lock.cast("int")).over(run).alias("cum_lock"),
                 F.last("last.lu", ignorenulls=True).over(run).alias("cum_lu"))
    s = s.select("*", F.lag("cum_lock").over(by_block).alias("lock_in"),
                 F.lag("cum_lu").over(by_block).alias("lu_in"))
    return s.where("cont").select(
        F.col(BLOCK).alias("_cblk"), F.col("fu").alias("_cu"), F.col("prev.kind").alias("_pk_in"),
        F.col("prev.act").alias("_pa_in"), F.col("lu_in").alias("_lu_in"),
        F.col("lock_in").alias("_lock_in"))


def pair_user_action(users: DataFrame, actions: DataFrame, blocks: int | None = None,
                     hot_key_rows: int | None = None) -> DataFrame:
    """Pair actions with remembered users per ``userId``.

    ``users``: ``userId, name, ts, seq``; ``actions``: ``userId, action, ts, seq``. Order is
    ``(ts, user before action, seq)``, with ``topic`` and ``partition`` before ``seq`` where both inputs have
    them. Output ``userId, name, action, ts, seq`` (and those two) where ``ts``/``seq`` are those of the record
    that triggered the output. ``blocks`` is the number of ordered blocks of
    the hot users' rows (default: by their number); ``hot_key_rows`` sets the hot-user threshold.
    """
    return pair_tagged(_tagged(users, actions), blocks, hot_key_rows)


def pair_tagged(ev: DataFrame, blocks: int | None = None, hot_key_rows: int | None = None) -> DataFrame:
    """``pair_user_action`` over an already tagged sequence (``TAGGED_COLUMNS``).

    ``hot_key_rows`` overrides the hot-user threshold (default: ``rows / (4 x blocks)``, at
    least ``HOT_ROWS_FLOOR``).
    """
    return _both(_scanned(ev, blocks, hot_key_rows), _emit)


def pair_and_hold(ev: DataFrame, blocks: int | None = None, hot_key_rows: int | None = None) -> DataFrame:
    """The pairing's output and the cells held at the end, from one scan.

    ``kind`` is ``out`` (rows of ``pair_tagged``) or ``cell`` (per user and block: ``name`` and ``action`` held, with
    ``has_user`` and ``has_action`` as they may be null; a user's last ``block`` counts). Held cells of earlier input take part as
    events of their own kind in front (``HELD`` 0, all others 1): such an event sets the cell and emits nothing.
    """
    return _both(_scanned(ev, blocks, hot_key_rows), _emit_and_hold)


def held_events(cells: DataFrame, like: DataFrame) -> DataFrame:
    """Non-empty cells as first events for ``pair_and_hold``, with the columns of ``like``."""
    own = {"userId": F.col("userId"), HELD: F.lit(0), "name": F.when(F.col("has_user"), F.col("name")),
           "action": F.when(F.col("has_action"), F.col("action")),
           "_rank": F.when(F.col("has_user"), F.lit(USER_RANK)).otherwise(F.lit(ACTION_RANK))}
    return cells.where(F.col("has_user") | F.col("has_action")).select(
        *[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def _scanned(ev: DataFrame, blocks: int | None, hot_key_rows: int | None) -> list[DataFrame]:
    """The scans of the cold users and, if there are any, of the hot ones, with each block's carry-in."""
    ev = ev.where(F.col("userId").isNotNull())
    n_blocks = blocks or default_blocks(ev.sparkSession)
    per_user = ev.groupBy("userId").count()                # partial aggregate: map-side combine
    stats = per_user.agg(F.sum("count").alias("rows"), F.max("count").alias("top")).first()
    if hot_key_rows is None:
        hot_key_rows = max(HOT_ROWS_FLOOR, -(-(stats["rows"] or 0) // (4 * n_blocks)))
    if (stats["top"] or 0) <= hot_key_rows:
        return [_carried(_local_scan(ev.withColumn(BLOCK, F.lit(0))), None)]
    hot = written(per_user.where(F.col("count") > hot_key_rows).select("userId"), "hot-users")
    cold = _local_scan(ev.join(hot, "userId", "left_anti").withColumn(BLOCK, F.lit(0)))
    blocked = ordered_blocks(ev.join(hot, "userId", "left_semi"), order_of(ev), keys=["userId"], blocks=blocks)
    local = _local_scan(blocked)
    return [_carried(cold, None), _carried(local, written(_carry(local), "carry"))]


def _both(scans: list[DataFrame], result) -> DataFrame:
    out = result(scans[0])
    return out if len(scans) == 1 else out.unionByName(result(scans[1]))


def _carried(local: DataFrame, carry: DataFrame | None) -> DataFrame:
    """The per-(user, block) scan with the carry-in of each block."""
    if carry is None:
        return local.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("_pk_in", "int"), ("_pa_in", "string"), ("_lu_in", "struct<name:string>"),
            ("_lock_in", "int"))])
    return local.join(carry, (F.col(BLOCK) == F.col("_cblk")) & (F.col("userId") == F.col("_cu")), "left")


def _rows(j: DataFrame) -> tuple[F.Column, list[F.Column]]:
    """Whether a row emits, and the columns it emits."""
    first = F.col("_pk").isNull()
    pk = F.when(first, F.col("_pk_in")).otherwise(F.col("_pk"))
    pa = F.when(first, F.col("_pa_in")).otherwise(F.col("_pa"))
    locked_before = ((F.coalesce(F.col("_lock_in"), F.lit(0)) == 1)
                     | (F.col("_lock_before") == 1)
                     | (~first & _first_locks()))
    is_u = F.col("_rank") == USER_RANK
    user_emits = is_u & (pk == ACTION_RANK) & ~locked_before
    action_emits = ~is_u & locked_before
    return user_emits | action_emits, [
        F.col("userId"),
        F.when(is_u, F.col("name")).otherwise(_latest_user()["name"]).alias("name"),
        F.when(is_u, pa).otherwise(F.col("action")).alias("action"),
        F.col("ts"), *[F.col(c) for c in positions(j)], F.col("seq")]


def _first_locks():
    """The first row of the (user, block) group is a locking event."""
    return (F.col("_fk") == USER_RANK) & (F.col("_pk_in").isNull() | (F.col("_pk_in") == USER_RANK))


def _latest_user():
    return F.coalesce(F.col("_lu"), F.col("_lu_in"))


def _emit(j: DataFrame) -> DataFrame:
    emits, row = _rows(j)
    return j.where(emits).select(*row)


def _emit_and_hold(j: DataFrame) -> DataFrame:
    """Rows that emit, and each group's cells after its last row."""
    emits, row = _rows(j)
    locked = (F.coalesce(F.col("_lock_in"), F.lit(0)) == 1) | (F.col("_lock_upto") == 1) | _first_locks()
    waits = ~locked & (F.col("_rank") == ACTION_RANK)
    no = F.lit(False)
    out = F.struct(F.lit("out").alias("kind"), *row, no.alias("has_user"), no.alias("has_action"), F.lit(0).alias("block"))
    rest = [F.lit(None).cast(j.schema[c].dataType).alias(c) for c in ("ts", *positions(j), "seq")]
    cell = F.struct(F.lit("cell").alias("kind"), F.col("userId"), F.when(locked, _latest_user()["name"]).alias("name"),
                    F.when(waits, F.col("action")).alias("action"), *rest, locked.alias("has_user"), waits.alias("has_action"),
                    F.col(BLOCK).alias("block"))
    both = F.array_compact(F.array(F.when(emits, out), F.when(F.col("_end"), cell)))
    return j.select(F.explode(both).alias("r")).select("r.*")
