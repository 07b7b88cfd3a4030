"""Keyed pairing on streams.

The state machine is the one documented in ``tidal.operators.pairing``: two value states per user
id (remembered user, waiting action). Across micro-batches, processing order rules; within one, records
are taken in ``(ts, user before action, topic, partition, seq)`` order.

``pair_microbatch`` (JVM only, the form for large streams): the cells are a table of versions by batch id
(``tidal.streaming.batchlog``). A micro-batch joins its users' latest cells, puts them in front as events of their
own, and runs the batch operator over the lot: windows per user, and ordered blocks for a user with too many
rows for one task. The cells after the batch are appended to the table. A retried batch writes the same files.

``pair_tagged_stream`` (a streaming DataFrame, to be composed): ``groupBy(shard).transformWithStateInPandas``, where a shard
is the users of one hash value and its state maps a user id to what that user's cells hold. A shard's rows of a micro-batch
arrive as pandas frames; the state carried in becomes a virtual first event of each user, and the closed form of the batch
operator is evaluated with numpy for all users of the shard at once: a call, its frames and its Arrow batch cost some
milliseconds, too much for each user with a few rows. PySpark builds those frames row by row in Python and one task handles
a shard's micro-batch: bound the batches with ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidal.operators.pairing import (ACTION_RANK, HELD, USER_RANK, _tagged, held_events, pair_and_hold,
                                     positions)
from tidal.session import ensure_state_store, shared_dir, ship_package
from tidal.streaming.batchlog import BatchLog, delete, fixed_setting
from tidal.streaming.staged import Sink, folder_sink, staged_query

NO_KIND = -1


# The pandas path gets plain column names (names with a leading underscore do not survive the
# Arrow hand-over intact), so the kind rank travels as ``kind``.
KIND = "kind"

#: the users of a stream are dealt to so many shards by a hash of their id. A checkpoint depends on it: keep the number.
SHARDS, SHARD = 1024, "shard"


def _sort_key(col: pd.Series) -> np.ndarray:
    """int64 sort key with missing values first (of texts: their rank by UTF-8 bytes)."""
    if col.dtype == object:
        known = sorted({v for v in col if v is not None}, key=lambda v: v.encode())
        rank = {v: i for i, v in enumerate(known)}
        return np.array([rank.get(v, -1) for v in col], np.int64)
    if pd.api.types.is_datetime64_any_dtype(col):
        return col.to_numpy(dtype="datetime64[ns]").view(np.int64)   # NaT is the least int64
    if col.isna().any():
        return col.fillna(np.iinfo(np.int64).min).to_numpy(dtype=np.int64)
    return col.to_numpy(dtype=np.int64)


def _joined(frames: list[pd.DataFrame]) -> pd.DataFrame:
    """The frames as one. Whole numbers that only some frames have as floats (for a missing value) stay whole numbers."""
    for c in ("partition", "seq"):
        if c in frames[0].columns and len({f[c].dtype for f in frames}) > 1:
            frames = [f.astype({c: "Int64"}) for f in frames]
    return pd.concat(frames, ignore_index=True)


def arrival_sorted(frames) -> pd.DataFrame:
    """A micro-batch's rows user by user, each in arrival order (missing times first, as in batch)."""
    frames = list(frames)
    batch = frames[0] if len(frames) == 1 else _joined(frames)
    if len(batch) > 1:
        place = [c for c in ("partition", "topic") if c in batch.columns]
        user = [pd.factorize(batch["userId"])[0]] if "userId" in batch.columns else []
        order = np.lexsort((_sort_key(batch["seq"]), *[_sort_key(batch[c]) for c in place],
                            _sort_key(batch[KIND]), _sort_key(batch["ts"]), *user))
        if (np.diff(order) < 0).any():
            return batch.take(order).reset_index(drop=True)
    return batch.reset_index(drop=True)


def pair_users(b: pd.DataFrame, starts: np.ndarray, cells: list[tuple | None]):
    """Apply sorted rows to the cells of their users, whose rows begin at ``starts``.

    A user's cell is the ``(kind, value)`` of the record held, or None. Returns ``(emitted rows, cells)`` with the
    cells after the batch.
    """
    n = len(b)
    kind = b[KIND].to_numpy(dtype=np.int64)
    names = b["name"].to_numpy(dtype=object)
    acts = b["action"].to_numpy(dtype=object)
    is_u = kind == USER_RANK
    of = np.zeros(n, np.int64)                       # the number of each row's user
    of[starts[1:]] = 1
    of = np.cumsum(of)
    held_kind = np.array([NO_KIND if c is None else c[0] for c in cells], np.int64)
    held = np.empty(len(cells), dtype=object)
    held[:] = [None if c is None else c[1] for c in cells]
    # the cell carried in, as the kind/action of a virtual event before a user's first row
    pk = np.empty(n, np.int64)
    pk[1:] = kind[:-1]
    pk[starts] = held_kind
    pa = np.empty(n, dtype=object)
    pa[1:] = acts[:-1]
    pa[starts] = held
    locking = is_u & ((pk == NO_KIND) | (pk == USER_RANK))
    so_far = np.cumsum(locking)
    earlier = (so_far - locking)[starts]             # locking events of the users before
    held_user = held_kind == USER_RANK
    locked_before = held_user[of] | (so_far - locking > earlier[of])
    latest_u = np.maximum.accumulate(np.where(is_u, np.arange(n), -1))
    own = latest_u >= starts[of]
    user_name = np.where(own, names[np.maximum(latest_u, 0)], held[of])

    emit = (is_u & (pk == ACTION_RANK) & ~locked_before) | (~is_u & locked_before)
    out = pd.DataFrame()
    if emit.any():
        out = pd.DataFrame({
            **{c: b[c].array[emit] for c in ("userId",) if c in b.columns},
            "name": np.where(is_u, names, user_name)[emit],
            "action": np.where(is_u, pa, acts)[emit],
            **{c: b[c].array[emit] for c in ("ts", "topic", "partition", "seq") if c in b.columns},
        })
    # the cells after the batch
    ends = np.append(starts[1:], n) - 1
    locked = held_user | (so_far[ends] > earlier)
    after = [(USER_RANK, user_name[e]) if lock else (ACTION_RANK, acts[e]) if kind[e] == ACTION_RANK else None
             for e, lock in zip(ends, locked, strict=True)]
    return out, after


def pair_batch(b: pd.DataFrame, user: tuple | None, waiting: tuple | None):
    """Apply one user's sorted rows to the state ``(user, waiting)``.

    Returns ``(emitted rows, user, waiting)`` with the state after the batch.
    """
    if not len(b):
        return pd.DataFrame(), user, waiting
    cell = (USER_RANK, *user) if user is not None else (ACTION_RANK, *waiting) if waiting is not None else None
    out, [cell] = pair_users(b, np.zeros(1, np.int64), [cell])
    held = {} if cell is None else {cell[0]: cell[1:]}
    return out, held.get(USER_RANK), held.get(ACTION_RANK)


class PairingProcessor(StatefulProcessor):
    """Per shard, the cells of its users: the last user record (kept once held) or the waiting action."""

    def __init__(self, id_type: str = "string"):
        self.id_type = id_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cells = handle.getMapState("cells", f"userId {self.id_type}", "kind int, value string")

    def handleInputRows(self, key, rows, timerValues):
        batch = arrival_sorted(rows)
        ids = batch["userId"].to_numpy()
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        users = [(u,) for u in ids[starts]]
        # every state call is a round trip to the state store: read once, write on change only. Spark logs a warning for
        # every value that it reads in vain.
        cells = [tuple(self.cells.getValue(u)) if self.cells.containsKey(u) else None for u in users]
        out, after = pair_users(batch, starts, cells)
        for u, was, now in zip(users, cells, after, strict=True):
            if now is None and was is not None:
                self.cells.removeKey(u)
            elif now != was:
                self.cells.updateValue(u, now)
        if len(out):
            yield out

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for row in initialState.itertuples():
            if row.has_user or row.has_action:
                kind, value = (USER_RANK, row.name) if row.has_user else (ACTION_RANK, row.action)
                self.cells.updateValue((row.userId,), (kind, None if pd.isna(value) else value))

    def close(self) -> None:
        pass


def pair_user_action_stream(users: DataFrame, actions: DataFrame, initial: DataFrame | None = None) -> DataFrame:
    """Streaming pairing; same inputs and output columns as the batch ``pair_user_action``."""
    return pair_tagged_stream(_tagged(users, actions), initial)


def pair_tagged_stream(ev: DataFrame, initial: DataFrame | None = None) -> DataFrame:
    """Streaming pairing over an already tagged sequence (``TAGGED_COLUMNS``).

    ``initial``: the cells to start from (``held_cells`` of another query's checkpoint). A stateful query keeps its number of
    state partitions for life; to change it, stop the query, read its cells and start a new one over the records that
    the old one hasn't read, with other ``state_partitions``.
    """
    ship_package(ev.sparkSession)
    ensure_state_store(ev.sparkSession)
    shard = F.pmod(F.xxhash64("userId"), F.lit(SHARDS)).cast("int")
    ev = ev.where(F.col("userId").isNotNull()).withColumnRenamed("_rank", KIND).withColumn(SHARD, shard)
    state = None if initial is None else initial.select(
        "userId", "name", "action", "has_user", "has_action", shard.alias(SHARD)).groupBy(SHARD)
    return ev.groupBy(SHARD).transformWithStateInPandas(
        PairingProcessor(ev.schema["userId"].dataType.simpleString()), output_schema(ev), "Append", "None", initialState=state)


def held_cells(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The non-empty cells of a keyed-state pairing, read from its checkpoint: userId, name, action, has_user, has_action.

    ``batch_id``: as of the end of that micro-batch (default: the last one). ``name`` and ``action`` may be null though held.
    """
    reader = spark.read.format("statestore").option("stateVarName", "cells")
    if batch_id is not None:
        reader = reader.option("batchId", str(batch_id))
    kind, value = F.col("user_map_value.kind"), F.col("user_map_value.value")
    has_user, has_action = kind == USER_RANK, kind == ACTION_RANK
    return reader.load(checkpoint).select(
        F.col("user_map_key.userId").alias("userId"), F.when(has_user, value).alias("name"),
        F.when(has_action, value).alias("action"), has_user.alias("has_user"), has_action.alias("has_action"))


def logged_cells(spark: SparkSession, checkpoint: str, batches: int) -> DataFrame:
    """The same of a ``pair_microbatch`` checkpoint after ``batches`` micro-batches."""
    every = spark.read.parquet(os.path.join(checkpoint, "every")).first()["value"]
    return _latest(cells_log(checkpoint, every).before(spark, batches), whole=True).drop("batch", "block")


def output_schema(ev: DataFrame) -> T.StructType:
    names = ["userId", "name", "action", "ts", *positions(ev), "seq"]
    return T.StructType([T.StructField(n, ev.schema[n].dataType) for n in names])


# -- the same pairing without Python state: the batch operator on each micro-batch ---------------

CELLS = T.StructType([T.StructField("userId", T.StringType()), T.StructField("name", T.StringType()),
                      T.StructField("action", T.StringType()), T.StructField("has_user", T.BooleanType()),
                      T.StructField("has_action", T.BooleanType()), T.StructField("batch", T.LongType()),
                      T.StructField("block", T.IntegerType())])


def _latest(cells: DataFrame, whole: bool = False) -> DataFrame:
    """Each user's last cells; emptied ones are dropped where nothing older is left that they would hide."""
    last = cells.groupBy("userId").agg(F.max_by(F.struct("name", "action", "has_user", "has_action", "batch", "block"),
                                                F.struct("batch", "block")).alias("c")).select("userId", "c.*")
    return last.where(F.col("has_user") | F.col("has_action")) if whole else last


def cells_log(checkpoint: str, every: int) -> BatchLog:
    return BatchLog(os.path.join(checkpoint, "cells"), CELLS, every, merge=_latest)


def pair_microbatch(ev: DataFrame, path: str | None = None, checkpoint: str | None = None, name: str = "pair_user_action",
                    available_now: bool = True, every: int = 8, blocks: int | None = None, hot_key_rows: int | None = None,
                    sink: Sink | None = None, rejects: Sink | None = None) -> StreamingQuery:
    """Streaming pairing on the JVM over a tagged sequence (``TAGGED_COLUMNS``, ids as text).

    Output goes to ``{path}/batch_id=N``, written over when a batch is retried, or to ``sink(rows, batch_id)``, which may see
    a batch twice. ``every``: folders of cells merged into one (kept as first started). ``blocks`` and
    ``hot_key_rows`` are those of the batch operator. Rows without a user id are ignored. ``rejects`` takes records that
    decoding set aside (see ``staged_query``).
    """
    spark = ev.sparkSession
    checkpoint = checkpoint or shared_dir(spark, f"{name}-checkpoint")
    every = fixed_setting(spark, os.path.join(checkpoint, "every"), every)
    log = cells_log(checkpoint, every)
    results = os.path.join(checkpoint, "results")
    if path is None and sink is None:
        raise ValueError("give a path or a sink")
    deliver = sink or folder_sink(path)

    def step(rows: DataFrame, batch_id: int) -> None:
        result = os.path.join(results, str(batch_id))
        now = rows.where(F.col("userId").isNotNull()).withColumn(HELD, F.lit(1))
        mine = now.select("userId").distinct()
        before = _latest(log.before(spark, batch_id).join(mine, "userId", "left_semi"))
        both = pair_and_hold(now.unionByName(held_events(before, now)), blocks, hot_key_rows)
        both.write.mode("overwrite").partitionBy("kind").parquet(result)
        done = spark.read.schema(both.schema).parquet(result)
        log.append(done.where("kind = 'cell'").select("userId", "name", "action", "has_user", "has_action",
                                                      F.lit(batch_id).cast("long").alias("batch"), "block"), batch_id)
        deliver(done.where("kind = 'out'").select("userId", "name", "action", "ts", *positions(now), "seq"), batch_id)
        if batch_id:
            delete(spark, os.path.join(results, str(batch_id - 1)))
    return staged_query(ev, step, checkpoint, name, available_now, rejects)
