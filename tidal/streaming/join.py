"""The user/action join on streams as a delta join (JVM only).

A micro-batch's new users meet all actions so far, and its new actions the users before it; nothing expires. Both
histories are tables by batch id (``tidal.streaming.batchlog``), sorted by a hash of the id, so that only the row groups
that may hold an id of the batch are read. Each micro-batch runs the batch join, where adaptive execution splits a hot
id's rows over tasks; no record is copied per sub-key.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidal.operators.join import user_action_join
from tidal.session import shared_dir
from tidal.streaming.batchlog import BatchLog, fixed_setting
from tidal.streaming.staged import RAW, REASON, Sink, folder_sink, staged_query

SIDE, BUCKET = "side", "bucket"


def _by_bucket(df: DataFrame) -> DataFrame:
    """Rows of a bucket together, in as many files as their size asks for (adaptive execution splits a large bucket)."""
    return df.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET)


def user_action_join_microbatch(users: DataFrame, actions: DataFrame, path: str | None = None, extra: tuple[str, ...] = (),
                                checkpoint: str | None = None, name: str = "user_action_join", available_now: bool = True,
                                every: int = 8, buckets: int = 256, sink: Sink | None = None,
                                rejects: Sink | None = None) -> StreamingQuery:
    """Streaming ``user_action_join``: every pair of a user and an action of one id comes out once, in the later one's batch.

    ``extra`` names action columns to carry along. Output goes to ``{path}/batch_id=N``, written over when a batch is
    retried, or to ``sink(rows, batch_id)``, which may see a batch twice. ``every`` (folders merged into one) and ``buckets``
    (hashes of ids) stay as first started. Rows without an id join nothing and are ignored. ``rejects`` takes records
    that decoding set aside (see ``staged_query``; both sides must have been decoded).
    """
    spark = actions.sparkSession
    checkpoint = checkpoint or shared_dir(spark, f"{name}-checkpoint")
    if path is None and sink is None:
        raise ValueError("give a path or a sink")
    every = fixed_setting(spark, os.path.join(checkpoint, "every"), every)
    buckets = fixed_setting(spark, os.path.join(checkpoint, "buckets"), buckets)
    bucket = F.pmod(F.xxhash64("userId"), F.lit(buckets)).cast("int").alias(BUCKET)
    kinds = {c: actions.schema[c].dataType for c in extra}
    null = F.lit(None).cast("string")
    aside = [c for c in (REASON, RAW) if c in users.columns and c in actions.columns]
    # the place of a record is needed for those set aside only
    place = [c for c in ("topic", "partition", "seq", "ts") if aside and c not in extra and c in actions.columns]
    given = [F.col(c) if aside and c in users.columns else F.lit(None).cast(t).alias(c) for c, t in kinds.items()]
    tagged = users.select(F.lit("u").alias(SIDE), "userId", "name", null.alias("action"), *given, *place, bucket, *aside).unionByName(
        actions.select(F.lit("a").alias(SIDE), "userId", null.alias("name"), "action", *extra, *place, bucket, *aside))

    def log(which: str, columns: list[str]) -> BatchLog:
        schema = T.StructType([tagged.schema[c] for c in (*columns, BUCKET)])
        return BatchLog(os.path.join(checkpoint, which), schema, every,
                        merge=lambda df, whole: _by_bucket(df))
    user_log, action_log = log("users", ["userId", "name"]), log("actions", ["userId", "action", *extra])
    deliver = sink or folder_sink(path)

    def step(rows: DataFrame, batch_id: int) -> None:
        now = rows.where("userId is not null")
        new_users, new_actions = now.where(F.col(SIDE) == "u"), now.where(F.col(SIDE) == "a")

        def before(history: BatchLog, new: DataFrame) -> DataFrame:
            mine = [r[0] for r in new.select(BUCKET).distinct().collect()]      # at most ``buckets`` numbers
            return history.before(spark, batch_id).where(F.col(BUCKET).isin(mine))
        old_actions, old_users = before(action_log, new_users), before(user_log, new_actions)
        columns = ["userId", "action", *extra]
        out = user_action_join(new_users, old_actions.select(*columns).unionByName(new_actions.select(*columns)), extra).unionByName(
            user_action_join(old_users, new_actions, extra))
        deliver(out, batch_id)
        user_log.append(_by_bucket(new_users), batch_id)
        action_log.append(_by_bucket(new_actions), batch_id)
    return staged_query(tagged, step, checkpoint, name, available_now, rejects, partition_by=(SIDE,))
