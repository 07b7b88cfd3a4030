"""Inner equi-join of users and actions on ``userId`` (bag semantics, batch or streaming).

n user records and m actions of one id give n*m rows, in either arrival order. Catalyst picks the
physical join: broadcast when the user side's measured size is under the broadcast threshold,
sort-merge otherwise; AQE's skew join splits a hot ``userId`` on the action side into several
tasks. On streams the same plan runs as a symmetric hash join without a watermark (both sides are
kept, as in the source: no expiry).

``hot_key_rows`` salts hot ids explicitly instead of relying on runtime statistics: ids with more
actions than that are found by a partial aggregate (at most ``rows / hot_key_rows`` of them; AQE
broadcasts that list once its measured size is under the broadcast threshold, and joins it by
sort-merge otherwise); their actions spread over ``salt`` sub-keys by a hash of the row
(deterministic, so a retried task routes rows the same way) and their user records are copied
to every sub-key. Other ids keep sub-key 0. The hash takes the row's position, not only its action.

``salt`` alone (no ``hot_key_rows``) salts every id. That needs no statistics, so it also works on
streams, where AQE does not run and a hot id would otherwise keep a whole micro-batch's share of
that id, and its join state, in one state partition. The user side is then held ``salt`` times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidal import schemas
from tidal.operators.views import ACTION_VIEW, USER_VIEW, conform
from tidal.session import default_blocks

JOIN_SQL = "SELECT l.userId, l.name, r.action FROM {users} AS l JOIN {actions} AS r ON l.userId = r.userId"


def user_action_join(users: DataFrame, actions: DataFrame, extra: tuple[str, ...] = (),
                     hot_key_rows: int | None = None, salt: int | None = None) -> DataFrame:
    """``(userId, name, action)`` for every user/action pair with the same id.

    ``extra`` names action columns to carry along (e.g. ``ts``, ``seq``). Salting takes a row's sub-key
    from the action columns besides userId and action (its position in the input), whether they are
    carried along or not, so that equal actions of one id spread as well; without any it raises.
    """
    u = users.select("userId", "name")
    a = actions.select("userId", "action", *extra)
    cond = F.col("U.userId") == F.col("A.userId")
    if hot_key_rows or salt:
        place = [c for c in actions.columns if c not in ("userId", "action")]
        if not place:
            raise ValueError("salting needs a column that tells actions apart (such as ts, seq)")
        n = salt or default_blocks(actions.sparkSession)
        a = actions.select("userId", "action", *extra,
                           F.pmod(F.xxhash64("action", *place), F.lit(n)).cast("int").alias("_salt"))
        u, a = _salted(u, a, hot_key_rows, n) if hot_key_rows else (_copied(u, n), a)
        cond = cond & (F.col("U._salt") == F.col("A._salt"))
    u, a = u.alias("U"), a.alias("A")
    return u.join(a, cond, "inner").select(
        F.col("U.userId").alias("userId"), F.col("U.name").alias("name"),
        F.col("A.action").alias("action"), *[F.col(f"A.{c}").alias(c) for c in extra])


def _copied(users: DataFrame, salt: int) -> DataFrame:
    return users.select(*users.columns, F.explode(F.sequence(F.lit(0), F.lit(salt - 1))).alias("_salt"))


def _salted(users: DataFrame, actions: DataFrame, hot_key_rows: int, salt: int):
    hot = (actions.groupBy("userId").count().where(F.col("count") > hot_key_rows)
           .select("userId", F.lit(True).alias("_hot")))
    a = actions.join(hot, "userId", "left").select(
        *[c for c in actions.columns if c != "_salt"],
        F.when(F.col("_hot"), F.col("_salt")).otherwise(F.lit(0)).alias("_salt"))
    u = users.join(hot, "userId", "left").select(
        *users.columns,
        F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salt - 1)))
                  .otherwise(F.array(F.lit(0)))).alias("_salt"))
    return u, a


def user_action_join_sql(spark: SparkSession, user_view: str = USER_VIEW,
                         action_view: str = ACTION_VIEW) -> DataFrame:
    """The same join as SQL text over two registered views, conformed to the output record."""
    return conform(spark.sql(JOIN_SQL.format(users=user_view, actions=action_view)),
                   schemas.USER_ACTION)
