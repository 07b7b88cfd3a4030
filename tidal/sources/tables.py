"""Adapters from the parquet test tables to tidal's records.

``customer`` supplies users (``c_custkey`` as userId, ``c_name`` as name). ``events`` supplies
actions (``user_id`` as userId, ``event_type`` as action, ``event_id`` as actionId and as the
tie-breaking sequence). For the pairing, ``signup`` events act as user records, so users and
actions interleave per id; the signup's ``props`` text stands in for the user's name, so that
which user record was paired stays visible in the output.

Ids are text in the record type. With ``text_ids=False`` they keep the table's integer type:
joins, range partitioning and windows then work on 8-byte keys, and null checks on the key reach
the parquet scan; ``as_text_ids`` casts them in the final projection (the cast is injective, so
equality and grouping are unchanged).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIGNUP = "signup"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(col: str, text: bool):
    return F.col(col).cast("string") if text else F.col(col)


def as_text_ids(df: DataFrame, *cols: str) -> DataFrame:
    """Cast id columns to text (the record type) in place."""
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def users_from_customer(customer: DataFrame, text_ids: bool = True) -> DataFrame:
    return customer.select(_id("c_custkey", text_ids).alias("userId"),
                           F.col("c_name").alias("name"))


def actions_from_events(events: DataFrame, ordered: bool = False, text_ids: bool = True) -> DataFrame:
    cols = [_id("user_id", text_ids).alias("userId"), F.col("event_type").alias("action")]
    if ordered:
        cols += [F.col("ts"), F.col("event_id").alias("seq")]
    return events.select(*cols)


def action_records_from_events(events: DataFrame) -> DataFrame:
    """Three-field actions with order columns: ``actionId, userId, action, ts, seq``."""
    return events.select(F.col("event_id").cast("string").alias("actionId"),
                         F.col("user_id").cast("string").alias("userId"),
                         F.col("event_type").alias("action"),
                         F.col("ts"), F.col("event_id").alias("seq"))


def pairing_inputs(events: DataFrame, text_ids: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(users, actions)`` for the pairing: signups are user records, the rest actions."""
    is_signup = F.col("event_type") == SIGNUP
    users = events.where(is_signup).select(
        _id("user_id", text_ids).alias("userId"), F.col("props").alias("name"),
        F.col("ts"), F.col("event_id").alias("seq"))
    actions = events.where(~is_signup).select(
        _id("user_id", text_ids).alias("userId"), F.col("event_type").alias("action"),
        F.col("ts"), F.col("event_id").alias("seq"))
    return users, actions


def pairing_events(events: DataFrame, text_ids: bool = True) -> DataFrame:
    """The pairing's tagged sequence in one scan of ``events`` (see ``pairing.TAGGED_COLUMNS``)."""
    is_signup = F.col("event_type") == SIGNUP
    return events.select(
        _id("user_id", text_ids).alias("userId"),
        F.when(is_signup, F.lit(0)).otherwise(F.lit(1)).alias("_rank"),
        F.col("ts"), F.col("event_id").alias("seq"),
        F.when(is_signup, F.col("props")).alias("name"),
        F.when(~is_signup, F.col("event_type")).alias("action"))
