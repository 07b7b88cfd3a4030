"""Record schemas. Fixed, never inferred; every field nullable, as in the source records."""

from pyspark.sql import types as T

STR = T.StringType()

USER = T.StructType([T.StructField("userId", STR), T.StructField("name", STR)])

# two-field action used by the pairing and the SQL join
ACTION = T.StructType([T.StructField("userId", STR), T.StructField("action", STR)])

USER_ACTION = T.StructType([
    T.StructField("userId", STR), T.StructField("name", STR), T.StructField("action", STR)])

# three-field action used by the rule filter (input and output)
ACTION_RECORD = T.StructType([
    T.StructField("actionId", STR), T.StructField("userId", STR), T.StructField("action", STR)])

RULE = T.StructType([
    T.StructField("ruleId", STR), T.StructField("allowedActions", T.ArrayType(STR))])

# Order columns carried by order-dependent operators: event time and a tie-breaking sequence.
ORDER_FIELDS = [T.StructField("ts", T.TimestampNTZType()), T.StructField("seq", T.LongType())]


def with_order(schema: T.StructType) -> T.StructType:
    """The record schema plus the ``ts``/``seq`` order columns."""
    return T.StructType(list(schema.fields) + ORDER_FIELDS)
