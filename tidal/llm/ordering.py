"""Positions of rows in a sorted table, group by group, without sorting a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidal.llm.common import partitions, written

#: rows of a table of runs (groups + blocks) up to which it is sent to all tasks; beyond, it is joined by a shuffle
SMALL_RUNS = 100_000


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``idx`` (0, 1, ... within ``group`` by ``order``, nulls first) and ``total`` (its rows).

    ``rows`` is a written table: range partitioning reads it twice. The range bounds cut inside a large group
    and, through a running number, inside rows that are equal in every column, so no task gets a whole group.
    A row's place is its place in its block plus the rows of the group in earlier blocks, one row per block.
    ``group`` has no nulls. Equal rows get their places in no fixed order.
    """
    spark = rows.sparkSession
    keys = [group, *order, "tie"]
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    placed = written(tied.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys).drop("tie")
                     .withColumn("place", F.monotonically_increasing_id()), "ordered")
    placed = placed.withColumn("block", F.shiftright("place", 33))
    runs = placed.groupBy(group, "block").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    runs = written(runs.select(group, "block", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
                               F.sum("n").over(Window.partitionBy(group)).alias("total")), "runs")
    if runs.count() <= SMALL_RUNS:
        runs = F.broadcast(runs)
    return placed.join(runs, [group, "block"]).withColumn("idx", F.col("place") + F.col("shift")).drop("place", "block", "shift")
