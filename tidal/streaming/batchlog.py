"""A table that grows by micro-batches, kept on shared storage by batch id.

Every micro-batch appends one folder. So that a reader doesn't open a folder per past batch, ``every``
folders are merged into one of the next level, ``every`` of those into one of the level above, and so on: the
batches before N are covered by at most ``every`` folders per level, and a row is rewritten once per level.

Which folders exist follows from the batch id alone. A step that is run again after a failure (in the
middle of a merge too) writes the same folders over; merged folders are deleted one merge later, when no
retry can need them.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def fixed_setting(spark: SparkSession, path: str, value: int) -> int:
    """``value`` as it was when ``path`` was first written; a restart with another value keeps the first."""
    spark.createDataFrame([(value,)], "value long").coalesce(1).write.mode("ignore").parquet(path)
    return spark.read.parquet(path).first()["value"]


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of a checkpoint."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class BatchLog:
    """``merge(df, whole)`` turns the rows of several batches into the rows kept of them (``whole``: nothing came before)."""

    def __init__(self, root: str, schema: T.StructType, every: int = 8,
                 merge: Callable[[DataFrame, bool], DataFrame] | None = None):
        if every < 2:
            raise ValueError("merge two folders at least")
        self.root, self.schema, self.every = root, schema, every
        self.merge = merge or (lambda df, whole: df)

    def path(self, level: int, number: int) -> str:
        """The folder of batches ``number * every**level`` up to the next one's."""
        return os.path.join(self.root, f"level={level}", f"part={number}")

    def cover(self, batch_id: int) -> list[str]:
        """The folders that hold the batches before ``batch_id``, oldest first."""
        out, level, number = [], 0, batch_id
        while number:
            first = number - number % self.every
            out = [self.path(level, i) for i in range(first, number)] + out
            number //= self.every
            level += 1
        return out

    def _load(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        if not paths:
            return spark.createDataFrame([], self.schema)
        names = [f.name for f in self.schema.fields]
        frames = [spark.read.schema(self.schema).option("basePath", p).parquet(p).select(*names) for p in paths]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The rows kept of all batches before ``batch_id`` (merged per folder only)."""
        return self._load(spark, self.cover(batch_id))

    def _write(self, df: DataFrame, path: str) -> None:
        df.write.mode("overwrite").parquet(path)

    def append(self, df: DataFrame, batch_id: int) -> None:
        """Write the rows of ``batch_id``, then the merges that it completes."""
        spark = df.sparkSession
        self._write(df.select(*[f.name for f in self.schema.fields]), self.path(0, batch_id))
        level, number = 0, batch_id + 1
        while number % self.every == 0:
            parts = range(number - self.every, number)
            number //= self.every
            level += 1
            rows = self._load(spark, [self.path(level - 1, i) for i in parts])
            self._write(self.merge(rows, number == 1), self.path(level, number - 1))
            for i in range(parts[0] - self.every, parts[0]):
                if i >= 0:
                    delete(spark, self.path(level - 1, i))
