"""Streaming queries whose micro-batches are written once and then handled by batch jobs.

The written rows are what every job of the step reads: sources are read and records decoded once. Records set aside
by decoding travel in the same rows (``REASON`` not null) and go to a sink of their own, so both sinks come out of one
decode. The steps run in the caller's session, as a stream's own has adaptive execution turned off.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidal.functions.codec import REASONS
from tidal.streaming.batchlog import delete

REASON, RAW = "_reason", "_raw"
Sink = Callable[[DataFrame, int], None]
#: name of the observed counts of a decoded stream (``query.lastProgress.observedMetrics``)
METRICS = "decoded"


def reason_counts() -> list[F.Column]:
    """Records, and the records set aside per reason, as aggregates for ``observe``."""
    return [F.count(F.lit(1)).alias("records")] + [F.count(F.when(F.col(REASON) == r, 1)).alias(r) for r in REASONS]


def rejects_of(rows: DataFrame) -> DataFrame:
    """topic, partition, seq, ts, reason and the raw text of the records set aside."""
    place = [c for c in ("topic", "partition", "seq", "ts") if c in rows.columns]
    return rows.where(F.col(REASON).isNotNull()).select(*place, F.col(REASON).alias("reason"), F.col(RAW).alias("value"))


def folder_sink(path: str) -> Sink:
    """``{path}/batch_id=N``, written over when a batch is retried."""
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}"))
    return write


def staged_query(df: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, name: str, available_now: bool,
                 rejects: Sink | None = None, partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Run ``step(rows, batch_id)`` on each written micro-batch of ``df``.

    With a ``REASON`` column, only decoded rows go to ``step`` (without ``REASON`` and ``RAW``), the others to ``rejects``, and
    counts per reason are observed under ``METRICS``. A step may be run again for a batch: it must write the same files over.
    """
    spark = df.sparkSession
    staged = os.path.join(checkpoint, "batches")
    decoded = REASON in df.columns
    if decoded:
        df = df.observe(METRICS, *reason_counts())

    def run(batch: DataFrame, batch_id: int) -> None:
        path = os.path.join(staged, str(batch_id))
        batch.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        rows = spark.read.schema(batch.schema).parquet(path)
        if decoded:
            if rejects is not None:
                rejects(rejects_of(rows), batch_id)
            rows = rows.where(F.col(REASON).isNull()).drop(REASON, RAW)
        step(rows, batch_id)
        if batch_id:
            delete(spark, os.path.join(staged, str(batch_id - 1)))

    writer = (df.writeStream.queryName(name).foreachBatch(run)
              .option("checkpointLocation", os.path.join(checkpoint, "query")))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
