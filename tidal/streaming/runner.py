"""Start, name and drain streaming queries; file sinks live in the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidal.session import shared_dir, shuffle_partitions


def run_stream(df: DataFrame, name: str, path: str | None = None, checkpoint: str | None = None,
               fmt: str = "parquet", available_now: bool = True,
               output_mode: str = "append", state_partitions: int | None = None,
               options: dict | None = None) -> StreamingQuery:
    """Start ``df`` into a sink; ``available_now`` drains what is there and stops.

    The query is named (unique per start); sink and checkpoint default to fresh folders under
    ``spark.checkpoint.dir`` so a restart with the same ``checkpoint`` resumes where it stopped.
    ``state_partitions`` fixes the number of state partitions of a stateful query at its first
    start (default: the session's shuffle partition count).
    """
    spark = df.sparkSession
    checkpoint = checkpoint or shared_dir(spark, f"{name}-checkpoint")
    writer = (df.writeStream.queryName(f"{name}_{uuid.uuid4().hex[:8]}")
              .option("checkpointLocation", checkpoint).outputMode(output_mode).format(fmt)
              .options(**(options or {})))
    if available_now:
        writer = writer.trigger(availableNow=True)
    with shuffle_partitions(spark, state_partitions):
        if fmt in ("console", "memory", "noop"):
            return writer.start()
        return writer.start(path or shared_dir(spark, f"{name}-out"))


def run_to_table(df: DataFrame, name: str, path: str | None = None,
                 checkpoint: str | None = None, timeout: float | None = None,
                 state_partitions: int | None = None) -> DataFrame:
    """Drain a stream into a parquet folder and return that folder as a batch DataFrame."""
    spark = df.sparkSession
    path = path or shared_dir(spark, f"{name}-out")
    q = run_stream(df, name, path=path, checkpoint=checkpoint, state_partitions=state_partitions)
    q.awaitTermination(timeout)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream {name} did not drain within {timeout}s")
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(path)


def tap(df: DataFrame, name: str = "tap", rows: int | None = None, available_now: bool = False):
    """Print every record: console sink for a stream (returns the query), printed rows for a batch.

    ``rows`` limits what is printed (of each micro-batch on a stream) where the caller asks for that.
    """
    if df.isStreaming:
        return run_stream(df, name, fmt="console", available_now=available_now,
                          options={"numRows": str(rows or 2**31 - 1), "truncate": "false"})
    if rows is not None:
        df.show(rows, truncate=False)
        return None
    print(" | ".join(df.columns))
    for r in df.toLocalIterator():                # one partition at a time
        print(" | ".join("null" if v is None else str(v) for v in r))
    return None
