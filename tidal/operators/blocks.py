"""Ordered blocks: split a sorted sequence into contiguous runs of bounded size.

Order-dependent operators (the pairing, the latest-rule filter) scan each key's events in order.
A window partitioned by the key alone would put a hot key -- possibly a third of all rows -- into
one task. Instead the rows are range-partitioned on ``(keys..., order...)``: the sampled range
bounds cut inside a hot key, so every block holds about ``rows / blocks`` rows and a key may span
many blocks. Block ids increase with the sort order, so the per-block results can be stitched
together by a scan over the (tiny) table of block summaries, one row per block.

The block assignment comes from sampled bounds, which differ between two executions of one plan. The
tagged rows are therefore written once to the shared checkpoint folder, with their block ids, before
they feed the scan and the summaries: every reader sees the same blocks, no cache is involved, and a
lost executor rereads the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidal.session import written

BLOCK = "_blk"

# A block is windowed by one task and adds one row to the carry table, so blocks are sized by rows.
ROWS_PER_BLOCK = 5_000_000


def blocks_for(rows: int) -> int:
    """Blocks for ``rows`` rows: about ``ROWS_PER_BLOCK`` each."""
    return max(1, -(-rows // ROWS_PER_BLOCK))


def ordered_blocks(df: DataFrame, order: list[str], keys: list[str] | tuple = (),
                   blocks: int | None = None) -> DataFrame:
    """``df`` range-partitioned on ``keys + order``, each row with its block id; written and read back.

    ``blocks`` defaults to one per ``ROWS_PER_BLOCK`` rows."""
    n = blocks or blocks_for(df.count())
    tagged = df.repartitionByRange(n, *keys, *order).withColumn(BLOCK, F.spark_partition_id())
    return written(tagged, "blocks")
