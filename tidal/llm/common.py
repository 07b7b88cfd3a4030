"""Shared helpers: written tables in the shared folder, word hashing of Arrow text columns."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidal.session import ship_package, shared_dir

CHUNK_BYTES = 1 << 19           # text bytes a numpy step looks at together (a longer text alone)
BATCH_ROWS = 1000               # most rows of an Arrow batch
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
U64 = np.uint64


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as parquet in the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor rereads the files, nothing is computed twice.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    with arrow_rows(spark, BATCH_ROWS):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def python_ready(spark: SparkSession) -> None:
    """Ship this package to the Python workers, and hold the session's Arrow batches to ``BATCH_ROWS`` rows.

    Rows carry whole texts here, and a batch is held by the JVM and by Python at once. Frames are often run by the
    caller, after the operator has returned them, so the setting stays with the session."""
    ship_package(spark)
    rows = int(spark.conf.get(_ARROW_ROWS))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set(_ARROW_ROWS, str(BATCH_ROWS))


def _trim() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):         # another C library
        ctypes.CDLL(None).malloc_trim(0)


def release_memory() -> None:
    """Give memory freed by a training run back to the system (the driver goes on to plan long jobs)."""
    gc.collect()
    _trim()


def tidy(run):
    """``run`` (a function of Arrow batches) that gives freed memory back when its task ends: Spark keeps the Python
    workers of a stage for later ones, and several stages' idle workers would add up."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            _trim()
    return wrapped


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def long_id(df: DataFrame, name: str) -> Column:
    """An id column as bigint (null stays null)."""
    return F.col(name).cast("bigint").alias(name)


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, n: int):
    """Arrow batches of at most ``n`` rows for the plans run inside (wide rows of several texts)."""
    old = spark.conf.get(_ARROW_ROWS)
    spark.conf.set(_ARROW_ROWS, str(min(n, int(old)) if int(old) > 0 else n))
    try:
        yield
    finally:
        spark.conf.set(_ARROW_ROWS, old)


def spare_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores added to those that ``df`` has already."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


# --- bitmaps of 64-bit values, to thin out rows before a shuffle ------------------------------

MOST_BITS = 27                  # 16 MB; a fuller bitmap only lets more rows through
BITS_PER_VALUE = 16


def bitmap_place(values: np.ndarray, bits: int) -> np.ndarray:
    return (mix(values.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _bitmap_of_batches(bits: int):
    def run(batches):
        packed = np.zeros(1 << (bits - 3), np.uint8)
        for batch in batches:
            place = np.unique(bitmap_place(np.ascontiguousarray(batch.column(0).to_numpy()), bits))
            np.bitwise_or.at(packed, place >> 3, (128 >> (place & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([packed.tobytes()], pa.binary())], names=["bits"])
    return run


def bitmap(values: DataFrame) -> bytes:
    """A bitmap of one bigint column without nulls: ``BITS_PER_VALUE`` bits for each, 8 KB to 16 MB in all. ``values``
    is read twice."""
    bits = min(MOST_BITS, max(16, int(values.count() * BITS_PER_VALUE).bit_length()))
    total = np.zeros(1 << (bits - 3), np.uint8)
    for row in values.repartition(4).mapInArrow(tidy(_bitmap_of_batches(bits)), "bits binary").collect():
        total |= np.frombuffer(row["bits"], np.uint8)
    return total.tobytes()


def in_bitmap(packed: bytes, values: np.ndarray) -> np.ndarray:
    place = bitmap_place(np.ascontiguousarray(values), (len(packed) * 8).bit_length() - 1)
    return (np.frombuffer(packed, np.uint8)[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1


def filtered(docs: DataFrame, keep) -> DataFrame:
    """The rows of ``docs`` for which ``keep`` (text column -> boolean array, run in Arrow batches) holds."""
    python_ready(docs.sparkSession)
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    text = "text"
    if docs.schema[text].dataType.simpleString() != "string":
        text, = spare_names(docs, "_text")
        docs = docs.withColumn(text, F.col("text").cast("string"))

    def run(batches):
        for batch in batches:
            kept = batch.filter(pa.array(keep(batch.column(text)), pa.bool_()))
            yield kept if text == "text" else kept.drop_columns([text])
    return docs.mapInArrow(tidy(run), kind)


def _flags(shared, key: str, flag: str):
    def run(batches):
        for batch in batches:
            ids = batch.column(key)
            found = np.zeros(len(ids), bool)
            valid = ids.is_valid().to_numpy(zero_copy_only=False)
            found[valid] = in_bitmap(shared.value, ids.drop_null().to_numpy())
            rest = batch.drop_columns([key])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(found)], names=[*rest.schema.names, flag])
    return run


def split_by_ids(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose doc_id isn't among ``ids``, the rows that may be): a bitmap of the ids tells most rows
    apart where they are, so that only the second part has to be joined (and shuffled)."""
    spark = docs.sparkSession
    python_ready(spark)
    key, flag = spare_names(docs, "_id", "_flag")
    shared = spark.sparkContext.broadcast(bitmap(ids))
    rows = docs.withColumn(key, F.col("doc_id").cast("bigint"))
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    flagged = rows.mapInArrow(tidy(_flags(shared, key, flag)), f"{kind}, `{flag}` boolean")
    return flagged.where(~F.col(flag)).drop(flag), flagged.where(F.col(flag)).drop(flag)


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id isn't in ``ids`` (one bigint column without nulls)."""
    drop, = spare_names(docs, "_drop")
    ids = ids.toDF(drop)
    surely, perhaps = split_by_ids(docs, ids)
    return surely.unionByName(perhaps.join(ids, F.col("doc_id").cast("bigint") == F.col(drop), "left_anti"))


# --- text columns as numpy ----------------------------------------------------------------

def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows of a string column: (first row, bytes, row offsets into them). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240131).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_ROOT = 0x9E3779B97F4A7C15 | 1
_ROOT_INVERSE = pow(_ROOT, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        size = max(n + 1, 1 << 16)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if size <= 4 * CHUNK_BYTES:
            _powers[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: everything in ASCII but letters and digits
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def word_spans(data: np.ndarray, offsets: np.ndarray,
               between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each run of bytes other than ``between`` (white space); runs end with their row."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~between[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | edge[1:n]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | edge[1:n]
    starts = np.flatnonzero(begins)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, np.flatnonzero(ends) + 1, rows


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, from running sums of a polynomial over the bytes."""
    n = len(data)
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(_ROOT, n)[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(_ROOT_INVERSE, n)[starts])


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all other bytes as they are."""
    return _LOWER[data]


def word_hashes(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every lower-cased word, in order."""
    low = lower_ascii(data)
    starts, ends, rows = word_spans(low, offsets, between)
    return span_hashes(low, starts, ends), rows


_PLACES = mix(np.arange(1, 65, dtype=np.uint64) * U64(0xD6E8FEB86659FD93)) | U64(1)


def shingle_hashes(words: np.ndarray, rows: np.ndarray, n_rows: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of ``width`` words; a row with fewer words has its whole sequence."""
    counts = np.bincount(rows, minlength=n_rows)
    sums = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for j in range(width if len(sums) else 0):
        sums += words[j:j + len(sums)] * _PLACES[j]
    whole = rows[:len(sums)] == rows[width - 1:] if len(sums) else np.zeros(0, bool)
    hashes, where = mix(sums[whole]), rows[:len(sums)][whole]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        first = np.cumsum(counts) - counts
        extra = np.array([int((words[first[r]:first[r] + counts[r]] * _PLACES[:counts[r]]).sum(dtype=np.uint64))
                          ^ int(counts[r]) for r in short], np.uint64)
        hashes = np.concatenate([hashes, mix(extra ^ U64(0x5851F42D4C957F2D))])
        where = np.concatenate([where, short])
        order = np.argsort(where, kind="stable")
        hashes, where = hashes[order], where[order]
    return hashes, where


def distinct_by_row(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each row (``rows`` ascending)."""
    cuts = np.searchsorted(rows, np.arange(n_rows + 1))
    return [np.unique(hashes[cuts[r]:cuts[r + 1]]) for r in range(n_rows)]


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) for every row of a text column."""
    for first, data, offsets in text_chunks(column):
        words, rows = word_hashes(data, offsets)
        n = len(offsets) - 1
        for r, found in enumerate(distinct_by_row(*shingle_hashes(words, rows, n, width), n)):
            yield first + r, found
