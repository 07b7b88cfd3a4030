"""Topics in and out: Kafka, or folders of files with the same row layout.

``fmt="kafka"`` uses Spark's Kafka source and sink (the connector must be on the classpath).
Any file format (``parquet``, ``json``) treats ``{root}/{topic}`` as the topic: a folder of
``key, value`` rows, read as a stream by the file source or written by the file sink. The option
maps are built by pure functions so they can be checked without a broker.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidal.functions.codec import decode_json, decode_json_report, to_topic_rows
from tidal.session import shuffle_partitions

# A file-backed topic holds the record text plus its arrival time and position, which the Kafka
# source provides as ``timestamp``, ``partition`` and ``offset``.
FILE_TOPIC_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("value", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()), T.StructField("partition", T.IntegerType()),
    T.StructField("seq", T.LongType())])
#: where a record stands: its time, then its place among records of that time
PLACE = ("ts", "topic", "partition", "seq")


def utc_ntz(ts, dtype: T.DataType | None = None):
    """An instant as zone-free UTC time, whatever the session's zone (a zone-free time stays as it is)."""
    if isinstance(dtype, T.TimestampNTZType):
        return ts
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts.cast("timestamp")),
                           F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def _order_columns(df: DataFrame) -> tuple[str, ...]:
    """The time and position columns of a file topic that ``df`` has."""
    return tuple(c for c in ("ts", "partition", "seq") if c in df.columns)


def kafka_source_options(servers: str, topic: str, bounded: bool = False,
                         read_committed: bool = False, **extra: str) -> dict[str, str]:
    """Options of a Kafka read from the earliest offset.

    ``bounded`` reads to the latest offsets and stops (batch); ``read_committed`` skips records of
    aborted transactions.
    """
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if bounded:
        opts["endingOffsets"] = "latest"
    if read_committed:
        opts["kafka.isolation.level"] = "read_committed"
    opts.update(extra)
    return opts


def kafka_sink_options(servers: str, topic: str, **extra: str) -> dict[str, str]:
    """Options of a Kafka write (at-least-once, as the sink delivers)."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, **extra}


def topic_path(root: str, topic: str) -> str:
    return os.path.join(root, topic)


def read_topic(spark: SparkSession, topic: str, servers: str | None = None,
               decode: str = "binary", fmt: str = "kafka", root: str | None = None,
               streaming: bool = False, max_per_trigger: int | None = None,
               read_committed: bool = False, options: dict | None = None) -> DataFrame:
    """Read a whole topic from the earliest record: ``key, value, ts, topic, partition, seq``.

    Batch reads stop at the current end offsets; ``decode="string"`` turns key and value into
    UTF-8 text, ``"binary"`` keeps the bytes. ``ts``/``seq`` are the record's time and offset in its partition
    (null in a file topic written without partitions).
    ``max_per_trigger`` bounds a stream's micro-batch (records for Kafka, files for a folder), and
    with it the rows one key's state step handles at once. ``read_committed`` skips records of aborted
    transactions. ``options`` are passed on to the source (group id, security settings and so on).
    """
    options = options or {}
    if fmt == "kafka":
        reader = spark.readStream if streaming else spark.read
        opts = kafka_source_options(servers, topic, bounded=not streaming, read_committed=read_committed, **options)
        if streaming and max_per_trigger:
            opts["maxOffsetsPerTrigger"] = str(max_per_trigger)
        df = reader.format("kafka").options(**opts).load().select(
            "key", "value", utc_ntz(F.col("timestamp")).alias("ts"), "topic", "partition",
            F.col("offset").alias("seq"))
    else:
        reader = spark.readStream if streaming else spark.read
        if streaming and max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
        # batches written by a stream stand in folders of their own
        df = reader.options(recursiveFileLookup="true", **options).format(fmt).schema(FILE_TOPIC_SCHEMA).load(
            topic_path(root, topic)).select("key", "value", "ts", F.lit(topic).alias("topic"), "partition", "seq")
    kind = "string" if decode == "string" else "binary"
    return df.withColumn("key", F.col("key").cast(kind)).withColumn("value", F.col("value").cast(kind))


def write_topic(df: DataFrame, topic: str, servers: str | None = None, fmt: str = "kafka",
                root: str | None = None, options: dict | None = None) -> None:
    """Append ``key, value`` rows to a topic (batch).

    File topics also store ``ts``, ``partition`` and ``seq`` when ``df`` has them (a broker assigns them itself).
    """
    if fmt == "kafka":
        df.select(F.col("key").cast("string"), F.col("value").cast("string")).write.format("kafka").options(
            **kafka_sink_options(servers, topic, **(options or {}))).save()
        return
    _file_rows(df).write.mode("append").format(fmt).options(**(options or {})).save(topic_path(root, topic))


def _file_rows(df: DataFrame) -> DataFrame:
    """``df`` in the layout of a file topic; a record without a time or position gets one."""
    has = set(df.columns)
    return df.select(
        F.col("key").cast("string"), F.col("value").cast("string"),
        utc_ntz(F.col("ts"), df.schema["ts"].dataType).alias("ts") if "ts" in has else utc_ntz(F.current_timestamp()).alias("ts"),
        (F.col("partition") if "partition" in has else F.lit(None)).cast("int").alias("partition"),
        (F.col("seq").cast("long") if "seq" in has else F.monotonically_increasing_id()).alias("seq"))


def batch_sink(topic: str, run: str, servers: str | None = None, fmt: str = "kafka", root: str | None = None,
               options: dict | None = None) -> Callable[[DataFrame, int], None]:
    """A sink of micro-batches of ``key, value`` rows (and their places). ``run`` names the query that writes.

    A file topic gets a folder per batch, written over when a batch is retried; Kafka gets the batch again (at least once)."""
    def write(df: DataFrame, batch_id: int) -> None:
        if fmt == "kafka":
            write_topic(df, topic, servers, fmt, options=options)
            return
        _file_rows(df).write.mode("overwrite").format(fmt).options(**(options or {})).save(
            os.path.join(topic_path(root, topic), f"run={run}", f"batch={batch_id}"))
    return write


def read_json_topic(spark: SparkSession, schema: T.StructType, topic: str,
                    servers: str | None = None, fmt: str = "kafka", root: str | None = None,
                    streaming: bool = True, keep: tuple[str, ...] = PLACE,
                    required: tuple[str, ...] = (),
                    max_per_trigger: int | None = None,
                    options: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """A topic of JSON records, strictly decoded: ``(accepted, rejected)``, with ``keep`` columns."""
    raw = read_topic(spark, topic, servers, decode="string", fmt=fmt, root=root,
                     streaming=streaming, max_per_trigger=max_per_trigger, options=options)
    return decode_json(raw, schema, "value", required=required, keep=keep)


def read_json_report(spark: SparkSession, schema: T.StructType, topic: str, servers: str | None = None, fmt: str = "kafka",
                     root: str | None = None, streaming: bool = True, required: tuple[str, ...] = (),
                     max_per_trigger: int | None = None, options: dict | None = None, reason: str = "reason",
                     raw: str | None = None) -> DataFrame:
    """A topic of JSON records with both outcomes of one decode in a row: places, fields, ``reason`` and ``raw`` text."""
    rows = read_topic(spark, topic, servers, decode="string", fmt=fmt, root=root, streaming=streaming,
                      max_per_trigger=max_per_trigger, options=options)
    return decode_json_report(rows, schema, "value", required=required, keep=PLACE, reason=reason, raw=raw)


def write_json_topic(df: DataFrame, topic: str, checkpoint: str, servers: str | None = None,
                     fmt: str = "kafka", root: str | None = None, key: str | None = "record",
                     cols: list[str] | None = None, name: str | None = None,
                     available_now: bool = False,
                     state_partitions: int | None = None,
                     options: dict | None = None) -> StreamingQuery:
    """Stream records to a topic as JSON (key = whole record by default). At-least-once.

    ``state_partitions``: state partitions of a stateful upstream, fixed at the first start. A file topic
    also stores the trigger's ``ts`` and ``seq`` where ``df`` has them, as ``write_topic`` does, so that
    another topology can read it in order (a broker assigns time and offset itself)."""
    rows = to_topic_rows(df, cols, key=key, keep=() if fmt == "kafka" else _order_columns(df))
    if fmt != "kafka":
        ts = (utc_ntz(F.col("ts"), rows.schema["ts"].dataType) if "ts" in rows.columns
              else utc_ntz(F.current_timestamp()))
        seq = F.col("seq").cast("long") if "seq" in rows.columns else F.lit(None).cast("long")
        part = (F.col("partition") if "partition" in rows.columns else F.lit(None)).cast("int")
        rows = rows.select("key", "value", ts.alias("ts"), part.alias("partition"), seq.alias("seq"))
    writer = rows.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    with shuffle_partitions(df.sparkSession, state_partitions):
        if fmt == "kafka":
            return writer.format("kafka").options(
                **kafka_sink_options(servers, topic, **(options or {}))).start()
        return writer.format(fmt).options(**(options or {})).start(topic_path(root, topic))
