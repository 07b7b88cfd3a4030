"""Command line: start a topology, or read / write a topic.

    python -m tidal enrich      --servers host:9092 [--checkpoint DIR]
    python -m tidal table-join  --servers host:9092 [--echo]
    python -m tidal rule-gate   --servers host:9092 [--shards N]
    python -m tidal read-topic  TOPIC --servers host:9092 [--decode string|binary] [--rows N]
    python -m tidal write-record TOPIC KEY VALUE --servers host:9092

``--fmt parquet --root DIR`` uses folders of files as topics instead of Kafka.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m tidal")
    sub = p.add_subparsers(dest="cmd", required=True)

    def common(sp):
        sp.add_argument("--servers")
        sp.add_argument("--fmt", default="kafka")
        sp.add_argument("--root")
        sp.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                        help="passed on to the source and the sink, as often as needed")
        return sp

    for name in ("enrich", "table-join", "rule-gate"):
        sp = common(sub.add_parser(name))
        sp.add_argument("--checkpoint")
        sp.add_argument("--batch", action="store_true", help="one bounded batch run")
        sp.add_argument("--available-now", action="store_true", help="drain and stop")
        sp.add_argument("--max-per-trigger", type=int,
                        help="records (Kafka) or files (folders) per micro-batch and topic")
        sp.add_argument("--keyed-state", action="store_true", help="run on Spark's keyed state")
        sp.add_argument("--state-partitions", type=int, help="of a run on keyed state")
        sp.add_argument("--reject-topic", default="rejected", help="topic of the records set aside by decoding")
        if name == "table-join":
            sp.add_argument("--echo", action="store_true")
        if name == "rule-gate":
            sp.add_argument("--shards", type=int)
    sp = common(sub.add_parser("read-topic"))
    sp.add_argument("topic")
    sp.add_argument("--decode", default="string", choices=["string", "binary"])
    sp.add_argument("--rows", type=int, help="print so many records at most (default: all)")
    sp = common(sub.add_parser("write-record"))
    sp.add_argument("topic")
    sp.add_argument("key")
    sp.add_argument("value")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    from tidal.plans import enrich_topology, rule_gate_topology, table_join_topology
    from tidal.session import get_session
    from tidal.sources.topics import read_topic, write_topic
    from tidal.streaming.runner import tap

    args = _parser().parse_args(argv)
    spark = spark or get_session(app=f"tidal-{args.cmd}")
    io = {"servers": args.servers, "fmt": args.fmt, "root": args.root}
    options = dict(o.split("=", 1) for o in args.option)
    if args.cmd == "read-topic":
        tap(read_topic(spark, args.topic, decode=args.decode, read_committed=True, options=options, **io), rows=args.rows)
        return 0
    if args.cmd == "write-record":
        rec = spark.createDataFrame([(args.key, args.value)], "key string, value string")
        write_topic(rec, args.topic, options=options, **io)
        return 0
    run = {"streaming": not args.batch, "checkpoint": args.checkpoint,
           "available_now": args.available_now, "max_per_trigger": args.max_per_trigger,
           "state_partitions": args.state_partitions, "keyed_state": args.keyed_state,
           "reject_topic": args.reject_topic or None, "read_options": options, "write_options": options, **io}
    if args.cmd == "enrich":
        q = enrich_topology(spark, **run)
    elif args.cmd == "table-join":
        q = table_join_topology(spark, echo=args.echo, replace=True, **run)
    else:
        q = rule_gate_topology(spark, shards=args.shards, **run)
    if q is not None:
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
