"""End-to-end topologies: topic in -> strict JSON decode -> operator -> JSON encode -> topic out.

Each topology runs as a stream (``streaming=True``: returns the started ``StreamingQuery``) or as a
bounded batch job over whatever the topics hold (``streaming=False``: writes and returns None).
Topics are Kafka (``fmt="kafka"``, needs ``servers``) or file folders under ``root``.

Records are decoded once and written; the accepted ones go to the operator, the others to ``reject_topic`` as JSON
with topic, partition, position, time, reason and raw text (no topic: they are dropped). Streams run the batch operators on each
micro-batch (JVM only) and observe the counts per reason. Records of one time stand by topic, partition and position.

``keyed_state`` runs the pairing or the rule filter on Spark's keyed state instead, where ``state_partitions`` (and
``shards``) apply; rejected records are dropped there.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidal import schemas
from tidal.functions.codec import to_topic_rows
from tidal.operators.join import user_action_join_sql
from tidal.operators.pairing import _tagged, pair_tagged
from tidal.operators.rules import rule_filter
from tidal.operators.views import project_action, project_user, register_views
from tidal.session import shared_dir, written
from tidal.sources.topics import batch_sink, read_json_report, read_json_topic, write_json_topic, write_topic
from tidal.streaming.join import user_action_join_microbatch
from tidal.streaming.pairing import pair_microbatch, pair_user_action_stream
from tidal.streaming.rules import rule_filter_microbatch, rule_filter_stream
from tidal.streaming.runner import tap
from tidal.streaming.staged import RAW, REASON, Sink, rejects_of

# Topic names (our own naming; any names can be passed).
USER_TOPIC = "users"
ACTION_TOPIC = "actions"
USER_ACTION_TOPIC = "user-actions"
RULE_TOPIC = "rules"
FILTERED_ACTION_TOPIC = "actions-filtered"
REJECT_TOPIC = "rejected"

USER_ACTION_COLS = ["userId", "name", "action"]
ACTION_RECORD_COLS = ["actionId", "userId", "action"]


class _Ends:
    """The topics of a topology: decoded sources, and sinks for results and rejects."""

    def __init__(self, spark, name, servers, fmt, root, streaming, checkpoint, max_per_trigger, read_options, write_options,
                 out_topic, reject_topic, cols):
        self.spark, self.name, self.servers, self.fmt, self.root = spark, name, servers, fmt, root
        self.streaming, self.max_per_trigger = streaming, max_per_trigger
        self.read_options, self.write_options = read_options, write_options
        self.out_topic, self.reject_topic, self.cols = out_topic, reject_topic, cols
        self.checkpoint = (checkpoint or shared_dir(spark, f"{name}-checkpoint")) if streaming else None

    def source(self, schema, topic, required=()) -> DataFrame:
        """Places, fields, ``REASON`` and ``RAW`` of a topic's records; of a batch run written, so they are decoded once."""
        rows = read_json_report(self.spark, schema, topic, self.servers, self.fmt, self.root, self.streaming, required=required,
                                max_per_trigger=self.max_per_trigger, options=self.read_options, reason=REASON, raw=RAW)
        return rows if self.streaming else written(rows, f"{self.name}-{topic}")

    def accepted(self, schema, topic, required=()) -> DataFrame:
        """Places and fields of a topic's accepted records, as a stream to be composed."""
        return read_json_topic(self.spark, schema, topic, self.servers, self.fmt, self.root, self.streaming, required=required,
                               max_per_trigger=self.max_per_trigger, options=self.read_options)[0]

    def start(self, df: DataFrame, available_now: bool, state_partitions: int | None) -> StreamingQuery:
        """A composed stream into the result topic."""
        return write_json_topic(df, self.out_topic, self.checkpoint, servers=self.servers, fmt=self.fmt, root=self.root,
                                cols=self.cols, name=self.name, available_now=available_now, state_partitions=state_partitions,
                                options=self.write_options)

    def _rows(self, df: DataFrame) -> DataFrame:
        keep = tuple(c for c in ("ts", "partition", "seq") if self.fmt != "kafka" and c in df.columns)
        return to_topic_rows(df, self.cols, keep=keep)

    def _reject_rows(self, bad: DataFrame) -> DataFrame:
        record = bad.select(*[F.col(c) if c in bad.columns else F.lit(None).cast("string").alias(c)
                              for c in ("topic", "partition")], F.col("seq").alias("position"), F.col("ts").alias("time"), "reason", "value")
        keep = () if self.fmt == "kafka" else ("ts", "partition", "seq")
        both = record.withColumns({"ts": F.col("time"), "seq": F.col("position")})
        return to_topic_rows(both, ["topic", "partition", "position", "time", "reason", "value"], key=None, keep=keep)

    def _sink(self, topic: str) -> Sink:
        run = f"{self.name}-{zlib.crc32(self.checkpoint.encode()):08x}"
        return batch_sink(topic, run, self.servers, self.fmt, self.root, self.write_options)

    def sinks(self) -> dict[str, Sink]:
        """Sinks of a stream's results and rejects."""
        out = self._sink(self.out_topic)
        found = {"sink": lambda df, n: out(self._rows(df), n)}
        if self.reject_topic:
            bad = self._sink(self.reject_topic)
            found["rejects"] = lambda df, n: bad(self._reject_rows(df), n)
        return found

    def write(self, df: DataFrame, *sources: DataFrame) -> None:
        """A batch run's results, and what its sources set aside."""
        write_topic(self._rows(df), self.out_topic, self.servers, self.fmt, self.root, self.write_options)
        if self.reject_topic:
            for rows in sources:
                write_topic(self._reject_rows(rejects_of(rows)), self.reject_topic, self.servers, self.fmt, self.root, self.write_options)


def _accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(REASON).isNull()).drop(REASON, RAW)


def enrich_topology(spark: SparkSession, servers: str | None = None, fmt: str = "kafka",
                    root: str | None = None, streaming: bool = True,
                    checkpoint: str | None = None, available_now: bool = False,
                    user_topic: str = USER_TOPIC, action_topic: str = ACTION_TOPIC,
                    out_topic: str = USER_ACTION_TOPIC, reject_topic: str | None = REJECT_TOPIC,
                    state_partitions: int | None = None, max_per_trigger: int | None = None,
                    read_options: dict | None = None, write_options: dict | None = None,
                    keyed_state: bool = False) -> StreamingQuery | None:
    """Users and actions paired per user id with remembered state; user actions out.

    ``max_per_trigger`` bounds each micro-batch per input topic."""
    ends = _Ends(spark, "pair_users_with_actions", servers, fmt, root, streaming, checkpoint, max_per_trigger, read_options,
                 write_options, out_topic, reject_topic, USER_ACTION_COLS)
    if streaming and keyed_state:
        paired = pair_user_action_stream(ends.accepted(schemas.USER, user_topic), ends.accepted(schemas.ACTION, action_topic))
        return ends.start(paired, available_now, state_partitions)
    users, actions = ends.source(schemas.USER, user_topic), ends.source(schemas.ACTION, action_topic)
    if streaming:
        return pair_microbatch(_tagged(users, actions), checkpoint=ends.checkpoint, name=ends.name, available_now=available_now,
                               **ends.sinks())
    ends.write(pair_tagged(_tagged(_accepted(users), _accepted(actions))), users, actions)
    return None


def table_join_topology(spark: SparkSession, servers: str | None = None, fmt: str = "kafka",
                        root: str | None = None, streaming: bool = True,
                        checkpoint: str | None = None, available_now: bool = False,
                        echo: bool = False, user_topic: str = USER_TOPIC,
                        action_topic: str = ACTION_TOPIC, out_topic: str = USER_ACTION_TOPIC,
                        user_view: str = "UserTable", action_view: str = "ActionTable",
                        max_per_trigger: int | None = None, replace: bool = False,
                        reject_topic: str | None = REJECT_TOPIC, state_partitions: int | None = None,
                        read_options: dict | None = None, write_options: dict | None = None,
                        keyed_state: bool = False) -> StreamingQuery | None:
    """Users and actions registered as views and joined; user actions out.

    A batch run joins by SQL text over the views; a stream runs the same join as a delta join per micro-batch, or with
    ``keyed_state`` by the SQL text as a symmetric hash join.
    ``echo`` prints the two projected inputs and the join (on streams: three console queries, drained
    like the main one when ``available_now``). ``replace`` allows the view names to be taken already.
    """
    ends = _Ends(spark, "join_users_with_actions", servers, fmt, root, streaming, checkpoint, max_per_trigger, read_options,
                 write_options, out_topic, reject_topic, USER_ACTION_COLS)
    all_users, all_actions = ends.source(schemas.USER, user_topic), ends.source(schemas.ACTION, action_topic)
    if streaming:
        users, actions = ends.accepted(schemas.USER, user_topic), ends.accepted(schemas.ACTION, action_topic)
    else:
        users, actions = _accepted(all_users), _accepted(all_actions)
    register_views(users, actions, user_view, action_view, replace=replace)
    if echo:
        tap(project_user(users), "user_table", available_now=available_now)
        tap(project_action(actions), "action_table", available_now=available_now)
        tap(user_action_join_sql(spark, user_view, action_view), "joined", available_now=available_now)
    if streaming and keyed_state:
        return ends.start(user_action_join_sql(spark, user_view, action_view), available_now, state_partitions)
    if streaming:
        return user_action_join_microbatch(all_users, all_actions, extra=("ts", "seq"), checkpoint=ends.checkpoint, name=ends.name,
                                           available_now=available_now, **ends.sinks())
    ends.write(user_action_join_sql(spark, user_view, action_view), all_users, all_actions)
    return None


def rule_gate_topology(spark: SparkSession, servers: str | None = None, fmt: str = "kafka",
                       root: str | None = None, streaming: bool = True,
                       checkpoint: str | None = None, available_now: bool = False,
                       shards: int | None = None, rule_topic: str = RULE_TOPIC, action_topic: str = ACTION_TOPIC,
                       out_topic: str = FILTERED_ACTION_TOPIC, reject_topic: str | None = REJECT_TOPIC,
                       max_per_trigger: int | None = None, state_partitions: int | None = None,
                       read_options: dict | None = None, write_options: dict | None = None,
                       keyed_state: bool = False) -> StreamingQuery | None:
    """Actions kept when the latest rule lists their action name; kept actions out unchanged."""
    ends = _Ends(spark, "gate_actions_by_rule", servers, fmt, root, streaming, checkpoint, max_per_trigger, read_options,
                 write_options, out_topic, reject_topic, ACTION_RECORD_COLS)
    if streaming and keyed_state:
        kept = rule_filter_stream(ends.accepted(schemas.ACTION_RECORD, action_topic),
                                  ends.accepted(schemas.RULE, rule_topic, ("allowedActions",)), shards)
        return ends.start(kept, available_now, state_partitions)
    rules = ends.source(schemas.RULE, rule_topic, required=("allowedActions",))
    actions = ends.source(schemas.ACTION_RECORD, action_topic)
    if streaming:
        return rule_filter_microbatch(actions, rules, checkpoint=ends.checkpoint, name=ends.name, available_now=available_now,
                                      **ends.sinks())
    ends.write(rule_filter(_accepted(actions), _accepted(rules), shards), rules, actions)
    return None
