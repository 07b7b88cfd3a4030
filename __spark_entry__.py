"""

Every query reads the given parquet tables (``customer``, ``events``) in full. Rules for the
latest-rule filter are query parameters (literal rows with fixed times).
"""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# the package lives next to this file; make it importable however this file was loaded
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from tidal import schemas
from tidal.functions.codec import decode_json, decode_json_report, encode_json, to_topic_rows
from tidal.operators.join import user_action_join, user_action_join_sql
from tidal.operators.pairing import pair_tagged
from tidal.operators.rules import rule_filter, rule_filter_single
from tidal.operators.views import project_action, project_user, register_views
from tidal.plans.topologies import enrich_topology, rule_gate_topology, table_join_topology
from tidal.session import shared_dir
from tidal.sources.topics import read_topic, write_topic
from tidal.sources.tables import (action_records_from_events, actions_from_events, as_text_ids,
                                  pairing_events, read_table, users_from_customer)
from tidal.streaming.join import user_action_join_microbatch
from tidal.streaming.pairing import held_cells, logged_cells, pair_microbatch, pair_tagged_stream
from tidal.streaming.rules import rule_filter_microbatch, rule_filter_stream
from tidal.streaming.runner import run_to_table

SMOKE_DIR = "/root/testdata/sf0.001"

# Fixed query parameters: three rules at fixed times over the events' month, and the single rule
# that precedes every event.
RULES = [
    ("r1", ["click", "purchase"], "2024-01-03 00:00:00", 0),
    ("r2", ["view"], "2024-01-12 00:00:00", 1),
    ("r3", ["purchase", "error", "signup"], "2024-01-21 00:00:00", 2),
]
SINGLE_RULE = ["click", "view"]


def rules_frame(spark: SparkSession) -> DataFrame:
    rows = [(rid, allowed, ts, seq) for rid, allowed, ts, seq in RULES]
    df = spark.createDataFrame(rows, "ruleId string, allowedActions array<string>, ts string, seq long")
    return df.withColumn("ts", F.to_timestamp_ntz("ts"))


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events")


def _customer(spark, sf_dir):
    return read_table(spark, sf_dir, "customer")


# ---------------------------------------------------------------------------------------------
# queries

def q_project_user(spark, sf_dir):
    return project_user(users_from_customer(_customer(spark, sf_dir)))


def q_project_action(spark, sf_dir):
    return project_action(actions_from_events(_events(spark, sf_dir)))


def q_user_action_join(spark, sf_dir):
    users = users_from_customer(_customer(spark, sf_dir), text_ids=False)
    actions = actions_from_events(_events(spark, sf_dir), ordered=True, text_ids=False)
    return as_text_ids(user_action_join(users, actions, extra=("seq",)), "userId")


def q_user_action_join_salted(spark, sf_dir):
    """The same join with explicit salting of ids above 1/2000 of the actions."""
    users = users_from_customer(_customer(spark, sf_dir), text_ids=False)
    events = _events(spark, sf_dir)
    actions = actions_from_events(events, ordered=True, text_ids=False)
    out = user_action_join(users, actions, extra=("seq",), hot_key_rows=hot_threshold(events))
    return as_text_ids(out, "userId")


def hot_threshold(events) -> int:
    """Ids with more than 1/2000 of all actions count as hot (a count over the input)."""
    return max(1, events.count() // 2000)


def micros(ts: str = "ts"):
    """A zone-free time as microseconds since 1970."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts))


def q_user_action_join_sql(spark, sf_dir):
    users = users_from_customer(_customer(spark, sf_dir))
    actions = actions_from_events(_events(spark, sf_dir))
    register_views(users, actions, "UserTable", "ActionTable", replace=True)
    return user_action_join_sql(spark, "UserTable", "ActionTable")


def q_pair_user_action(spark, sf_dir):
    ev = pairing_events(_events(spark, sf_dir), text_ids=False)     # users and actions, one scan
    out = pair_tagged(ev).select("userId", "name", "action", "seq", micros().alias("ts_us"))
    return as_text_ids(out, "userId")


def _three_users(events):
    """The events with their ids folded to three users, each a third of all rows."""
    return events.withColumn("user_id", F.col("user_id") % 3)


def q_pair_user_action_hot(spark, sf_dir):
    """Pairing of three very hot users through ordered blocks (a user spans several blocks)."""
    ev = pairing_events(_three_users(_events(spark, sf_dir)), text_ids=False)
    out = pair_tagged(ev, blocks=8, hot_key_rows=1).select("userId", "name", "action", "seq", micros().alias("ts_us"))
    return as_text_ids(out, "userId")


def error_rules(events):
    """A rule per ``error`` event, with its list chosen by the event's id."""
    k = F.col("event_id") % 3
    lists = [F.array(*[F.lit(a) for a in allowed]) for _, allowed, _, _ in RULES]
    allowed = F.when(k == 0, lists[0]).when(k == 1, lists[1]).otherwise(lists[2])
    return events.where(F.col("event_type") == "error").select(
        F.col("event_id").cast("string").alias("ruleId"), allowed.alias("allowedActions"), "ts",
        F.col("event_id").alias("seq"))


def q_rule_filter_many(spark, sf_dir):
    """The rule filter with as many rules as there are ``error`` events."""
    events = _events(spark, sf_dir)
    out = rule_filter(action_records_from_events(events), error_rules(events))
    return out.select("actionId", "userId", "action", "seq")


def q_rule_filter_many_blocks(spark, sf_dir):
    """The same by the ordered-block scan (the form for rule tables too large to sort in one task)."""
    events = _events(spark, sf_dir)
    out = rule_filter(action_records_from_events(events), error_rules(events), blocks=8, method="blocks")
    return out.select("actionId", "userId", "action", "seq")

def q_rule_filter(spark, sf_dir):
    actions = action_records_from_events(_events(spark, sf_dir))
    return rule_filter(actions, rules_frame(spark)).select("actionId", "userId", "action", "seq")


def q_rule_filter_single(spark, sf_dir):
    actions = action_records_from_events(_events(spark, sf_dir))
    return rule_filter_single(actions, SINGLE_RULE).select("actionId", "userId", "action", "seq")


def q_json_round_trip(spark, sf_dir):
    actions = action_records_from_events(_events(spark, sf_dir))
    encoded = actions.select("seq", encode_json("actionId", "userId", "action").alias("value"))
    accepted, _ = decode_json(encoded, schemas.ACTION_RECORD, keep=("seq",))
    return accepted


def json_variants(events: DataFrame) -> DataFrame:
    """One JSON text per event; the producer's habits differ by event type (see oracle)."""
    aid, uid, typ = (F.col("event_id").cast("string"), F.col("user_id").cast("string"),
                     F.col("event_type"))
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))          # noqa: E731
    text = (F.when(typ == "click", F.concat(F.lit('{"actionId":'), q(aid), F.lit(',"userId":'), q(uid),
                                              F.lit(',"action":'), q(typ), F.lit("}")))
            .when(typ == "view", F.concat(F.lit('{"actionId":'), q(aid), F.lit(',"userId":'), q(uid),
                                            F.lit(',"action":'), q(typ), F.lit(',"extra":true}')))
            .when(typ == "error", F.concat(F.lit('{"actionid":'), q(aid), F.lit(',"userId":'), q(uid),
                                             F.lit(',"action":'), q(typ), F.lit("}")))
            .when(typ == "purchase", F.concat(F.lit('{"actionId":'), q(aid), F.lit(',"userId":'), uid,
                                                F.lit(',"action":{"name":'), q(typ), F.lit("}}")))
            .otherwise(F.concat(F.lit('{"actionId":'), q(aid), F.lit(',"userId":'), uid,
                                F.lit(',"action":'), q(typ), F.lit("}"))))
    return events.select(F.col("event_id").alias("seq"), text.alias("value"))


def q_json_decode(spark, sf_dir):
    texts = json_variants(_events(spark, sf_dir))
    return decode_json_report(texts, schemas.ACTION_RECORD, keep=("seq",))


def number_texts(events: DataFrame) -> DataFrame:
    """One JSON text per event, its ids sent as numbers that a parser would write anew."""
    aid, uid = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    text = F.concat(F.lit('{"actionId":'), aid, F.lit('.50,"userId":'), uid, F.lit('e1,"action":"'), F.col("event_type"), F.lit('"}'))
    return events.select(F.col("event_id").alias("seq"), text.alias("value"))


def q_json_numbers(spark, sf_dir):
    """Numbers in text fields keep the text they were sent with."""
    return decode_json(number_texts(_events(spark, sf_dir)), schemas.ACTION_RECORD, keep=("seq",))[0]


def q_topic_rows(spark, sf_dir):
    users = users_from_customer(_customer(spark, sf_dir), text_ids=False)
    actions = actions_from_events(_events(spark, sf_dir), text_ids=False)
    joined = as_text_ids(user_action_join(users, actions), "userId")
    return to_topic_rows(joined, ["userId", "name", "action"])


def _stream(spark, sf_dir, name):
    """A table read as a file stream (explicit schema from the parquet footer)."""
    schema = read_table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}*.parquet")


def _state_partitions(spark) -> int:
    """State partitions of the registered stream queries: one per core of the cluster."""
    return spark.sparkContext.defaultParallelism


def _drained(q):
    """Wait for a query to end; raise what it raised."""
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def q_user_action_join_stream(spark, sf_dir):
    users = users_from_customer(_stream(spark, sf_dir, "customer"))
    actions = actions_from_events(_stream(spark, sf_dir, "events"), ordered=True)
    return run_to_table(user_action_join(users, actions, extra=("seq",)), "user_action_join",
                        state_partitions=_state_partitions(spark))


def q_user_action_join_stream_salted(spark, sf_dir):
    """The streaming join with every id salted over one sub-key per core (skew-safe state)."""
    users = users_from_customer(_stream(spark, sf_dir, "customer"))
    actions = actions_from_events(_stream(spark, sf_dir, "events"), ordered=True)
    joined = user_action_join(users, actions, extra=("seq",), salt=_state_partitions(spark))
    return run_to_table(joined, "user_action_join_salted", state_partitions=_state_partitions(spark))


def _paired_by_batch(spark, ev, **options):
    """The streaming pairing that runs on the JVM, drained into a table."""
    out = shared_dir(spark, "pair-out")
    _drained(pair_microbatch(ev, out, name=f"pair_{os.path.basename(out)}", **options))
    return spark.read.parquet(out)


def q_pair_user_action_stream(spark, sf_dir):
    """The streaming pairing as the batch operator over a micro-batch and the cells held before it (JVM only)."""
    out = _paired_by_batch(spark, pairing_events(_stream(spark, sf_dir, "events")))
    return out.select("userId", "name", "action", "seq", micros().alias("ts_us"))


def q_user_action_join_stream_delta(spark, sf_dir):
    """The streaming join as a delta join over four micro-batches, a third of all actions of one id."""
    users = users_from_customer(_stream(spark, sf_dir, "customer"))
    events = _events(spark, sf_dir).withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id")))
    actions = _in_files(actions_from_events(events, ordered=True), shared_dir(spark, "actions"))
    out = shared_dir(spark, "join-delta-out")
    _drained(user_action_join_microbatch(users, actions, out, ("seq",), name=f"join_{os.path.basename(out)}"))
    return spark.read.parquet(out).select("userId", "name", "action", "seq")


def q_rule_filter_stream(spark, sf_dir):
    actions = action_records_from_events(_stream(spark, sf_dir, "events"))
    rules_dir = shared_dir(spark, "rules")
    static_rules = rules_frame(spark)
    static_rules.coalesce(1).write.parquet(rules_dir)
    rules = spark.readStream.schema(static_rules.schema).parquet(rules_dir)
    out = run_to_table(rule_filter_stream(actions, rules, shards=_state_partitions(spark)),
                       "rule_filter", state_partitions=_state_partitions(spark))
    return out.select("actionId", "userId", "action", "seq")


def q_rule_filter_stream_microbatch(spark, sf_dir):
    """The streaming rule filter run as one batch interval join per micro-batch (JVM only)."""
    actions = action_records_from_events(_stream(spark, sf_dir, "events"))
    rules_dir = shared_dir(spark, "rules")
    static_rules = rules_frame(spark)
    static_rules.coalesce(1).write.parquet(rules_dir)
    rules = spark.readStream.schema(static_rules.schema).parquet(rules_dir)
    out = shared_dir(spark, "rule-filter-microbatch-out")
    _drained(rule_filter_microbatch(actions, rules, out, name=f"rule_filter_mb_{os.path.basename(out)}"))
    return spark.read.parquet(out).select("actionId", "userId", "action", "seq")


#: where a month of events is cut into the files of a stream that takes one file per micro-batch
CUTS = ["2024-01-08 00:00:00", "2024-01-15 00:00:00", "2024-01-22 00:00:00"]


#: rows of a file of such a stream
ROWS_PER_FILE = 1_000_000


def _in_files(df, path, cuts=CUTS):
    """``df`` as files in order of time, equally many for each stretch between ``cuts``; read as a stream of one
    stretch per micro-batch. Rows without a time come in the first."""
    stretch = sum([(F.coalesce(F.col("ts") >= F.lit(c).cast("timestamp_ntz"), F.lit(False))).cast("int") for c in cuts], F.lit(0))
    sizes = {r[0]: r[1] for r in df.select(stretch.alias("k")).groupBy("k").count().collect()}         # one row per stretch
    files = max(1, -(-max(sizes.values(), default=0) // ROWS_PER_FILE))
    for k in range(len(cuts) + 1):
        part = df.where(stretch == k)
        # a file for every task, with or without rows, so that a stretch is as many files as any other
        part = part.repartition(files) if sizes.get(k, 0) >= files * files else part.coalesce(1)
        part.write.mode("append").parquet(path)
        if files > 1 and len(df.sparkSession.read.parquet(path).inputFiles()) != (k + 1) * files:
            raise RuntimeError("a stretch has too few rows for its files")
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", str(files)).parquet(path)


def q_rule_filter_stream_batches(spark, sf_dir):
    """Four micro-batches of actions, all rules in the first: the JVM form."""
    actions = _in_files(action_records_from_events(_events(spark, sf_dir)), shared_dir(spark, "actions"))
    rules = _in_files(rules_frame(spark), shared_dir(spark, "rules"), cuts=[])
    out = shared_dir(spark, "rule-filter-batches-out")
    _drained(rule_filter_microbatch(actions, rules, out, name=f"rule_filter_{os.path.basename(out)}"))
    return spark.read.parquet(out).select("actionId", "userId", "action", "seq")


def q_rule_filter_stream_batches_spread(spark, sf_dir):
    """Four micro-batches of actions, a rule in each of three: the form with list state."""
    actions = _in_files(action_records_from_events(_events(spark, sf_dir)), shared_dir(spark, "actions"))
    rules = _in_files(rules_frame(spark), shared_dir(spark, "rules"),
                      cuts=["2024-01-08 00:00:00", "2024-01-15 00:00:00"])
    out = run_to_table(rule_filter_stream(actions, rules, shards=_state_partitions(spark)), "rule_filter_batches",
                       state_partitions=_state_partitions(spark))
    return out.select("actionId", "userId", "action", "seq")


def q_pair_user_action_stream_batches(spark, sf_dir):
    """The streaming pairing over four micro-batches: cells are carried from each to the next (JVM only)."""
    ev = _in_files(pairing_events(_events(spark, sf_dir)), shared_dir(spark, "events"))
    return _paired_by_batch(spark, ev).select("userId", "name", "action", "seq", micros().alias("ts_us"))


def q_pair_user_action_stream_hot(spark, sf_dir):
    """Four micro-batches of three very hot users, each spread over ordered blocks within a batch."""
    ev = _in_files(pairing_events(_three_users(_events(spark, sf_dir))), shared_dir(spark, "events"))
    out = _paired_by_batch(spark, ev, blocks=4, hot_key_rows=1)
    return out.select("userId", "name", "action", "seq", micros().alias("ts_us"))


def q_pair_user_action_stream_state(spark, sf_dir):
    """Four micro-batches of the pairing on keyed state."""
    ev = _in_files(pairing_events(_events(spark, sf_dir)), shared_dir(spark, "events"))
    out = run_to_table(pair_tagged_stream(ev), "pair_user_action_batches", state_partitions=_state_partitions(spark))
    return out.select("userId", "name", "action", "seq", micros().alias("ts_us"))


def q_pair_user_action_cells(spark, sf_dir):
    """What the pairing on keyed state remembers after all events, read from the state in its checkpoint."""
    ev = pairing_events(_stream(spark, sf_dir, "events"))
    checkpoint = shared_dir(spark, "pair-checkpoint")
    run_to_table(pair_tagged_stream(ev), "pair_user_action_cells", checkpoint=checkpoint, state_partitions=_state_partitions(spark))
    return held_cells(spark, checkpoint)


def q_pair_user_action_cells_logged(spark, sf_dir):
    """The same after four micro-batches on the JVM, from the table of cells."""
    ev = _in_files(pairing_events(_events(spark, sf_dir)), shared_dir(spark, "events"))
    checkpoint = shared_dir(spark, "pair-checkpoint")
    _paired_by_batch(spark, ev, checkpoint=checkpoint, every=2)
    return logged_cells(spark, checkpoint, len(CUTS) + 1)


def placed_events(events):
    """The pairing's events with times cut to days, on two partitions: many records share a time."""
    return pairing_events(events).withColumns({
        "ts": F.date_trunc("day", "ts").cast("timestamp_ntz"), "topic": F.when(F.col("_rank") == 0, "users").otherwise("actions"),
        "partition": (F.col("seq") % 2).cast("int"), "seq": F.expr("seq div 2")})


_PLACED = ["userId", "name", "action", "topic", "partition", "seq"]


def q_pair_user_action_places(spark, sf_dir):
    """Records of one time stand by topic, partition and position."""
    return pair_tagged(placed_events(_events(spark, sf_dir))).select(*_PLACED, micros().alias("ts_us"))


def q_pair_user_action_places_stream(spark, sf_dir):
    """The same on a stream of four micro-batches."""
    ev = _in_files(placed_events(_events(spark, sf_dir)), shared_dir(spark, "events"))
    return _paired_by_batch(spark, ev).select(*_PLACED, micros().alias("ts_us"))


# -- end-to-end topologies over file-folder topics derived from the tables ---------------------

TOPIC_FMT = "parquet"


def _topic(df: DataFrame, root: str, name: str, *cols, ts="ts", seq="seq") -> None:
    rows = df.select(F.lit(None).cast("string").alias("key"), encode_json(*cols).alias("value"),
                     F.col(ts).alias("ts"), F.col(seq).alias("seq"))
    write_topic(rows, name, fmt=TOPIC_FMT, root=root)


def _event_topics(spark, sf_dir, root, users_from_signups=True):
    ev = _events(spark, sf_dir)
    uid = F.col("user_id").cast("string").alias("userId")
    signup = F.col("event_type") == "signup"
    if users_from_signups:
        users = ev.where(signup).select(uid, F.col("props").alias("name"), "ts",
                                        F.col("event_id").alias("seq"))
        _topic(users, root, "users", "userId", "name")
        acts = ev.where(~signup)
    else:
        acts = ev
    actions = acts.select(F.col("event_id").cast("string").alias("actionId"), uid,
                          F.col("event_type").alias("action"), "ts", F.col("event_id").alias("seq"))
    return actions


def _output_topic(spark, root, name):
    return read_topic(spark, name, fmt=TOPIC_FMT, root=root, decode="string").select("key", "value")


def q_enrich_topics(spark, sf_dir):
    """Users and actions as JSON topics -> strict decode -> streaming pairing -> JSON topic."""
    root = shared_dir(spark, "enrich-topics")
    _topic(_event_topics(spark, sf_dir, root), root, "actions", "userId", "action")
    _drained(enrich_topology(spark, fmt=TOPIC_FMT, root=root, streaming=True, available_now=True))
    return _output_topic(spark, root, "user-actions")


def q_table_join_topics(spark, sf_dir, streaming=False):
    """Customer users and event actions as JSON topics -> views + SQL join (batch) -> JSON topic."""
    root = shared_dir(spark, "join-topics")
    users = _customer(spark, sf_dir).select(
        F.col("c_custkey").cast("string").alias("userId"), F.col("c_name").alias("name"),
        F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")).alias("ts"), F.col("c_custkey").alias("seq"))
    _topic(users, root, "users", "userId", "name")
    _topic(_event_topics(spark, sf_dir, root, users_from_signups=False), root, "actions",
           "userId", "action")
    q = table_join_topology(spark, fmt=TOPIC_FMT, root=root, streaming=streaming, available_now=streaming,
                            user_view="UserTopic", action_view="ActionTopic", replace=True)
    if q is not None:
        _drained(q)
    return _output_topic(spark, root, "user-actions")


def q_table_join_topics_stream(spark, sf_dir):
    return q_table_join_topics(spark, sf_dir, streaming=True)


def q_rule_gate_topics_stream(spark, sf_dir):
    return q_rule_gate_topics(spark, sf_dir, streaming=True)


def q_rule_gate_rejects(spark, sf_dir, streaming=False):
    """Events as JSON of different producers through the rule gate: the records that decoding sets aside."""
    root = shared_dir(spark, "reject-topics")
    _topic(rules_frame(spark), root, "rules", "ruleId", "allowedActions")
    events = _events(spark, sf_dir)
    texts = json_variants(events).join(events.select(F.col("event_id").alias("seq"), "ts"), "seq")
    write_topic(texts.select(F.lit(None).cast("string").alias("key"), "value", "ts", (F.col("seq") % 2).alias("partition"), "seq"),
                "actions", fmt=TOPIC_FMT, root=root)
    q = rule_gate_topology(spark, fmt=TOPIC_FMT, root=root, streaming=streaming, available_now=streaming)
    if q is not None:
        _drained(q)
    found = read_topic(spark, "rejected", fmt=TOPIC_FMT, root=root, decode="string")
    return found.select(F.from_json("value", "topic string, partition int, position long, reason string, value string").alias("r")).select("r.*")


def q_rule_gate_rejects_stream(spark, sf_dir):
    return q_rule_gate_rejects(spark, sf_dir, streaming=True)


def q_rule_gate_topics(spark, sf_dir, streaming=False):
    """Rules and actions as JSON topics -> strict decode -> latest-rule filter (batch) -> topic."""
    root = shared_dir(spark, "rule-topics")
    _topic(rules_frame(spark), root, "rules", "ruleId", "allowedActions")
    _topic(_event_topics(spark, sf_dir, root, users_from_signups=False), root, "actions",
           "actionId", "userId", "action")
    q = rule_gate_topology(spark, fmt=TOPIC_FMT, root=root, streaming=streaming, available_now=streaming)
    if q is not None:
        _drained(q)
    return _output_topic(spark, root, "actions-filtered")


def _optional(name: str):
    """The module, or None when it, or the training-data folder it stands on, is not there."""
    try:
        return importlib.import_module(name)
    except ImportError as e:
        absent = e.name or ""
        if absent == name or absent == "tidal.llm" or absent.startswith("tidal.llm."):
            return None
        raise


def _llm():
    """The training-data queries, when their folder is there (nothing else depends on it)."""
    return _optional("tidal.llm.queries")


def _pipeline():
    return _optional("corpus_pipeline")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    extra = {}
    if (llm := _llm()) is not None:
        extra |= llm.QUERIES
    if (pipeline := _pipeline()) is not None:
        extra["pipeline"] = pipeline.run
    return extra | {
        "project_user": q_project_user,
        "project_action": q_project_action,
        "user_action_join": q_user_action_join,
        "user_action_join_salted": q_user_action_join_salted,
        "user_action_join_sql": q_user_action_join_sql,
        "pair_user_action": q_pair_user_action,
        "rule_filter": q_rule_filter,
        "rule_filter_single": q_rule_filter_single,
        "json_round_trip": q_json_round_trip,
        "json_decode": q_json_decode,
        "topic_rows": q_topic_rows,
        "user_action_join_stream": q_user_action_join_stream,
        "user_action_join_stream_salted": q_user_action_join_stream_salted,
        "pair_user_action_stream": q_pair_user_action_stream,
        "rule_filter_stream": q_rule_filter_stream,
        "rule_filter_stream_microbatch": q_rule_filter_stream_microbatch,
        "enrich_topics": q_enrich_topics,
        "table_join_topics": q_table_join_topics,
        "rule_gate_topics": q_rule_gate_topics,
        "pair_user_action_hot": q_pair_user_action_hot,
        "rule_filter_many": q_rule_filter_many,
        "rule_filter_many_blocks": q_rule_filter_many_blocks,
        "rule_filter_stream_batches": q_rule_filter_stream_batches,
        "rule_filter_stream_batches_spread": q_rule_filter_stream_batches_spread,
        "pair_user_action_stream_batches": q_pair_user_action_stream_batches,
        "table_join_topics_stream": q_table_join_topics_stream,
        "rule_gate_topics_stream": q_rule_gate_topics_stream,
        "user_action_join_stream_delta": q_user_action_join_stream_delta,
        "pair_user_action_stream_hot": q_pair_user_action_stream_hot,
        "pair_user_action_stream_state": q_pair_user_action_stream_state,
        "pair_user_action_cells": q_pair_user_action_cells,
        "pair_user_action_cells_logged": q_pair_user_action_cells_logged,
        "pair_user_action_places": q_pair_user_action_places,
        "pair_user_action_places_stream": q_pair_user_action_places_stream,
        "json_numbers": q_json_numbers,
        "rule_gate_rejects": q_rule_gate_rejects,
        "rule_gate_rejects_stream": q_rule_gate_rejects_stream,
    }


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: keyed pairing of users and actions on the sf0.001 tables."""
    return q_pair_user_action(spark, SMOKE_DIR)


# ---------------------------------------------------------------------------------------------
# DuckDB oracles

def _rules_values() -> str:
    rows = []
    for rid, allowed, ts, seq in RULES:
        lst = "[" + ", ".join(f"'{a}'" for a in allowed) + "]"
        rows.append(f"('{rid}', {lst}, TIMESTAMP '{ts}', {seq})")
    return ", ".join(rows)


# The pairing as the state machine itself, one event of each user per step.
_SQL_PAIR = """
WITH RECURSIVE ev AS MATERIALIZED (
  SELECT uid, row_number() OVER (PARTITION BY uid ORDER BY ts, rk, {order}) AS n, rk, nm, act, ts, seq
  FROM (SELECT CAST({uid} AS VARCHAR) AS uid, {ts} AS ts, event_id AS seq,
               CASE WHEN event_type = 'signup' THEN 0 ELSE 1 END AS rk,
               CASE WHEN event_type = 'signup' THEN props END AS nm,
               CASE WHEN event_type <> 'signup' THEN event_type END AS act
        FROM events)),
cells AS (
  SELECT DISTINCT uid, CAST(0 AS BIGINT) AS n, FALSE AS has_user, CAST(NULL AS VARCHAR) AS held_name,
         FALSE AS has_action, CAST(NULL AS VARCHAR) AS held_action, FALSE AS emits,
         CAST(NULL AS VARCHAR) AS out_name, CAST(NULL AS VARCHAR) AS out_action,
         CAST(NULL AS BIGINT) AS seq, CAST(NULL AS BIGINT) AS ts_us
  FROM ev
  UNION ALL
  SELECT e.uid, e.n,
         CASE WHEN e.rk = 0 THEN NOT c.has_action ELSE c.has_user END,
         CASE WHEN e.rk = 0 THEN (CASE WHEN c.has_action THEN NULL ELSE e.nm END) ELSE c.held_name END,
         CASE WHEN e.rk = 0 THEN FALSE ELSE NOT c.has_user END,
         CASE WHEN e.rk = 0 OR c.has_user THEN NULL ELSE e.act END,
         CASE WHEN e.rk = 0 THEN c.has_action ELSE c.has_user END,
         CASE WHEN e.rk = 0 THEN e.nm ELSE c.held_name END,
         CASE WHEN e.rk = 0 THEN c.held_action ELSE e.act END,
         e.seq, epoch_us(e.ts)
  FROM cells c JOIN ev e ON e.uid = c.uid AND e.n = c.n + 1)
"""


def _pair_sql(uid: str = "user_id", ts: str = "ts", order: str = "seq", columns: str = "seq") -> str:
    """What the pairing emits."""
    return _SQL_PAIR.format(uid=uid, ts=ts, order=order) + (
        f'SELECT uid AS "userId", out_name AS name, out_action AS action, {columns}, ts_us FROM cells WHERE emits')


def _cells_sql() -> str:
    """What the pairing remembers after the last event of each user."""
    return _SQL_PAIR.format(uid="user_id", ts="ts", order="seq") + (
        'SELECT c.uid AS "userId", held_name AS name, held_action AS action, has_user, has_action FROM cells c '
        "JOIN (SELECT uid, max(n) AS n FROM ev GROUP BY uid) last ON last.uid = c.uid AND last.n = c.n WHERE has_user OR has_action")

_SQL_RULES_MANY = """
WITH r AS (
  SELECT ts, lead(ts) OVER (ORDER BY ts, event_id) AS next_ts,
         CASE event_id % 3 WHEN 0 THEN {l0} WHEN 1 THEN {l1} ELSE {l2} END AS allowed
  FROM events WHERE event_type = 'error')
SELECT CAST(e.event_id AS VARCHAR) AS "actionId", CAST(e.user_id AS VARCHAR) AS "userId",
       e.event_type AS action, e.event_id AS seq
FROM events e JOIN r ON e.ts >= r.ts AND (r.next_ts IS NULL OR e.ts < r.next_ts)
WHERE list_contains(r.allowed, e.event_type)
"""

_SQL_RULES = """
WITH rules(rule_id, allowed, ts, seq) AS (VALUES {rules}),
r AS (SELECT *, lead(ts) OVER (ORDER BY ts, seq) AS next_ts FROM rules)
SELECT CAST(e.event_id AS VARCHAR) AS "actionId", CAST(e.user_id AS VARCHAR) AS "userId",
       e.event_type AS action, e.event_id AS seq
FROM events e JOIN r ON e.ts >= r.ts AND (r.next_ts IS NULL OR e.ts < r.next_ts)
WHERE list_contains(r.allowed, e.event_type)
"""

_SQL_JSON_CHECKED = """
WITH src AS (
  SELECT event_id AS seq,
    CASE event_type
      WHEN 'click' THEN '{{"actionId":"' || event_id || '","userId":"' || user_id || '","action":"' || event_type || '"}}'
      WHEN 'view' THEN '{{"actionId":"' || event_id || '","userId":"' || user_id || '","action":"' || event_type || '","extra":true}}'
      WHEN 'error' THEN '{{"actionid":"' || event_id || '","userId":"' || user_id || '","action":"' || event_type || '"}}'
      WHEN 'purchase' THEN '{{"actionId":"' || event_id || '","userId":' || user_id || ',"action":{{"name":"' || event_type || '"}}}}'
      ELSE '{{"actionId":"' || event_id || '","userId":' || user_id || ',"action":"' || event_type || '"}}'
    END AS value
  FROM events),
c AS (
  SELECT seq, value,
    CASE
      WHEN value IS NULL THEN '{null}'
      WHEN trim(value) = '' THEN '{blank}'
      WHEN NOT json_valid(value) OR json_type(value) <> 'OBJECT' THEN '{malformed}'
      WHEN len(list_filter(json_keys(value), lambda k: k NOT IN ('actionId', 'userId', 'action'))) > 0
        THEN '{unknown}'
      WHEN coalesce(json_type(value, '$.actionId'), '') IN ('OBJECT', 'ARRAY')
        OR coalesce(json_type(value, '$.userId'), '') IN ('OBJECT', 'ARRAY')
        OR coalesce(json_type(value, '$.action'), '') IN ('OBJECT', 'ARRAY') THEN '{nested}'
    END AS reason
  FROM src)
"""

_SQL_JSON_DECODE = _SQL_JSON_CHECKED + """
SELECT seq,
  CASE WHEN reason IS NULL THEN json_extract_string(value, '$.actionId') END AS "actionId",
  CASE WHEN reason IS NULL THEN json_extract_string(value, '$.userId') END AS "userId",
  CASE WHEN reason IS NULL THEN json_extract_string(value, '$.action') END AS action,
  reason
FROM c
"""


def oracle_sql() -> dict[str, str]:
    from tidal.functions import codec

    reasons = {"null": codec.REASON_NULL, "blank": codec.REASON_BLANK, "malformed": codec.REASON_MALFORMED,
               "unknown": codec.REASON_UNKNOWN_FIELD, "nested": codec.REASON_NESTED}
    join = ("SELECT CAST(c.c_custkey AS VARCHAR) AS \"userId\", c.c_name AS name, "
            "e.event_type AS action{extra} FROM customer c, events e "
            "WHERE CAST(c.c_custkey AS VARCHAR) = CAST(e.user_id AS VARCHAR)")
    sql = {
        "project_user": 'SELECT CAST(c_custkey AS VARCHAR) AS "userId", c_name AS name FROM customer',
        "project_action": 'SELECT CAST(user_id AS VARCHAR) AS "userId", event_type AS action FROM events',
        "user_action_join": join.format(extra=", e.event_id AS seq"),
        "user_action_join_sql": join.format(extra=""),
        "pair_user_action": _pair_sql(),
        "pair_user_action_hot": _pair_sql("user_id % 3"),
        "rule_filter_many": _SQL_RULES_MANY.format(**{f"l{i}": str(r[1]) for i, r in enumerate(RULES)}),
        "rule_filter": _SQL_RULES.format(rules=_rules_values()),
        "rule_filter_single": (
            'SELECT CAST(event_id AS VARCHAR) AS "actionId", CAST(user_id AS VARCHAR) AS "userId", '
            "event_type AS action, event_id AS seq FROM events WHERE event_type IN ("
            + ", ".join(f"'{a}'" for a in SINGLE_RULE) + ")"),
        "json_round_trip": (
            "SELECT event_id AS seq, CAST(event_id AS VARCHAR) AS \"actionId\", "
            "CAST(user_id AS VARCHAR) AS \"userId\", event_type AS action FROM events"),
        "json_decode": _SQL_JSON_DECODE.format(**reasons),
        "topic_rows": (
            "SELECT j AS key, j AS value FROM (SELECT '{\"userId\":\"' || CAST(c.c_custkey AS VARCHAR) "
            "|| '\",\"name\":\"' || c.c_name || '\",\"action\":\"' || e.event_type || '\"}' AS j "
            "FROM customer c, events e WHERE CAST(c.c_custkey AS VARCHAR) = CAST(e.user_id AS VARCHAR))"),
    }
    # streaming forms compute the same results as the batch forms
    sql["user_action_join_salted"] = sql["user_action_join"]
    # topologies: the operator's result as JSON text, the whole record as key and value
    sql["enrich_topics"] = (
        "SELECT j AS key, j AS value FROM (SELECT json_object('userId', \"userId\", 'name', name, "
        "'action', action)::VARCHAR AS j FROM (" + sql["pair_user_action"] + "))")
    sql["table_join_topics"] = (
        "SELECT j AS key, j AS value FROM (SELECT json_object('userId', \"userId\", 'name', name, "
        "'action', action)::VARCHAR AS j FROM (" + sql["user_action_join_sql"] + "))")
    sql["rule_gate_topics"] = (
        "SELECT j AS key, j AS value FROM (SELECT json_object('actionId', \"actionId\", "
        "'userId', \"userId\", 'action', action)::VARCHAR AS j FROM (" + sql["rule_filter"] + "))")
    for name in ("user_action_join", "pair_user_action", "rule_filter"):
        sql[f"{name}_stream"] = sql[name]
    sql["rule_filter_stream_microbatch"] = sql["rule_filter"]
    sql["user_action_join_stream_salted"] = sql["user_action_join"]
    sql["rule_filter_many_blocks"] = sql["rule_filter_many"]
    sql["rule_filter_stream_batches"] = sql["rule_filter_stream_batches_spread"] = sql["rule_filter"]
    sql["pair_user_action_stream_batches"] = sql["pair_user_action"]
    sql["table_join_topics_stream"] = sql["table_join_topics"]
    sql["rule_gate_topics_stream"] = sql["rule_gate_topics"]
    sql["pair_user_action_stream_hot"] = sql["pair_user_action_hot"]
    sql["pair_user_action_stream_state"] = sql["pair_user_action"]
    sql["pair_user_action_cells"] = sql["pair_user_action_cells_logged"] = _cells_sql()
    sql["pair_user_action_places"] = sql["pair_user_action_places_stream"] = _pair_sql(
        ts="date_trunc('day', ts)", order="seq % 2, seq // 2",
        columns="CASE WHEN signup THEN 'users' ELSE 'actions' END AS topic, CAST(seq % 2 AS INT) AS partition, "
                "CAST(seq // 2 AS BIGINT) AS seq").replace("FROM cells WHERE emits", "FROM (SELECT c.*, EXISTS (SELECT 1 FROM events x "
        "WHERE x.event_id = c.seq AND x.event_type = 'signup') AS signup FROM cells c) WHERE emits")
    sql["user_action_join_stream_delta"] = (
        "SELECT CAST(c.c_custkey AS VARCHAR) AS \"userId\", c.c_name AS name, e.event_type AS action, e.event_id AS seq "
        "FROM customer c JOIN events e ON c.c_custkey = CASE WHEN e.event_id % 3 = 0 THEN 1 ELSE e.user_id END")
    sql["json_numbers"] = (
        "SELECT event_id AS seq, CAST(event_id AS VARCHAR) || '.50' AS \"actionId\", CAST(user_id AS VARCHAR) || 'e1' AS \"userId\", "
        "event_type AS action FROM events")
    sql["rule_gate_rejects"] = sql["rule_gate_rejects_stream"] = _SQL_JSON_CHECKED.format(**reasons) + (
        "SELECT 'actions' AS topic, CAST(seq % 2 AS INT) AS partition, seq AS position, reason, value FROM c WHERE reason IS NOT NULL")
    if (llm := _llm()) is not None:
        sql |= llm.ORACLE_SQL
    if (pipeline := _pipeline()) is not None and pipeline.ORACLE_SQL:
        sql["pipeline"] = pipeline.ORACLE_SQL
    return sql
