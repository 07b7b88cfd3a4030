"""Latest-rule filter on streams.

Rules are kept with their ``ts`` and ``seq``, and each action takes the rule as of its own ``ts`` among all
rules received so far. The answer therefore doesn't depend on how the input falls into micro-batches, as
long as a rule arrives no later than the actions it governs; it is that of the batch form.

``rule_filter_microbatch`` (JVM only, the form for large streams): each micro-batch runs the batch interval
join with the rules that govern some time of its actions. All rules received are kept by batch id in a log with levels
(``tidal.streaming.batchlog``); a merged folder holds its rules in order of time with the time of the next one, so that only the
row groups that overlap the actions' times are read, however many batches and rules came before.

``rule_filter_stream`` (a streaming DataFrame, to be composed): every rule is copied to each of ``shards``
shard ids, each action goes to one shard by ``hash(actionId)``, and each shard keeps the rules in list state,
as broadcast state does with one copy per parallel worker. PySpark builds the frames of this operator row by
row in Python, and a shard's share of a micro-batch is held at once: bound the batches.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidal.operators.pairing import positions
from tidal.operators.rules import ACTION_RANK, RULE_RANK, RULES_PER_BLOCK, rule_filter, timed_rules, ts_literal, with_next
from tidal.session import default_blocks, ensure_state_store, shared_dir, ship_package
from tidal.streaming.batchlog import BatchLog, fixed_setting
from tidal.streaming.pairing import KIND
from tidal.streaming.staged import RAW, REASON, Sink, folder_sink, staged_query


def _micros(ts: pd.Series) -> np.ndarray:
    """Times as int64 (a missing one is the least)."""
    return ts.to_numpy(dtype="datetime64[us]").view(np.int64)


def gate_actions(actions: pd.DataFrame, rules: list[tuple]) -> pd.DataFrame:
    """The actions that the rule as of their time lists. ``rules``: (micros, ..., allowed), in order."""
    if not rules or not len(actions):
        return actions.iloc[:0]
    governing = np.searchsorted(np.array([r[0] for r in rules], np.int64), _micros(actions["ts"]), side="right") - 1
    order = np.argsort(governing, kind="stable")
    runs = governing[order]
    cuts = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1], True])
    keep = np.zeros(len(actions), dtype=bool)
    names = actions["action"]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if runs[a] < 0 or (allowed := rules[runs[a]][-1]) is None:
            continue
        at = order[a:b]
        keep[at] = names.iloc[at].isin(list(allowed)).to_numpy()
    return actions.loc[keep]


class RuleGateProcessor(StatefulProcessor):
    """One shard: the rules received so far, applied to the shard's actions."""

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rules = handle.getListState("rules", "micros long, topic string, partition int, seq long, allowed array<string>")

    def handleInputRows(self, key, rows, timerValues):
        new, actions = [], []
        for frame in rows:
            is_rule = frame[KIND].to_numpy(dtype=np.int64) == RULE_RANK
            if is_rule.any():
                r = frame.loc[is_rule]
                place = [[None if pd.isna(v) else kind(v) for v in r[c]] if c in r.columns else [None] * len(r)
                         for c, kind in (("topic", str), ("partition", int), ("seq", int))]
                new += [(int(t), *p, None if a is None else list(a))
                        for t, *p, a in zip(_micros(r["ts"]), *place, r["allowedActions"], strict=True)]
            if not is_rule.all():
                actions.append(frame.loc[~is_rule].drop(columns=["shard", KIND, "ruleId", "allowedActions"], errors="ignore"))
        if new:
            self.rules.appendList(new)
        held = [tuple(r) for r in self.rules.get()]
        held.sort(key=lambda r: (r[0], *[(v is not None, v.encode() if isinstance(v, str) else v or 0) for v in r[1:4]]))
        for frame in actions:
            kept = gate_actions(frame.reset_index(drop=True), held)
            if len(kept):
                yield kept[self.columns]

    def close(self) -> None:
        pass


def rule_filter_stream(actions: DataFrame, rules: DataFrame, shards: int | None = None) -> DataFrame:
    """Streaming latest-rule filter; same inputs and output columns as the batch form."""
    ship_package(actions.sparkSession)
    ensure_state_store(actions.sparkSession)
    n = shards or default_blocks(actions.sparkSession)
    tagged = _tagged(actions, rules)
    copies = F.when(F.col(KIND) == RULE_RANK, F.sequence(F.lit(0), F.lit(n - 1))).otherwise(
        F.array(F.pmod(F.xxhash64("actionId"), F.lit(n)).cast("int")))
    schema = _records(actions)
    return tagged.withColumn("shard", F.explode(copies)).groupBy("shard").transformWithStateInPandas(
        RuleGateProcessor(schema.names), schema, "Append", "None")


def _records(actions: DataFrame) -> T.StructType:
    return actions.select("actionId", "userId", "action", "ts", *positions(actions), "seq").schema


def _tagged(actions: DataFrame, rules: DataFrame) -> DataFrame:
    """Timed rules and actions in one stream; a place (topic, partition) as far as each side has one."""
    null = F.lit(None).cast("string")

    def place(df):
        return [(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
                for c, t in (("topic", "string"), ("partition", "int")) if c in actions.columns or c in rules.columns]
    aside = [c for c in (REASON, RAW) if c in actions.columns and c in rules.columns]
    r = rules.where(F.col("ts").isNotNull() | F.col(REASON).isNotNull()) if aside else timed_rules(rules)
    return r.select(F.lit(RULE_RANK).alias(KIND), "ts", *place(r), "seq", null.alias("actionId"), null.alias("userId"),
                    null.alias("action"), "ruleId", "allowedActions", *aside).unionByName(
        actions.select(F.lit(ACTION_RANK).alias(KIND), "ts", *place(actions), "seq", "actionId", "userId", "action",
                       null.alias("ruleId"), F.lit(None).cast("array<string>").alias("allowedActions"), *aside))


# -- the same filter without Python state: one batch interval join per micro-batch ------------

def _timed(rows: DataFrame, whole: bool = False, n: int | None = None) -> DataFrame:
    """Rows in order of time, each with the next one's; one replaced at its own time never governs and is left out."""
    n = rows.count() if n is None else n
    timed = with_next(rows.drop("next_ts"), n)
    timed = timed.where(F.col("next_ts").isNull() | (F.col("next_ts") > F.col("ts")))
    spread = timed.coalesce(1) if n <= RULES_PER_BLOCK else timed.repartitionByRange("ts")
    return spread.sortWithinPartitions("ts")


def rule_filter_microbatch(actions: DataFrame, rules: DataFrame, path: str | None = None,
                           checkpoint: str | None = None, name: str = "rule_filter",
                           available_now: bool = True, every: int = 8,
                           sink: Sink | None = None, rejects: Sink | None = None) -> StreamingQuery:
    """Streaming latest-rule filter that runs on the JVM only.

    Each micro-batch runs the batch ``rule_filter`` over its actions and the rules of all batches up to its own that
    govern their times, and appends its rules (with their places) to the log in the checkpoint folder. Output
    goes to ``{path}/batch_id=N``, or to ``sink(rows, batch_id)``, which may see a batch twice. Files are written with
    overwrite, so a retried batch reproduces the same ones (at-least-once delivery, idempotent result).
    ``every``: folders of rules merged into one (kept as first started). ``rejects`` takes records that decoding set
    aside (see ``staged_query``).
    """
    spark = actions.sparkSession
    checkpoint = checkpoint or shared_dir(spark, f"{name}-checkpoint")
    if path is None and sink is None:
        raise ValueError("give a path or a sink")
    every = fixed_setting(spark, os.path.join(checkpoint, "every"), every)
    tagged = _tagged(actions, rules)
    held_columns = ["ruleId", "allowedActions", "ts", *positions(tagged), "seq"]
    schema = T.StructType([*tagged.select(*held_columns).schema.fields, T.StructField("next_ts", tagged.schema["ts"].dataType)])
    log = BatchLog(os.path.join(checkpoint, "rules"), schema, every, merge=_timed)
    deliver = sink or folder_sink(path)
    columns = _records(actions).names

    def step(now: DataFrame, batch_id: int) -> None:
        is_rule = F.col(KIND) == RULE_RANK
        new = now.where(is_rule).select(*held_columns)
        acts = now.where(~is_rule)
        of_action = F.when(~is_rule, F.col("ts"))
        span = now.agg(F.min(of_action).alias("lo"), F.max(of_action).alias("hi"), F.count(of_action).alias("timed"),
                       F.count(F.when(is_rule, 1)).alias("rules")).first()
        # the rules that govern some time of the batch's actions, one per folder before their first at most
        before = log.before(spark, batch_id)
        if span["timed"]:
            lo, hi = (ts_literal(span[c], schema["ts"].dataType) for c in ("lo", "hi"))
            before = before.where((F.col("ts") <= hi) & (F.col("next_ts").isNull() | (F.col("next_ts") > lo)))
        else:
            before = before.where(F.lit(False))
        out = rule_filter(acts.select(*columns), before.select(*held_columns).unionByName(new))
        deliver(out, batch_id)
        log.append(_timed(new, n=span["rules"]), batch_id)
    return staged_query(tagged, step, checkpoint, name, available_now, rejects)
