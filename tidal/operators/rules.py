"""Latest-rule filter (batch form).

One rule is held at a time: every rule record replaces the held one whatever its ``ruleId``. An
action passes, unchanged, when the rule held at its arrival lists its action name (null-safe);
an action that arrives before any rule is dropped; a new rule never re-examines earlier actions.
On equal ``ts`` a rule sorts before an action, and later rules (by ``seq``) win.

In join terms this is a backward as-of left-semi join on arrival order, without a key. Since the
decision depends on the rule stream only, each rule becomes a validity interval ``[ts, next ts)``
(a rule followed by one with the same ``ts`` gets an empty interval: the later one wins). The
closed intervals are exploded into time buckets, the bucket width chosen from the rules alone so
that there are about ``4 x`` as many buckets as rules; an action then meets its interval through
an equi-join on its bucket plus a range check. The open last interval is one row, applied as a
literal. The exploded table is written first, so its size in bytes decides the join: a single pass
over the actions without a shuffle when it is below the broadcast threshold; beyond it the join
shuffles on the bucket and AQE's skew join splits a hot bucket.

The intervals come from a ``lead`` within range-partitioned blocks of the rules; a block's last rule ends at
the next block's first time, from a table of one row per block. No task sorts all rules, whatever their number.

Where rule times are so uneven that a bucket is crowded with intervals, rules and actions are merged into one
ordered sequence and cut into ordered blocks instead (``tidal.operators.blocks``): a running ``last``
within each block, and the rule carried in from earlier blocks from a one-row-per-block table.

Among rules (and actions) of one time, ``topic`` and ``partition`` come before ``seq`` where the rows have them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidal.functions.predicates import null_safe_contains
from tidal.operators.blocks import BLOCK, ordered_blocks
from tidal.operators.pairing import positions
from tidal.session import written

RULE_RANK, ACTION_RANK = 0, 1
ORDER = ["ts", "_rank", "seq"]
PLACED_ORDER = ["ts", "_rank", "topic", "partition", "seq"]         # a column that the input lacks is left out

RULES_PER_BLOCK = 250_000           # rules that one task orders
BUCKETS_PER_RULE = 4
MAX_INTERVALS_PER_BUCKET = 64       # candidates one action may be checked against


def _micros(ts, dtype):
    """Microseconds on a monotone scale: epoch offset of a zone-free ``timestamp_ntz`` (no
    daylight-saving gaps), or the instant of a ``timestamp``."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)
    return F.unix_micros(ts.cast("timestamp"))


def ts_literal(value, dtype):
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def _order(df: DataFrame) -> list[str]:
    return [c for c in PLACED_ORDER if c in df.columns]


def _output(actions: DataFrame) -> list[str]:
    return ["actionId", "userId", "action", "ts", *positions(actions), "seq"]


def _tagged(actions: DataFrame, rules: DataFrame) -> DataFrame:
    null = F.lit(None).cast("string")
    place = positions(actions, rules)
    r = rules.select(F.lit(RULE_RANK).alias("_rank"), "ts", *place, "seq",
                     null.alias("actionId"), null.alias("userId"), null.alias("action"),
                     F.struct(F.col("ruleId"), F.col("allowedActions")).alias("_rule"))
    a = actions.select(F.lit(ACTION_RANK).alias("_rank"), "ts", *place, "seq", "actionId", "userId",
                       "action", F.lit(None).cast(r.schema["_rule"].dataType).alias("_rule"))
    return r.unionByName(a)


def timed_rules(rules: DataFrame) -> DataFrame:
    """The rules that have a place in the order; one without a ``ts`` is ignored in every form."""
    return rules.where(F.col("ts").isNotNull())


def rule_filter(actions: DataFrame, rules: DataFrame, blocks: int | None = None,
                method: str = "auto", initial: tuple | None = None) -> DataFrame:
    """Keep the actions allowed by the rule current at their arrival.

    ``actions``: ``actionId, userId, action, ts, seq``; ``rules``: ``ruleId, allowedActions, ts,
    seq``. Output: the passing actions with the same columns. ``method``: ``"intervals"``,
    ``"blocks"`` or ``"auto"`` (intervals unless rule times crowd a bucket).
    ``initial`` (``(ruleId, allowedActions)``) is the rule held before the first rule row, e.g.
    the rule carried over from an earlier micro-batch; by default no rule is held.
    """
    init = _literal_rule({"ruleId": initial[0], "allowedActions": initial[1]}) if initial else None
    ts_type = actions.schema["ts"].dataType
    rules = timed_rules(rules).withColumn("ts", F.col("ts").cast(ts_type))
    if method == "blocks":
        return _rule_filter_blocked(actions, rules, blocks, init)
    # one aggregate over the (small) rule side: size, time span and the last rule
    stats = rules.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(_micros(F.col("ts"), ts_type)).alias("lo"),
        F.max(_micros(F.col("ts"), ts_type)).alias("hi"),
        F.max_by(F.struct("ts", "ruleId", "allowedActions"), F.struct(*_order(rules))).alias("tail"),
    ).first()
    if stats["n"] == 0:
        if init is None:
            return actions.where(F.lit(False)).select(*_output(actions))
        return actions.where(null_safe_contains(init["allowedActions"], F.col("action"))) \
            .select(*_output(actions))
    out = _rule_filter_intervals(actions, rules, stats, ts_type, init,
                                 guard=(method == "auto"))
    return out if out is not None else _rule_filter_blocked(actions, rules, blocks, init)


def _literal_rule(tail) -> F.Column:
    allowed = tail["allowedActions"]
    items = (F.array(*[F.lit(a).cast("string") for a in allowed]) if allowed is not None
             else F.lit(None).cast("array<string>"))
    return F.struct(F.lit(tail["ruleId"]).cast("string").alias("ruleId"),
                    items.alias("allowedActions"))


def with_next(rules: DataFrame, n: int, per_block: int | None = None) -> DataFrame:
    """``rules`` with ``next_ts``, the time of the rule after it (null for the last). ``n`` is their number."""
    order = _order(rules)
    blocks = max(1, -(-n // (per_block or RULES_PER_BLOCK)))
    by_time = Window.partitionBy(BLOCK).orderBy(*order)
    if blocks == 1:
        return rules.withColumn(BLOCK, F.lit(0)).withColumn("next_ts", F.lead("ts").over(by_time)).drop(BLOCK)
    blocked = ordered_blocks(rules, order, blocks=blocks)
    local = blocked.withColumn("next_ts", F.lead("ts").over(by_time))
    after = blocked.groupBy(BLOCK).agg(F.min("ts").alias("_first")).select(
        BLOCK, F.lead("_first").over(Window.orderBy(BLOCK)).alias("_after"))        # one row per block
    return local.join(after, BLOCK).withColumn("next_ts", F.coalesce("next_ts", "_after")).drop(BLOCK, "_after")


def _rule_filter_intervals(actions: DataFrame, rules: DataFrame, stats, ts_type,
                           init: F.Column | None = None, guard: bool = False) -> DataFrame | None:
    """The interval join; None when ``guard`` finds a bucket crowded with intervals (rule times
    so uneven that the span-based width lumps many of them together)."""
    tail = stats["tail"]
    # the open last interval: one rule, applied as a literal
    tail_rule = F.when(F.col("ts") >= ts_literal(tail["ts"], ts_type), _literal_rule(tail))
    if stats["n"] == 1 or stats["hi"] == stats["lo"]:
        rule, kept = tail_rule, actions
    else:
        # Any bucket function monotone in time is exact here: an action inside [from, to) has a
        # bucket between those of ``from`` and ``to - 1us``, which the interval is exploded over.
        width = max(1, math.ceil((stats["hi"] - stats["lo"]) / (BUCKETS_PER_RULE * stats["n"])))
        iv = with_next(rules, stats["n"]).select(F.struct("ruleId", "allowedActions").alias("_rule"),
                                                 F.col("ts").alias("_from"), F.col("next_ts").alias("_to"))
        exploded = iv.where(F.col("_to") > F.col("_from")).select(
            "_rule", "_from", "_to",
            F.explode(F.sequence(F.floor(_micros(F.col("_from"), ts_type) / width),
                                 F.floor((_micros(F.col("_to"), ts_type) - 1) / width))).alias("_b"))
        if guard and stats["n"] > MAX_INTERVALS_PER_BUCKET:     # fewer rules cannot crowd a bucket
            crowd = exploded.groupBy("_b").count().agg(F.max("count")).first()[0] or 0
            if crowd > MAX_INTERVALS_PER_BUCKET:
                return None
        side = written(exploded, "rule-intervals")
        bucketed = actions.withColumn("_ab", F.floor(_micros(F.col("ts"), ts_type) / width))
        kept = bucketed.join(side, (F.col("_ab") == F.col("_b")) & (F.col("ts") >= F.col("_from"))
                             & (F.col("ts") < F.col("_to")), "left")
        rule = F.coalesce(F.col("_rule"), tail_rule)
    if init is not None:                  # before the first rule row: the rule held before
        rule = F.coalesce(rule, init)
    return kept.where(rule.isNotNull() & null_safe_contains(rule["allowedActions"], F.col("action"))) \
        .select(*_output(actions))


def _rule_filter_blocked(actions: DataFrame, rules: DataFrame, blocks: int | None,
                         init: F.Column | None = None) -> DataFrame:
    ev = _tagged(actions, rules)
    order = _order(ev)
    blocked = ordered_blocks(ev, order, blocks=blocks)
    w = Window.partitionBy(BLOCK).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = blocked.select(
        "*", F.last("_rule", ignorenulls=True).over(w).alias("_cur"),
        F.lead("_rank").over(Window.partitionBy(BLOCK).orderBy(*order)).isNull().alias("_last"))
    # the rule held at the end of each block (local), then carried forward across blocks
    summary = local.where("_last").select(BLOCK, F.col("_cur").alias("_end"))
    prior = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)   # tiny: per block
    carry = written(summary.select(F.col(BLOCK).alias("_cblk"),
                                   F.last("_end", ignorenulls=True).over(prior).alias("_in")), "carry")
    j = local.where(F.col("_rank") == ACTION_RANK).join(
        carry, F.col(BLOCK) == F.col("_cblk"), "left")
    rule = F.coalesce(F.col("_cur"), F.col("_in"))
    if init is not None:
        rule = F.coalesce(rule, init)
    place = positions(actions, rules)
    return j.where(rule.isNotNull() & null_safe_contains(rule["allowedActions"], F.col("action"))) \
        .select("actionId", "userId", "action", "ts", *place, "seq")


def rule_filter_single(actions: DataFrame, allowed: list[str | None]) -> DataFrame:
    """The filter when one rule precedes every action: a plain null-safe membership filter."""
    lst = F.array(*[F.lit(a).cast("string") for a in allowed])
    return actions.where(null_safe_contains(lst, F.col("action")))
