import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from moments import at
from sim import counts, simulate_rules
from tidal.operators.rules import rule_filter, rule_filter_single
from tidal.streaming.rules import rule_filter_stream
from tidal.streaming.runner import run_to_table

ACTIONS = "actionId string, userId string, action string, ts timestamp_ntz, seq long"
RULES = "ruleId string, allowedActions array<string>, ts timestamp_ntz, seq long"
METHODS = ["intervals", "blocks"]


def frames(spark, events):
    """events: ('r', ruleId, [allowed], t, seq) or ('a', actionId, action, t, seq)."""
    rules = [(i, p, at(t), s) for k, i, p, t, s in events if k == "r"]
    actions = [(i, "u1", p, at(t), s) for k, i, p, t, s in events if k == "a"]
    return spark.createDataFrame(actions, ACTIONS), spark.createDataFrame(rules, RULES)


def run(spark, events, method="auto", blocks=None):
    actions, rules = frames(spark, events)
    out = rule_filter(actions, rules, blocks=blocks, method=method)
    return counts((r.actionId, r.action, r.seq) for r in out.collect())


def expected(events):
    return counts(simulate_rules([(k, i, p, at(t), s) for k, i, p, t, s in events]))


CASES = [
    ("rule passes", [("r", "ruleId", ["logging-in"], 10, 1), ("a", "actionId", "logging-in", 20, 2)],
     ["actionId"]),
    ("rule blocks", [("r", "ruleId", ["logging-out"], 10, 1), ("a", "actionId", "logging-in", 20, 2)],
     []),
    ("action before rule", [("a", "a1", "p", 1, 1), ("r", "r", ["p"], 2, 2), ("a", "a2", "p", 3, 3)],
     ["a2"]),
    ("replaced rule", [("r", "R1", ["p"], 1, 1), ("a", "a1", "p", 2, 2), ("r", "R2", ["q"], 3, 3),
                       ("a", "a2", "p", 4, 4), ("a", "a3", "q", 5, 5)], ["a1", "a3"]),
    ("same time", [("a", "a1", "p", 5, 2), ("r", "R", ["p"], 5, 1)], ["a1"]),
    ("null action", [("r", "R", [None], 1, 1), ("a", "a1", None, 2, 2)], ["a1"]),
    ("empty list", [("r", "R", [], 1, 1), ("a", "a1", "p", 2, 2)], []),
    ("later rule at same time wins", [("r", "R1", ["p"], 1, 1), ("r", "R2", ["q"], 1, 2),
                                      ("a", "a1", "p", 2, 3), ("a", "a2", "q", 2, 4)], ["a2"]),
]


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("name,events,ids", CASES, ids=[c[0] for c in CASES])
def test_reference_cases(spark, name, events, ids, method):
    got = sorted(k[0] for k in run(spark, events, method))
    assert got == sorted(ids)


def test_passing_action_is_unchanged(spark):
    actions, rules = frames(spark, [("r", "id1", ["logged-in"], 1, 1), ("a", "x", "logged-in", 2, 2)])
    row = rule_filter(actions, rules).collect()[0]
    assert (row.actionId, row.userId, row.action, row.ts, row.seq) == ("x", "u1", "logged-in", at(2), 2)


def test_no_rules(spark):
    actions, rules = frames(spark, [("a", "a1", "p", 1, 1)])
    assert rule_filter(actions, rules).count() == 0


def test_single_rule_shortcut(spark):
    actions, _ = frames(spark, [("a", "a1", "p", 1, 1), ("a", "a2", None, 2, 2), ("a", "a3", "q", 3, 3)])
    got = sorted(r.actionId for r in rule_filter_single(actions, ["p", None]).collect())
    assert got == ["a1", "a2"]


rule_ev = st.tuples(st.just("r"), st.lists(st.sampled_from(["p", "q", "r", None]), max_size=3),
                    st.integers(0, 30))
act_ev = st.tuples(st.just("a"), st.sampled_from(["p", "q", "r", None]), st.integers(0, 30))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(rule_ev, act_ev), max_size=40), st.sampled_from(METHODS),
       st.sampled_from([1, 3, 8]))
def test_matches_simulation(spark, evs, method, blocks):
    events = [(k, f"{k}{i}", p, t, i) for i, (k, p, t) in enumerate(evs)]
    assert run(spark, events, method, blocks) == expected(events)


def test_many_rules_many_buckets(spark):
    # rules every 7 s, actions every 3 s: many intervals and buckets
    events, seq = [], 0
    names = ["p", "q", "r", "s"]
    for t in range(0, 3000, 7):
        events.append(("r", f"r{t}", [names[t % 4], names[(t // 7) % 4]], t, seq))
        seq += 1
    for t in range(0, 3100, 3):
        events.append(("a", f"a{t}", names[(t // 3) % 4], t, seq))
        seq += 1
    exp = expected(events)
    assert run(spark, events, "intervals") == exp
    assert run(spark, events, "blocks", 8) == exp


def test_stream_matches_simulation(spark, tmpdir_path):
    events, seq = [], 0
    for t in range(0, 400, 37):
        events.append(("r", f"r{t}", [["p"], ["q", "r"], [None, "p"]][t % 3], t, seq))
        seq += 1
    for t in range(0, 420, 2):
        events.append(("a", f"a{t}", ["p", "q", "r", None][t % 4], t, seq))
        seq += 1
    actions, rules = frames(spark, events)
    actions.coalesce(1).write.parquet(f"{tmpdir_path}/actions")
    rules.coalesce(1).write.parquet(f"{tmpdir_path}/rules")
    a = spark.readStream.schema(ACTIONS).parquet(f"{tmpdir_path}/actions")
    r = spark.readStream.schema(RULES).parquet(f"{tmpdir_path}/rules")
    out = run_to_table(rule_filter_stream(a, r, shards=4), "rules-test")
    assert counts((x.actionId, x.action, x.seq) for x in out.collect()) == expected(events)


def test_interval_join_ignores_session_time_zone(spark):
    events = [("r", "R1", ["p"], 0, 0), ("r", "R2", ["q"], 7200, 1)]
    events += [("a", f"a{t}", "p" if t % 2 else "q", t, 10 + t) for t in range(0, 9000, 450)]
    exp = expected(events)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert run(spark, events, "intervals") == exp
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("method", METHODS)
def test_initial_rule_applies_before_first_rule(spark, method):
    events = [("a", "a1", "p", 1, 1), ("a", "a2", "q", 2, 2), ("r", "R", ["q"], 3, 3),
              ("a", "a3", "p", 4, 4), ("a", "a4", "q", 5, 5)]
    actions, rules = frames(spark, events)
    got = sorted(r.actionId for r in rule_filter(actions, rules, method=method,
                                                 initial=("held", ["p"])).collect())
    assert got == ["a1", "a4"]
    no_rules = rules.where("false")
    assert sorted(r.actionId for r in rule_filter(actions, no_rules, method=method,
                                                  initial=("held", ["q"])).collect()) == ["a2", "a4"]


def test_microbatch_stream_carries_rule_across_batches(spark, tmpdir_path):
    from tidal.streaming.rules import rule_filter_microbatch
    src_a, src_r, out, ck = (f"{tmpdir_path}/{x}" for x in ("a", "r", "out", "ck"))
    spark.createDataFrame([("r1", ["p"], at(1), 0)], RULES).write.mode("append").parquet(src_r)
    spark.createDataFrame([("a0", "u", "p", at(0), 1), ("a1", "u", "p", at(2), 2)], ACTIONS) \
        .write.mode("append").parquet(src_a)

    def run():
        a = spark.readStream.schema(ACTIONS).parquet(src_a)
        r = spark.readStream.schema(RULES).parquet(src_r)
        q = rule_filter_microbatch(a, r, out, checkpoint=ck, name="mb_test")
        q.awaitTermination(120)
        assert q.exception() is None
        return sorted(x.actionId for x in spark.read.parquet(out).collect())

    assert run() == ["a1"]                     # a0 came before the rule
    # a later batch: an action takes the rule as of its own time, whichever batch brought the rule
    spark.createDataFrame([("a2", "u", "p", at(5), 3), ("late", "u", "p", at(0), 4), ("a3", "u", "q", at(9), 5)], ACTIONS) \
        .write.mode("append").parquet(src_a)
    spark.createDataFrame([("r2", ["q"], at(8), 4)], RULES).write.mode("append").parquet(src_r)
    assert run() == ["a1", "a2", "a3"]


def test_uneven_rule_times_fall_back_to_blocks(spark):
    # one rule far in the past makes span-sized buckets hold every other interval
    events = [("r", "old", ["p"], 0, 0)]
    events += [("r", f"r{t}", [["p"], ["q"]][t % 2], 10**8 + t, t + 1) for t in range(200)]
    events += [("a", f"a{t}", ["p", "q"][t % 2], 10**8 + t, 1000 + t) for t in range(0, 210, 3)]
    exp = expected(events)
    assert run(spark, events, "auto") == exp
    assert run(spark, events, "intervals") == exp


@pytest.mark.parametrize("method", METHODS)
def test_zoned_timestamps(spark, method):
    events = [("r", "R1", ["p"], 0, 0), ("a", "a1", "p", 5, 1), ("r", "R2", ["q"], 100, 2),
              ("a", "a2", "p", 150, 3), ("a", "a3", "q", 200, 4), ("r", "R3", ["p", "q"], 300, 5),
              ("a", "a4", "q", 400, 6)]
    actions, rules = frames(spark, events)
    actions = actions.withColumn("ts", actions["ts"].cast("timestamp"))
    rules = rules.withColumn("ts", rules["ts"].cast("timestamp"))
    got = sorted(r.actionId for r in rule_filter(actions, rules, method=method).collect())
    assert got == ["a1", "a3", "a4"]
