"""The streams that run the batch operators on each micro-batch: many batches, restarts, failures, hot ids."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moments import at
from sim import counts, simulate_pairing, simulate_rules
from tidal.streaming import batchlog
from tidal.streaming.batchlog import BatchLog, fixed_setting
from tidal.streaming.join import user_action_join_microbatch
from tidal.streaming.pairing import _latest, cells_log, pair_microbatch
from tidal.streaming.rules import rule_filter_microbatch

EVENTS = "userId string, _rank int, ts timestamp_ntz, seq long, name string, action string"
ACTIONS = "actionId string, userId string, action string, ts timestamp_ntz, seq long"
RULES = "ruleId string, allowedActions array<string>, ts timestamp_ntz, seq long"


def files(spark, parts, schema, path):
    """One file per part, in order; the stream takes one per micro-batch."""
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(path)


def drained(q):
    q.awaitTermination(300)
    if q.exception() is not None:
        raise q.exception()


def split(rows, n):
    size = -(-len(rows) // n)
    return [rows[i:i + size] for i in range(0, len(rows), size)]


def some_events(n, users, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kind = rng.random() < 0.3
        text = rng.choice(["p", "q", None, f"x{i}"])
        out.append((rng.choice(users), 0 if kind else 1, at(i // 3), i, text if kind else None, None if kind else text))
    return sorted(out, key=lambda e: (e[2], e[1], e[3]))


def expected_pairs(events):
    return counts(simulate_pairing([(u, "u" if k == 0 else "a", n if k == 0 else a, ts, s) for u, k, ts, s, n, a in events]))


@pytest.mark.parametrize("hot", [None, 5])
def test_pairing_over_many_batches(spark, tmpdir_path, hot):
    """Eleven batches with merges of three, a third of the rows of one user; with ``hot``, through ordered blocks."""
    events = some_events(400, ["hot"] * 3 + ["a", "b", "c", None, "d", "e"])
    ev = files(spark, split(events, 11), EVENTS, f"{tmpdir_path}/in")
    q = pair_microbatch(ev, f"{tmpdir_path}/out", f"{tmpdir_path}/ck", every=3, hot_key_rows=hot, blocks=4 if hot else None)
    drained(q)
    got = [(r.userId, r.name, r.action, r.seq) for r in spark.read.parquet(f"{tmpdir_path}/out").collect()]
    assert counts(got) == expected_pairs(events)
    # the cells left behind are those of the state machine
    left = {r.userId: (r.name if r.has_user else None, r.action if r.has_action else None)
            for r in _latest(cells_log(f"{tmpdir_path}/ck", 3).before(spark, 11), whole=True).collect()}
    user, waiting = {}, {}
    for u, k, _, _, name, action in events:
        if u is None:
            continue
        if k == 0:
            if u in waiting:
                waiting.pop(u)
            else:
                user[u] = name
        elif u not in user:
            waiting[u] = action
    assert left == {u: (user.get(u), waiting.get(u)) for u in {*user, *waiting}}


def test_pairing_survives_a_failure_in_a_merge(spark, tmpdir_path, monkeypatch):
    """A step that dies after its output, in the middle of a merge, is run again: equal files, nothing lost or doubled."""
    events = some_events(200, ["a", "b", "c"], seed=5)
    parts = split(events, 6)
    path, ck = f"{tmpdir_path}/in", f"{tmpdir_path}/ck"
    plain = BatchLog._write
    state = {"fail": True}

    def failing(self, df, target):
        if state["fail"] and "level=1" in target:
            state["fail"] = False
            df.limit(1).write.mode("overwrite").parquet(target)         # half a merge
            raise RuntimeError("lost in the merge")
        plain(self, df, target)
    monkeypatch.setattr(BatchLog, "_write", failing)
    ev = files(spark, parts, EVENTS, path)
    q = pair_microbatch(ev, f"{tmpdir_path}/out", ck, every=2)
    with pytest.raises(Exception, match="lost in the merge"):
        drained(q)
    drained(pair_microbatch(ev, f"{tmpdir_path}/out", ck, every=5))     # the first ``every`` stays
    got = [(r.userId, r.name, r.action, r.seq) for r in spark.read.parquet(f"{tmpdir_path}/out").collect()]
    assert counts(got) == expected_pairs(events)


def test_equal_times_on_two_partitions(spark, tmpdir_path):
    """Records of one time stand by topic, partition and offset, in batch and on streams alike."""
    from tidal.operators.pairing import pair_tagged
    from tidal.streaming.pairing import pair_tagged_stream
    from tidal.streaming.runner import run_to_table
    schema = "userId string, _rank int, ts timestamp_ntz, topic string, partition int, seq long, name string, action string"
    rng = random.Random(3)
    rows = [(rng.choice("ab"), 1 if i % 4 else 0, at(0), "actions" if i % 4 else "users", i % 3, i // 3,
             None if i % 4 else f"n{i}", f"x{i}" if i % 4 else None) for i in range(40)]
    order = sorted(rows, key=lambda r: (r[1], r[3], r[4], r[5]))
    want = counts(simulate_pairing([(r[0], "u" if r[1] == 0 else "a", r[6] if r[1] == 0 else r[7], r[2], k) for k, r in enumerate(order)]))
    place = {(r[3], r[4], r[5]): k for k, r in enumerate(order)}
    rng.shuffle(rows)
    batch = spark.createDataFrame(rows, schema)
    batch.write.parquet(f"{tmpdir_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"{tmpdir_path}/in")
    drained(pair_microbatch(stream, f"{tmpdir_path}/out", f"{tmpdir_path}/ck"))
    for out in (pair_tagged(batch), pair_tagged(batch, blocks=3, hot_key_rows=2), spark.read.parquet(f"{tmpdir_path}/out"),
                run_to_table(pair_tagged_stream(stream), "places")):
        got = [(r.userId, r.name, r.action, place[(r.topic, r.partition, r.seq)]) for r in out.collect()]
        assert counts(got) == want


def some_rules(n, seed):
    rng = random.Random(seed)
    return [(f"r{i}", rng.choice([["p"], ["q"], ["p", "q", None], [], None]), at(rng.randrange(60)), i) for i in range(n)]


def expected_kept(actions, rules):
    events = sorted([("r", r, a, ts, s) for r, a, ts, s in rules] + [("a", i, a, ts, s) for i, _, a, ts, s in actions],
                    key=lambda e: (e[3], 0 if e[0] == "r" else 1, e[4]))
    return counts(simulate_rules(events))


def test_rules_over_many_batches(spark, tmpdir_path):
    """Rules of nine batches in any order of time; the actions come later, so all rules are known to them."""
    rules = some_rules(60, 2)
    rng = random.Random(7)
    actions = [(f"a{i}", "u", rng.choice(["p", "q", None]), at(rng.randrange(70)), 1000 + i) for i in range(200)]
    r = files(spark, split(rules, 9), RULES, f"{tmpdir_path}/r")
    a = files(spark, [[]] * 9 + split(actions, 5), ACTIONS, f"{tmpdir_path}/a")
    drained(rule_filter_microbatch(a, r, f"{tmpdir_path}/out", f"{tmpdir_path}/ck", every=2))
    got = [(x.actionId, x.action, x.seq) for x in spark.read.parquet(f"{tmpdir_path}/out").collect()]
    assert counts(got) == expected_kept(actions, rules)


def test_rules_read_are_those_of_the_actions_times(spark, tmpdir_path):
    """A batch's reading doesn't grow with the batches before it: folders by level, rules by time."""
    rules = [(f"r{i}", ["p"], at(i), i) for i in range(600)]
    schema = T._parse_datatype_string(RULES + ", next_ts timestamp_ntz")
    from tidal.streaming.rules import _timed
    log = BatchLog(f"{tmpdir_path}/log", schema, 3, merge=_timed)
    for n, part in enumerate(split(rules, 20)):
        log.append(_timed(spark.createDataFrame(part, RULES)), n)
        assert len(log.cover(n + 1)) <= 2 * 4
    held = log.before(spark, 20).where((F.col("ts") <= F.lit("2024-01-01 00:05:03").cast("timestamp_ntz"))
                                       & (F.col("next_ts").isNull() | (F.col("next_ts") > F.lit("2024-01-01 00:05:00").cast("timestamp_ntz"))))
    found = sorted(r.seq for r in held.collect())
    assert {300, 301, 302, 303} <= set(found) and len(found) <= 4 + len(log.cover(20))
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "LessThanOrEqual(ts" in plan


@pytest.mark.parametrize("n", [0, 1, 2, 500])
def test_intervals_from_blocks(spark, n):
    """``next_ts`` from several blocks is that of one sorted list, equal times and all."""
    from tidal.operators.rules import with_next
    rng = random.Random(n)
    rules = [(f"r{i}", ["p"], at(rng.randrange(1 + n // 3)), i) for i in range(n)]
    got = {r.ruleId: r.next_ts for r in with_next(spark.createDataFrame(rules, RULES), n, per_block=70).collect()}
    order = sorted(rules, key=lambda r: (r[2], r[3]))
    assert got == {r[0]: (after[2] if after else None) for r, after in zip(order, [*order[1:], None])}


def test_delta_join_over_many_batches(spark, tmpdir_path):
    """Users and actions in any order over seven batches, a third of the rows of one id, repeated rows on either side."""
    rng = random.Random(4)
    ids = ["hot"] * 4 + [f"u{i}" for i in range(8)] + [None]
    users = [(rng.choice(ids), rng.choice(["n", None, f"n{i}"])) for i in range(60)]
    actions = [(rng.choice(ids), rng.choice(["p", None]), i % 50) for i in range(180)]
    u = files(spark, split(users, 7), "userId string, name string", f"{tmpdir_path}/u")
    a = files(spark, split(actions, 7), "userId string, action string, seq long", f"{tmpdir_path}/a")
    drained(user_action_join_microbatch(u, a, f"{tmpdir_path}/out", ("seq",), f"{tmpdir_path}/ck", every=2, buckets=4))
    got = counts([(r.userId, r.name, r.action, r.seq) for r in spark.read.parquet(f"{tmpdir_path}/out").collect()])
    assert got == counts([(i, n, x, s) for i, n in users for j, x, s in actions if i is not None and i == j])


def test_log_covers_every_batch_once(spark, tmpdir_path):
    schema = T._parse_datatype_string("n long")
    log = BatchLog(f"{tmpdir_path}/log", schema, 3)
    for n in range(14):
        log.append(spark.createDataFrame([(n,)], schema).coalesce(1), n)
        assert sorted(r.n for r in log.before(spark, n + 1).collect()) == list(range(n + 1))
    assert log.before(spark, 0).count() == 0
    assert fixed_setting(spark, f"{tmpdir_path}/s", 4) == 4 == fixed_setting(spark, f"{tmpdir_path}/s", 9)
    with pytest.raises(ValueError):
        batchlog.BatchLog(f"{tmpdir_path}/x", schema, 1)
