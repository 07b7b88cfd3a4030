import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moments import at
from sim import counts, simulate_pairing
from tidal.operators.blocks import BLOCK, ordered_blocks
from tidal.operators.pairing import ORDER, _tagged, pair_user_action
from tidal.streaming.pairing import pair_user_action_stream
from tidal.streaming.runner import run_to_table

USERS = "userId string, name string, ts timestamp_ntz, seq long"
ACTIONS = "userId string, action string, ts timestamp_ntz, seq long"


def frames(spark, events):
    """events: (userId, 'u'|'a', value, ts_seconds, seq)."""
    users = [(u, v, at(t), s) for u, k, v, t, s in events if k == "u"]
    actions = [(u, v, at(t), s) for u, k, v, t, s in events if k == "a"]
    return spark.createDataFrame(users, USERS), spark.createDataFrame(actions, ACTIONS)


def run_batch(spark, events, blocks=None, hot=None):
    users, actions = frames(spark, events)
    out = pair_user_action(users, actions, blocks=blocks, hot_key_rows=hot)
    return counts((r.userId, r.name, r.action, r.seq) for r in out.collect())


def expected(events):
    return counts(simulate_pairing([(u, k, v, at(t), s) for u, k, v, t, s in events]))


# (name, events in order, expected (name, action) pairs) -- one key "k" unless noted
CASES = [
    ("user then action", [("id1", "u", "name1", 10, 1), ("id1", "a", "logged-in", 10, 2)],
     [("name1", "logged-in")]),
    ("action first", [("k", "a", "x", 1, 1), ("k", "u", "n", 2, 2)], [("n", "x")]),
    ("overwritten action", [("k", "a", "p", 1, 1), ("k", "a", "q", 2, 2), ("k", "u", "n", 3, 3)],
     [("n", "q")]),
    ("forgotten user", [("k", "a", "p", 1, 1), ("k", "u", "n", 2, 2), ("k", "a", "r", 3, 3)],
     [("n", "p")]),
    ("forgotten user, second user",
     [("k", "a", "p", 1, 1), ("k", "u", "n", 2, 2), ("k", "a", "r", 3, 3), ("k", "u", "m", 4, 4)],
     [("n", "p"), ("m", "r")]),
    ("latest user", [("k", "u", "n", 1, 1), ("k", "u", "m", 2, 2), ("k", "a", "x", 3, 3)],
     [("m", "x")]),
    ("user kept", [("k", "u", "n", 1, 1), ("k", "a", "x", 2, 2), ("k", "a", "y", 3, 3)],
     [("n", "x"), ("n", "y")]),
    ("two keys", [("k1", "u", "n", 1, 1), ("k2", "a", "x", 2, 2)], []),
    ("null name", [("k", "u", None, 1, 1), ("k", "a", "x", 2, 2)], [(None, "x")]),
]


@pytest.mark.parametrize("name,events,pairs", CASES, ids=[c[0] for c in CASES])
def test_reference_cases(spark, name, events, pairs):
    users, actions = frames(spark, events)
    got = sorted(((r.name, r.action) for r in pair_user_action(users, actions).collect()),
                 key=str)
    assert got == sorted(pairs, key=str)


def test_output_carries_trigger_time(spark):
    users, actions = frames(spark, [("id1", "u", "name1", 10, 1), ("id1", "a", "logged-in", 20, 2)])
    rows = pair_user_action(users, actions).collect()
    assert [(r.userId, r.name, r.action, r.ts, r.seq) for r in rows] == [
        ("id1", "name1", "logged-in", at(20), 2)]


def test_null_user_ids_dropped(spark):
    events = [(None, "u", "n", 1, 1), (None, "a", "x", 2, 2)]
    assert run_batch(spark, events) == {}


event = st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.sampled_from(["u", "a"]),
                  st.sampled_from(["p", "q", "r", None]), st.integers(0, 6))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(event, max_size=40), st.sampled_from([1, 3, 8]), st.sampled_from([None, 1, 4]))
def test_matches_simulation(spark, evs, blocks, hot):
    # hot=1 / 4: users with more rows take the ordered-block path; None: every user is cold here
    events = [(u, k, v, t, i) for i, (u, k, v, t) in enumerate(evs)]
    assert run_batch(spark, events, blocks=blocks, hot=hot) == expected(events)


def hot_user_events(n_hot=3000, n_cold=300):
    """One user with most rows (split over every block), plus cold users."""
    ev, seq = [], 0
    pattern = ["a", "a", "u", "a", "u", "u", "a", "a", "a", "u", "a"]
    for i in range(n_hot):
        k = pattern[(i * 7 + i // 13) % len(pattern)]
        ev.append(("hot", k, f"v{i % 17}", i // 3, seq))
        seq += 1
    for i in range(n_cold):
        ev.append((f"c{i % 40}", "u" if i % 5 == 0 else "a", f"w{i}", i, seq))
        seq += 1
    return ev


def test_blocks_need_no_cache(spark):
    events = hot_user_events(400, 60)
    users, actions = frames(spark, events)
    out = pair_user_action(users, actions, blocks=5, hot_key_rows=100)
    spark.catalog.clearCache()
    assert counts((r.userId, r.name, r.action, r.seq) for r in out.collect()) == expected(events)
    assert run_batch(spark, events, blocks=5, hot=100) == expected(events)


def test_hot_user_is_split_and_exact(spark):
    events = hot_user_events()
    users, actions = frames(spark, events)
    blocked = ordered_blocks(_tagged(users, actions), ORDER, keys=["userId"], blocks=8)
    per_block = blocked.where(F.col("userId") == "hot").groupBy(BLOCK).count().collect()
    assert len(per_block) >= 6                        # the hot key spans most blocks
    assert max(r["count"] for r in per_block) < 3000 / 3
    assert run_batch(spark, events, blocks=8, hot=3300 // 32) == expected(events)
    assert run_batch(spark, events, blocks=8) == expected(events)      # below the floor: one pass


def _write_events(spark, events, path):
    users = [(u, "u", v, None, at(t), s) for u, k, v, t, s in events if k == "u"]
    actions = [(u, "a", None, v, at(t), s) for u, k, v, t, s in events if k == "a"]
    spark.createDataFrame(users + actions, "userId string, kind string, name string, "
                          "action string, ts timestamp_ntz, seq long").coalesce(1) \
        .write.mode("append").parquet(path)


def _stream_pairs(spark, src, checkpoint=None, out=None):
    schema = "userId string, kind string, name string, action string, ts timestamp_ntz, seq long"
    s = spark.readStream.schema(schema).parquet(src)
    users = s.where("kind = 'u'").select("userId", "name", "ts", "seq")
    actions = s.where("kind = 'a'").select("userId", "action", "ts", "seq")
    res = run_to_table(pair_user_action_stream(users, actions), "pairing-test",
                       path=out, checkpoint=checkpoint)
    return counts((r.userId, r.name, r.action, r.seq) for r in res.collect())


def test_stream_matches_batch_and_simulation(spark, tmpdir_path):
    events = hot_user_events(600, 200)
    _write_events(spark, events, f"{tmpdir_path}/in")
    assert _stream_pairs(spark, f"{tmpdir_path}/in") == expected(events) == run_batch(spark, events, 4, 100)


def test_stream_state_survives_restart(spark, tmpdir_path):
    first = [("k", "u", "n", 1, 1)]
    second = [("k", "a", "x", 2, 2), ("j", "a", "p", 3, 3)]
    third = [("j", "u", "m", 4, 4)]
    src, ck, out = f"{tmpdir_path}/in", f"{tmpdir_path}/ck", f"{tmpdir_path}/out"
    _write_events(spark, first, src)
    assert _stream_pairs(spark, src, ck, out) == {}
    _write_events(spark, second, src)
    assert _stream_pairs(spark, src, ck, out) == {("k", "n", "x", 2): 1}
    _write_events(spark, third, src)
    assert _stream_pairs(spark, src, ck, out) == {("k", "n", "x", 2): 1, ("j", "m", "p", 4): 1}


def test_stream_output_times_match_batch(spark, tmpdir_path):
    events = hot_user_events(200, 80)
    _write_events(spark, events, f"{tmpdir_path}/in")
    schema = "userId string, kind string, name string, action string, ts timestamp_ntz, seq long"
    s = spark.readStream.schema(schema).parquet(f"{tmpdir_path}/in")
    users = s.where("kind = 'u'").select("userId", "name", "ts", "seq")
    actions = s.where("kind = 'a'").select("userId", "action", "ts", "seq")
    streamed = run_to_table(pair_user_action_stream(users, actions), "pairing-ts")
    u, a = frames(spark, events)
    batch = pair_user_action(u, a)
    assert sorted((r.seq, r.ts) for r in streamed.collect()) == sorted(
        (r.seq, r.ts) for r in batch.collect())
    assert spark.conf.get("spark.sql.session.timeZone")


def test_stream_with_zoned_timestamps(spark, tmpdir_path):
    events = [("k", "a", "p", 1, 1), ("k", "u", "n", 2, 2), ("k", "u", "m", 3, 3),
              ("k", "a", "x", 4, 4), ("j", "u", "o", 1, 5), ("j", "a", "y", 2, 6)]
    _write_events(spark, events, f"{tmpdir_path}/in")
    schema = "userId string, kind string, name string, action string, ts timestamp, seq long"
    s = spark.readStream.schema(schema).parquet(f"{tmpdir_path}/in")
    users = s.where("kind = 'u'").select("userId", "name", "ts", "seq")
    actions = s.where("kind = 'a'").select("userId", "action", "ts", "seq")
    zoned = pair_user_action_stream(users, actions)
    out = run_to_table(zoned.withColumn("ts", zoned["ts"].cast("timestamp")), "pairing-zoned")
    assert counts((r.userId, r.name, r.action, r.seq) for r in out.collect()) == expected(events)
