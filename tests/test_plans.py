"""Plan shapes that the scale design depends on (checked on the executed physical plans)."""

import re

from moments import at
from tidal import schemas
from tidal.functions.codec import decode_json, decode_json_report
from tidal.operators.join import user_action_join
from tidal.operators.pairing import pair_user_action
from tidal.operators.rules import rule_filter


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _pairing_frames(spark, n=2000):
    users = spark.createDataFrame([(f"u{i % 50}", f"n{i}", at(i), i) for i in range(0, n, 7)],
                                  "userId string, name string, ts timestamp_ntz, seq long")
    actions = spark.createDataFrame([(f"u{i % 50}", "go", at(i), i) for i in range(n) if i % 7],
                                    "userId string, action string, ts timestamp_ntz, seq long")
    return users, actions


def test_pairing_windows_are_per_block(spark):
    users, actions = _pairing_frames(spark)
    plain = executed(pair_user_action(users, actions, blocks=4))     # no hot user: one window pass
    assert "rangepartitioning" not in plain and "InMemoryTableScan" not in plain
    plan = executed(pair_user_action(users, actions, blocks=4, hot_key_rows=10))
    # hot users: range-cut into blocks, windows per (user, block). (Cold users keep a window per
    # user: their groups are bounded by the hot threshold.)
    assert "rangepartitioning" not in plan and "InMemoryTableScan" not in plan   # blocks are read as written
    windows = re.findall(r"windowspecdefinition\(([^,]+), ([^,]+),", plan)
    assert any(w[0].startswith("userId") and w[1].startswith("_blk") for w in windows)
    # the carry table is small and so is broadcast
    assert "BroadcastHashJoin" in plan


def test_rule_filter_does_not_shuffle_actions(spark):
    actions = spark.createDataFrame([(f"a{i}", "u", "p", at(i), i) for i in range(500)],
                                    "actionId string, userId string, action string, ts timestamp_ntz, seq long")
    rules = spark.createDataFrame([("r1", ["p"], at(0), 0), ("r2", ["q"], at(100), 1),
                                   ("r3", ["p"], at(300), 2)],
                                  "ruleId string, allowedActions array<string>, ts timestamp_ntz, seq long")
    plan = executed(rule_filter(actions, rules))
    assert "BroadcastHashJoin" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    # the intervals are read as written; the only exchange is their broadcast
    assert not re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan)


def test_decode_parses_once_per_row(spark):
    df = spark.createDataFrame([('{"userId":"a","action":"b"}',), ('{"x":1}',)], "value string")
    for out in [decode_json(df, schemas.ACTION)[0], decode_json(df, schemas.ACTION)[1],
                decode_json_report(df, schemas.ACTION)]:
        plan = executed(out)
        assert plan.count("from_json(") == 1, plan
        assert "Filter" not in plan


def test_salted_join_hot_list_joined_by_size(spark):
    u = spark.createDataFrame([("hot", "h"), ("c", "c")], schemas.USER)
    a = spark.createDataFrame([("hot", f"x{i}", i) for i in range(100)] + [("c", "y", 100)],
                              "userId string, action string, seq long")
    plan = executed(user_action_join(u, a, hot_key_rows=10, salt=4))
    # both sides join on (userId, _salt); the hot list is joined as AQE's size check decides
    assert re.search(r"Join \[userId#\d+, _salt#\d+\], \[userId#\d+, _salt#\d+\]", plan), plan


def test_streaming_rule_state_survives_restart(spark, tmpdir_path):
    from tidal.streaming.rules import rule_filter_stream
    from tidal.streaming.runner import run_to_table
    a_schema = "actionId string, userId string, action string, ts timestamp_ntz, seq long"
    r_schema = "ruleId string, allowedActions array<string>, ts timestamp_ntz, seq long"
    src_a, src_r = f"{tmpdir_path}/a", f"{tmpdir_path}/r"
    ck, out = f"{tmpdir_path}/ck", f"{tmpdir_path}/out"
    spark.createDataFrame([("r1", ["p"], at(1), 0)], r_schema).write.mode("append").parquet(src_r)
    spark.createDataFrame([("a0", "u", "p", at(0), 1)], a_schema).write.mode("append").parquet(src_a)

    def run():
        a = spark.readStream.schema(a_schema).parquet(src_a)
        r = spark.readStream.schema(r_schema).parquet(src_r)
        res = run_to_table(rule_filter_stream(a, r, shards=3), "restart", path=out, checkpoint=ck)
        return sorted(x.actionId for x in res.collect())

    assert run() == []                   # the action came before the rule
    spark.createDataFrame([("a1", "u", "p", at(5), 2), ("a2", "u", "q", at(6), 3)], a_schema) \
        .write.mode("append").parquet(src_a)
    assert run() == ["a1"]               # the rule held in state from the first run


def test_scale_conf_sizes_partitions():
    from tidal.session import scale_conf
    conf = scale_conf(100 << 40)                       # 100 TiB
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert scale_conf(1)["spark.sql.shuffle.partitions"] == "8"
