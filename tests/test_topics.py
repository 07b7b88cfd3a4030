import json

import pytest

from moments import at
from tidal import schemas
from tidal.plans import enrich_topology, rule_gate_topology, table_join_topology
from tidal.sources.topics import (kafka_sink_options, kafka_source_options, read_json_topic,
                                  read_topic, write_topic)


def test_kafka_option_maps():
    assert kafka_source_options("b:9092", "t") == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "t", "startingOffsets": "earliest"}
    bounded = kafka_source_options("b:9092", "t", bounded=True, read_committed=True)
    assert bounded["endingOffsets"] == "latest"
    assert bounded["kafka.isolation.level"] == "read_committed"
    assert kafka_sink_options("b:9092", "out") == {"kafka.bootstrap.servers": "b:9092", "topic": "out"}


def test_kafka_connector_missing_is_reported(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic(spark, "t", "localhost:1").collect()


def put(spark, root, topic, records, fmt="json"):
    """Append JSON records (dicts or raw strings) with explicit times/offsets to a file topic."""
    rows = [(None, r if isinstance(r, str) else json.dumps(r, separators=(",", ":")), at(t), s)
            for r, t, s in records]
    df = spark.createDataFrame(rows, "key string, value string, ts timestamp_ntz, seq long")
    write_topic(df, topic, fmt=fmt, root=root)


def values(spark, root, topic, fmt="json"):
    return sorted(r.value for r in read_topic(spark, topic, fmt=fmt, root=root, decode="string")
                  .collect())


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_file_topic_round_trip_and_decode(spark, tmpdir_path, fmt):
    put(spark, tmpdir_path, "in", [({"userId": "u", "name": "n"}, 1, 0), ("{broken", 2, 1),
                                   ({"userId": "v", "nick": "x"}, 3, 2)], fmt)
    assert len(values(spark, tmpdir_path, "in", fmt)) == 3
    acc, rej = read_json_topic(spark, schemas.USER, "in", fmt=fmt, root=tmpdir_path, streaming=False)
    assert [(r.userId, r.name, r.seq) for r in acc.collect()] == [("u", "n", 0)]
    assert sorted(r.reason for r in rej.collect()) == ["not a JSON object", "unknown field"]


def _drain(q):
    q.awaitTermination(120)
    assert q.exception() is None


@pytest.mark.parametrize("streaming", [True, False])
def test_enrich_json_in_json_out(spark, tmpdir_path, streaming):
    put(spark, tmpdir_path, "users", [({"userId": "id1", "name": "name1"}, 10, 0)])
    put(spark, tmpdir_path, "actions", [({"userId": "id1", "action": "logged-in"}, 20, 0),
                                        ("not json", 21, 1)])
    q = enrich_topology(spark, fmt="json", root=tmpdir_path, streaming=streaming,
                        available_now=True)
    if streaming:
        _drain(q)
    out = values(spark, tmpdir_path, "user-actions")
    assert out == ['{"userId":"id1","name":"name1","action":"logged-in"}']


@pytest.mark.parametrize("streaming", [True, False])
def test_table_join_json_in_json_out(spark, tmpdir_path, streaming):
    put(spark, tmpdir_path, "users", [({"userId": "userId1", "name": "name1"}, 1, 0)])
    put(spark, tmpdir_path, "actions", [({"userId": "userId1", "action": "logged-in"}, 2, 0)])
    q = table_join_topology(spark, replace=True, fmt="json", root=tmpdir_path, streaming=streaming,
                            available_now=True)
    if streaming:
        _drain(q)
    assert values(spark, tmpdir_path, "user-actions") == [
        '{"userId":"userId1","name":"name1","action":"logged-in"}']


@pytest.mark.parametrize("streaming", [True, False])
def test_rule_gate_json_in_json_out(spark, tmpdir_path, streaming):
    put(spark, tmpdir_path, "rules", [({"ruleId": "id1", "allowedActions": ["logged-in"]}, 1, 0),
                                      ({"ruleId": "bad"}, 1, 1)])
    put(spark, tmpdir_path, "actions", [
        ({"actionId": "a1", "userId": "id1", "action": "logged-in"}, 2, 0),
        ({"actionId": "a2", "userId": "id1", "action": "logged-out"}, 3, 1)])
    q = rule_gate_topology(spark, fmt="json", root=tmpdir_path, streaming=streaming,
                           available_now=True, shards=2)
    if streaming:
        _drain(q)
    assert values(spark, tmpdir_path, "actions-filtered") == [
        '{"actionId":"a1","userId":"id1","action":"logged-in"}']


def test_micro_batches_bounded_by_files(spark, tmpdir_path):
    from tidal.streaming.runner import run_stream
    for i in range(3):
        put(spark, tmpdir_path, "in", [({"userId": f"u{i}", "name": "n"}, i, i)], fmt="parquet")
    acc, _ = read_json_topic(spark, schemas.USER, "in", fmt="parquet", root=tmpdir_path,
                             streaming=True, max_per_trigger=1)
    q = run_stream(acc, "bounded", path=f"{tmpdir_path}/out")
    q.awaitTermination(120)
    assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]] == [1, 1, 1]


def test_command_line_tools(spark, tmpdir_path, capsys):
    from tidal.__main__ import main
    io = ["--fmt", "json", "--root", tmpdir_path]
    main(["write-record", "users", "k1", '{"userId":"id1","name":"name1"}', *io], spark=spark)
    main(["write-record", "actions", "k2", '{"userId":"id1","action":"go"}', *io], spark=spark)
    main(["read-topic", "users", *io], spark=spark)
    assert "name1" in capsys.readouterr().out
    main(["table-join", "--batch", *io], spark=spark)
    assert values(spark, tmpdir_path, "user-actions") == [
        '{"userId":"id1","name":"name1","action":"go"}']


def test_command_line_stream_drains(spark, tmpdir_path):
    from tidal.__main__ import main
    io = ["--fmt", "json", "--root", tmpdir_path]
    put(spark, tmpdir_path, "rules", [({"ruleId": "r", "allowedActions": ["go"]}, 1, 0)])
    put(spark, tmpdir_path, "actions", [({"actionId": "a1", "userId": "u", "action": "go"}, 2, 0),
                                        ({"actionId": "a2", "userId": "u", "action": "stop"}, 3, 1)])
    assert main(["rule-gate", "--available-now", "--shards", "2", "--max-per-trigger", "1", *io],
                spark=spark) == 0
    assert values(spark, tmpdir_path, "actions-filtered") == [
        '{"actionId":"a1","userId":"u","action":"go"}']


def test_output_topics_carry_the_triggers_time_and_place(spark, tmpdir_path):
    """One topology's output is read by another in the order of its triggers, in a zone with clock changes."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        from pyspark.sql import functions as F
        from tidal.plans.topologies import enrich_topology
        from tidal.sources.topics import utc_ntz, write_topic
        rows = [('{"userId":"1","name":"n"}', "users", 1_699_163_940, 0),            # 05:59 and 06:01 UTC, where
                ('{"userId":"1","action":"a"}', "actions", 1_699_163_940, 1),        # local time goes back an hour
                ('{"userId":"1","action":"b"}', "actions", 1_699_164_060, 2)]
        for value, topic, seconds, seq in rows:
            df = spark.createDataFrame([(None, value, seconds, seq)], "key string, value string, s long, seq long")
            write_topic(df.withColumn("ts", F.timestamp_seconds("s")), topic, fmt="parquet", root=tmpdir_path)
        for streaming in (False, True):
            out = f"out-{streaming}"
            q = enrich_topology(spark, fmt="parquet", root=tmpdir_path, streaming=streaming, available_now=True, out_topic=out)
            if q is not None:
                q.awaitTermination()
            got = spark.read.parquet(f"{tmpdir_path}/{out}").orderBy("ts", "seq").collect()
            assert [(r.value.count('"a"'), r.seq) for r in got] == [(1, 1), (0, 2)]
            assert (got[1].ts - got[0].ts).total_seconds() == 120 and got[0].ts.hour == 5
        assert spark.range(1).select(utc_ntz(F.timestamp_seconds(F.lit(0)))).first()[0].year == 1970
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("streaming", [True, False])
def test_rejects_have_a_topic_with_reason_place_and_text(spark, tmpdir_path, streaming):
    """Each record set aside comes out once, with its reason, position and raw text; the rest goes on."""
    put(spark, tmpdir_path, "users", [({"userId": "u", "name": "n"}, 1, 0), ("{broken", 2, 7), ({"userId": "v", "nick": "x"}, 3, 8)])
    put(spark, tmpdir_path, "actions", [({"userId": "u", "action": "go"}, 4, 0), ("  ", 5, 9), ('{"userId":{"a":1},"action":"x"}', 6, 10)])
    q = enrich_topology(spark, fmt="json", root=tmpdir_path, streaming=streaming, available_now=True)
    if streaming:
        _drain(q)
        seen = [p.observedMetrics["decoded"] for p in q.recentProgress if p.observedMetrics]
        assert sum(m["records"] for m in seen) == 6
        assert sum(m["empty text"] for m in seen) == 1 and sum(m["unknown field"] for m in seen) == 1
    assert values(spark, tmpdir_path, "user-actions") == ['{"userId":"u","name":"n","action":"go"}']
    got = sorted((r["topic"], r["position"], r["reason"], r["value"]) for r in map(json.loads, values(spark, tmpdir_path, "rejected")))
    assert got == [("actions", 9, "empty text", "  "),
                   ("actions", 10, "object or array in a text field", '{"userId":{"a":1},"action":"x"}'),
                   ("users", 7, "not a JSON object", "{broken"),
                   ("users", 8, "unknown field", '{"userId":"v","nick":"x"}')]


@pytest.mark.parametrize("name", ["join", "gate"])
def test_rejects_of_the_other_topologies(spark, tmpdir_path, name):
    put(spark, tmpdir_path, "users", [({"userId": "u", "name": "n"}, 1, 0), ("[1]", 2, 3)])
    put(spark, tmpdir_path, "rules", [({"ruleId": "r", "allowedActions": ["go"]}, 1, 0), ({"ruleId": "s"}, 2, 3)])
    record = {"userId": "u", "action": "go"} | ({"actionId": "a"} if name == "gate" else {})
    put(spark, tmpdir_path, "actions", [(record, 3, 1), ("x", 4, 5)])
    run = {"fmt": "json", "root": tmpdir_path, "available_now": True}
    for streaming in (True, False):
        out, bad = f"out-{streaming}", f"bad-{streaming}"
        q = (table_join_topology(spark, streaming=streaming, replace=True, out_topic=out, reject_topic=bad, **run) if name == "join"
             else rule_gate_topology(spark, streaming=streaming, out_topic=out, reject_topic=bad, **run))
        if q is not None:
            _drain(q)
        assert len(values(spark, tmpdir_path, out)) == 1
        got = sorted((r["topic"], r["position"], r["reason"]) for r in map(json.loads, values(spark, tmpdir_path, bad)))
        assert got == [("actions", 5, "not a JSON object"),
                       ("users", 3, "not a JSON object") if name == "join" else ("rules", 3, "required field missing")]


def test_keyed_state_topologies(spark, tmpdir_path):
    put(spark, tmpdir_path, "users", [({"userId": "u", "name": "n"}, 1, 0)])
    put(spark, tmpdir_path, "actions", [({"userId": "u", "action": "go"}, 3, 1), ("x", 4, 5)])
    _drain(enrich_topology(spark, fmt="json", root=tmpdir_path, available_now=True, keyed_state=True, state_partitions=2))
    assert values(spark, tmpdir_path, "user-actions") == ['{"userId":"u","name":"n","action":"go"}']
    put(spark, tmpdir_path, "rules", [({"ruleId": "r", "allowedActions": ["go"]}, 1, 0)])
    put(spark, tmpdir_path, "acts", [({"userId": "u", "action": "go", "actionId": "1"}, 3, 1)])
    _drain(rule_gate_topology(spark, fmt="json", root=tmpdir_path, available_now=True, keyed_state=True, shards=2, action_topic="acts"))
    assert values(spark, tmpdir_path, "actions-filtered") == ['{"actionId":"1","userId":"u","action":"go"}']
