import pytest
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from tidal import schemas
from tidal.operators.join import user_action_join, user_action_join_sql
from tidal.operators.views import conform, project_action, project_user, register_views
from tidal.streaming.runner import run_to_table


def frames(spark, users, actions):
    return (spark.createDataFrame(users, schemas.USER),
            spark.createDataFrame(actions, schemas.ACTION))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_reference_case(spark):
    u, a = frames(spark, [("userId1", "name1")], [("userId1", "logged-in")])
    assert rows(user_action_join(u, a)) == [("userId1", "name1", "logged-in")]


# the "SQL join gives" column of the added cases: every user record pairs with every action
@pytest.mark.parametrize("users,actions,expected", [
    ([("k", "n")], [("k", "x")], [("n", "x")]),
    ([("k", "n")], [("k", "p"), ("k", "q")], [("n", "p"), ("n", "q")]),
    ([("k", "n"), ("k", "m")], [("k", "p"), ("k", "r")], [("m", "p"), ("m", "r"), ("n", "p"), ("n", "r")]),
    ([("k", "n"), ("k", "m")], [("k", "x")], [("m", "x"), ("n", "x")]),
    ([("k1", "n")], [("k2", "x")], []),
    ([("k", None)], [("k", "x")], [(None, "x")]),
    ([(None, "n")], [(None, "x")], []),
])
def test_bag_semantics(spark, users, actions, expected):
    u, a = frames(spark, users, actions)
    got = sorted(((r.name, r.action) for r in user_action_join(u, a).collect()), key=str)
    assert got == sorted(expected, key=str)


def test_sql_text_over_views(spark):
    u, a = frames(spark, [("userId1", "name1"), ("u2", "n2")], [("userId1", "logged-in")])
    register_views(u, a, "UT_test", "AT_test")
    with pytest.raises(AnalysisException):
        register_views(u, a, "UT_test", "AT_test")        # names are taken
    out = user_action_join_sql(spark, "UT_test", "AT_test")
    assert out.columns == ["userId", "name", "action"]
    assert rows(out) == [("userId1", "name1", "logged-in")]
    assert rows(project_user(u)) == [("u2", "n2"), ("userId1", "name1")]
    assert rows(project_action(a)) == [("userId1", "logged-in")]


def test_conform_reorders_by_name(spark):
    df = spark.createDataFrame([("x", "n", "u")], "action string, name string, userId string")
    assert conform(df).columns == ["userId", "name", "action"]


def test_plan_prunes_columns_and_pushes_filters(spark, tmpdir_path):
    spark.createDataFrame([(1, "c1", 5), (2, "c2", 6)], "c_custkey long, c_name string, extra int") \
        .write.parquet(f"{tmpdir_path}/customer")
    spark.createDataFrame([(1, "click", 3.0)], "user_id long, event_type string, value double") \
        .write.parquet(f"{tmpdir_path}/events")
    from tidal.sources.tables import actions_from_events, users_from_customer
    u = users_from_customer(spark.read.parquet(f"{tmpdir_path}/customer"), text_ids=False)
    a = actions_from_events(spark.read.parquet(f"{tmpdir_path}/events"), text_ids=False)
    plan = user_action_join(u, a)._jdf.queryExecution().executedPlan().toString()
    assert "extra" not in plan and "value" not in plan          # unused columns never read
    assert "IsNotNull(c_custkey)" in plan and "IsNotNull(user_id)" in plan


@pytest.mark.parametrize("salt", [None, 4])
def test_streaming_join(spark, tmpdir_path, salt):
    u, a = frames(spark, [("k", "n"), ("k", "m"), ("j", "o")],
                  [("k", "x"), ("k", "x2"), ("j", "y"), ("z", "w")])
    u.write.parquet(f"{tmpdir_path}/u")
    a = a.withColumn("seq", F.monotonically_increasing_id())
    a.write.parquet(f"{tmpdir_path}/a")
    us = spark.readStream.schema(schemas.USER).parquet(f"{tmpdir_path}/u")
    acts = spark.readStream.schema(a.schema).parquet(f"{tmpdir_path}/a")
    out = run_to_table(user_action_join(us, acts, salt=salt), "join-test")
    assert rows(out) == [("j", "o", "y"), ("k", "m", "x"), ("k", "m", "x2"), ("k", "n", "x"),
                         ("k", "n", "x2")]


def test_salted_hot_key_join(spark):
    users = [("hot", "h1"), ("hot", "h2"), ("cold", "c"), ("none", "x")]
    actions = [("hot", f"a{i}") for i in range(300)] + [("cold", "b"), ("cold", "b"), (None, "z")]
    u, a = frames(spark, users, actions)
    plain = rows(user_action_join(u, a))
    with pytest.raises(ValueError):
        user_action_join(u, a, hot_key_rows=50, salt=7)         # nothing tells the actions apart
    a = a.withColumn("seq", F.monotonically_increasing_id())
    salted = rows(user_action_join(u, a, hot_key_rows=50, salt=7))
    assert salted == plain and len(plain) == 602
    assert rows(user_action_join(u, a, salt=5)) == plain


def test_equal_actions_of_a_hot_id_reach_all_sub_keys(spark):
    from tidal.operators import join
    u, _ = frames(spark, [("hot", "h")], [])
    a = spark.range(2000).selectExpr("'hot' AS userId", "'same' AS action", "id AS seq")
    seen = []
    real, join._salted = join._salted, lambda *args: seen.append(real(*args)) or seen[-1]
    try:
        assert user_action_join(u, a, hot_key_rows=10, salt=16).count() == 2000
    finally:
        join._salted = real
    assert seen[0][1].select("_salt").distinct().count() == 16


def test_tap_prints_batch_and_stream(spark, tmpdir_path, capsys):
    from tidal.streaming.runner import tap
    u, _ = frames(spark, [("userId1", "name1")], [])
    assert tap(u) is None
    assert "userId1" in capsys.readouterr().out
    many = spark.range(57).selectExpr("concat('user', id) AS userId", "'n' AS name")
    tap(many)
    assert all(f"user{i} " in capsys_text for i in (0, 30, 56)) if (capsys_text := capsys.readouterr().out) else False
    u.write.parquet(f"{tmpdir_path}/u")
    q = tap(spark.readStream.schema(schemas.USER).parquet(f"{tmpdir_path}/u"), "tap-test",
            available_now=True)
    q.awaitTermination(60)
    assert q.exception() is None and q.lastProgress["numInputRows"] == 1


def test_views_log_their_schemas(spark, caplog):
    u = spark.createDataFrame([("a", "n")], schemas.USER)
    a = spark.createDataFrame([("a", "go")], schemas.ACTION)
    with caplog.at_level("INFO", logger="tidal.operators.views"):
        register_views(u, a, "UT_log", "AT_log", replace=True)
    said = [r.getMessage() for r in caplog.records]
    assert said == ["schema of UT_log: struct<userId:string,name:string>", "schema of AT_log: struct<userId:string,action:string>"]
