import pytest
from pyspark.sql import functions as F

from tidal import schemas
from tidal.functions import codec
from tidal.functions.codec import decode_json, encode_json, to_topic_rows

# (input value, accepted record or None, reason when rejected) -- the decode contract
USER_CASES = [
    ('{"userId":"a","name":"b"}', ("a", "b"), None),
    ('{"userId":"a"}', ("a", None), None),
    ('{"userId":"a","name":null}', ("a", None), None),
    ("{}", (None, None), None),
    ('{"userId":"a","x":1}', None, codec.REASON_UNKNOWN_FIELD),
    ('{"UserId":"a"}', None, codec.REASON_UNKNOWN_FIELD),
    ("null", None, codec.REASON_MALFORMED),
    ("", None, codec.REASON_BLANK),
    ("   ", None, codec.REASON_BLANK),
    ("[1]", None, codec.REASON_MALFORMED),
    ('"s"', None, codec.REASON_MALFORMED),
    ("12", None, codec.REASON_MALFORMED),
    ("{bad", None, codec.REASON_MALFORMED),
    ("{'userId':'a'}", None, codec.REASON_MALFORMED),
    ('{"userId":NaN}', None, codec.REASON_MALFORMED),
    ('{"userId":{"q":1}}', None, codec.REASON_NESTED),
    ('{"userId":[1]}', None, codec.REASON_NESTED),
    ('{"userId":"{not nested}"}', ("{not nested}", None), None),
    ('{"userId":15,"name":true}', ("15", "true"), None),
    ('{"userId":"a","userId":"b"}', ("b", None), None),
    ('{"userId":"a"} trailing', ("a", None), None),
    (None, None, codec.REASON_NULL),
]

RULE_CASES = [
    ('{"ruleId":"r","allowedActions":["a",null]}', ("r", ["a", None]), None),
    ('{"ruleId":"r","allowedActions":[]}', ("r", []), None),
    ('{"ruleId":"r","allowedActions":[1,true]}', ("r", ["1", "true"]), None),
    ('{"ruleId":"r","allowedActions":"a"}', None, codec.REASON_MALFORMED),
    ('{"ruleId":"r","allowedActions":[{"a":1}]}', None, codec.REASON_NESTED),
    ('{"ruleId":"r","allowedActions":["x",["y"]]}', None, codec.REASON_NESTED),
    ('{"ruleId":"r"}', None, codec.REASON_REQUIRED),
    ('{"ruleId":"r","allowedActions":null}', None, codec.REASON_REQUIRED),
]


def _decode(spark, values, schema, required=()):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    acc, rej = decode_json(df, schema, required=required, keep=("i",))
    return ({r.i: tuple(r[f.name] for f in schema.fields) for r in acc.collect()},
            {r.i: r.reason for r in rej.collect()})


@pytest.mark.parametrize("cases,schema,required", [
    (USER_CASES, schemas.USER, ()), (RULE_CASES, schemas.RULE, ("allowedActions",))])
def test_decode_contract(spark, cases, schema, required):
    acc, rej = _decode(spark, [c[0] for c in cases], schema, required)
    for i, (value, record, reason) in enumerate(cases):
        if record is None:
            assert rej.get(i) == reason, value
            assert i not in acc
        else:
            got = tuple(list(x) if isinstance(x, list) else x for x in acc[i])
            assert got == record, value


def test_decode_binary_values(spark):
    df = spark.createDataFrame([(bytearray(b'{"userId":"u","action":"go"}'),)], "value binary")
    acc, rej = decode_json(df, schemas.ACTION)
    assert [tuple(r) for r in acc.collect()] == [("u", "go")] and rej.count() == 0


def test_encode_keeps_null_fields(spark):
    df = spark.createDataFrame([("a", None, "x")], "userId string, name string, action string")
    assert df.select(encode_json("userId", "name", "action")).first()[0] == \
        '{"userId":"a","name":null,"action":"x"}'
    assert df.select(encode_json(F.lit(None).cast("string").alias("userId"))).first()[0] == \
        '{"userId":null}'


def test_topic_rows_key_is_whole_record(spark):
    df = spark.createDataFrame([("id1", "name1", "logged-in")], schemas.USER_ACTION)
    row = to_topic_rows(df).first()
    assert row.key == row.value == '{"userId":"id1","name":"name1","action":"logged-in"}'
    assert to_topic_rows(df, key="userId").first().key == "id1"
    assert to_topic_rows(df, key=None).first().key is None


def test_round_trip(spark):
    rows = [("a1", "u1", "go"), (None, "u2", None), ("a3", None, "stop")]
    df = spark.createDataFrame(rows, schemas.ACTION_RECORD)
    enc = df.select(encode_json("actionId", "userId", "action").alias("value"))
    acc, rej = decode_json(enc, schemas.ACTION_RECORD)
    assert sorted(map(tuple, acc.collect()), key=str) == sorted(rows, key=str)
    assert rej.count() == 0


def test_numbers_keep_the_text_they_were_sent_with(spark):
    """Text fields take numbers as written; strings, duplicates and escapes are left as parsed."""
    sent = ["1.50", "1e3", "-0", "0", "0.10", "1E+2", "12345678901234567890123", "-7", "1.0", "true", "1e400",
            "100000000000000000000000.5"]
    rows = [(i, f'{{"userId": {v},"action":"a {v}"}}') for i, v in enumerate(sent)]
    rows += [(100, '{"userId":"1.50","action":"x"}'), (101, '{"userId":1.50,"userId":"2.5","action":"x"}'),
             (102, '{"action":"\\"userId\\": 9.50,","userId":1.50}'), (103, '{"user\\u0049d":1.50,"action":"x"}'),
             (104, '{"userId" :\n 2.500 ,"action":null}')]
    acc, rej = decode_json(spark.createDataFrame(rows, "k int, value string"), schemas.ACTION, keep=("k",))
    got = {r.k: r.userId for r in acc.collect()}
    assert {i: got[i] for i in range(len(sent))} == dict(enumerate(sent))
    assert got[100] == "1.50" and got[101] == "2.5" and got[102] == "1.50" and got[104] == "2.500"
    assert got[103] in ("1.5", "1.50") and rej.count() == 0
    rules = [(0, '{"ruleId":"r","allowedActions":["a,b]", 1.50, "2.50", 1e3, null, -0, 7]}'), (1, '{"ruleId":"r","allowedActions":[]}')]
    out = {r.k: r.allowedActions for r in decode_json(spark.createDataFrame(rules, "k int, value string"), schemas.RULE, keep=("k",))[0].collect()}
    assert out == {0: ["a,b]", "1.50", "2.50", "1e3", None, "-0", "7"], 1: []}
