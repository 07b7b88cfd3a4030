"""What the keyed-state pairing remembers, read from its checkpoint, and starting another query from it."""

import pandas as pd
from pyspark.sql import functions as F

from moments import at
from sim import counts, simulate_pairing
from test_microbatch import EVENTS, expected_pairs, files, some_events, split
from tidal.streaming import pairing
from tidal.streaming.pairing import KIND, PairingProcessor, arrival_sorted, held_cells, pair_tagged_stream
from tidal.streaming.runner import run_to_table


def stream(spark, rows, path):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(EVENTS).parquet(path)


def cells(spark, checkpoint, batch=None):
    return {r.userId: (r.has_user, r.name, r.has_action, r.action) for r in held_cells(spark, checkpoint, batch).collect()}


def test_state_after_each_batch(spark, tmpdir_path):
    """A waiting action; the user that takes it is not kept; a user that came first is, and the action cell stays empty."""
    path, ck = f"{tmpdir_path}/in", f"{tmpdir_path}/ck"

    def after(*rows):
        out = run_to_table(pair_tagged_stream(stream(spark, rows, path)), "state", path=f"{tmpdir_path}/out", checkpoint=ck, state_partitions=3)
        return sorted((r.userId, r.name, r.action) for r in out.collect())
    assert after(("a", 1, at(1), 1, None, "go"), ("b", 0, at(1), 2, "bob", None), ("c", 0, at(1), 3, None, None)) == []
    assert cells(spark, ck) == {"a": (False, None, True, "go"), "b": (True, "bob", False, None), "c": (True, None, False, None)}
    assert after(("a", 0, at(2), 4, "ann", None), ("b", 1, at(2), 5, None, "run")) == [("a", "ann", "go"), ("b", "bob", "run")]
    assert cells(spark, ck) == {"b": (True, "bob", False, None), "c": (True, None, False, None)}
    assert cells(spark, ck, 0)["a"] == (False, None, True, "go")


def test_other_state_partitions_between_batches(spark, tmpdir_path):
    """Four state partitions, then sixteen: the second query starts from the first one's cells."""
    events = some_events(300, [f"u{i}" for i in range(25)], seed=9)
    first = run_to_table(pair_tagged_stream(stream(spark, events[:150], f"{tmpdir_path}/a")), "four", checkpoint=f"{tmpdir_path}/ck",
                         state_partitions=4)
    initial = held_cells(spark, f"{tmpdir_path}/ck")
    second = run_to_table(pair_tagged_stream(stream(spark, events[150:], f"{tmpdir_path}/b"), initial), "sixteen",
                          checkpoint=f"{tmpdir_path}/ck16", state_partitions=16)
    got = [(r.userId, r.name, r.action, r.seq) for out in (first, second) for r in out.collect()]
    assert counts(got) == counts(simulate_pairing([(u, "u" if k == 0 else "a", n if k == 0 else a, ts, s) for u, k, ts, s, n, a in events]))
    meta = spark.read.format("state-metadata").load(f"{tmpdir_path}/ck16").first()
    assert meta.numPartitions == 16


class Cells(dict):
    """A map state that counts its writes."""
    containsKey, getValue, removeKey, writes = dict.__contains__, dict.get, dict.pop, 0

    def getMapState(self, *_):
        return self

    def updateValue(self, key, value):
        self[key], self.writes = value, self.writes + 1


def test_many_users_take_one_call():
    """A call takes the rows of all users of a shard and gives one frame; only cells that change are written."""
    events = some_events(900, [f"u{i}" for i in range(200)], seed=5)
    cells, got = Cells(), []
    processor = PairingProcessor()
    processor.init(cells)
    for part in split(events, 3):
        frame = pd.DataFrame(part[::-1], columns=["userId", KIND, "ts", "seq", "name", "action"])
        frames = list(processor.handleInputRows((0,), iter([frame.iloc[:70], frame.iloc[70:]]), None))
        assert len(frames) == 1
        got += [(r.userId, r.name, r.action, r.seq) for r in frames[0].itertuples()]
    assert counts(got) == expected_pairs(events)
    before = dict(cells), cells.writes
    user = next(u for u, cell in cells.items() if cell[0] == 0)
    again = pd.DataFrame([(*user, 1, at(9999), 9999, None, "go")], columns=["userId", KIND, "ts", "seq", "name", "action"])
    assert len(list(processor.handleInputRows((0,), iter([again]), None))[0]) == 1
    assert (dict(cells), cells.writes) == before


def test_state_is_keyed_by_shard(spark, tmpdir_path, monkeypatch):
    """300 users on two keys of the state, over four micro-batches whose shards come in many frames; then the cells of all of
    them start another query."""
    monkeypatch.setattr(pairing, "SHARDS", 2)
    size, old = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(size, "40")
    try:
        events = some_events(2000, [f"u{i}" for i in range(300)] + [None], seed=3)
        ev = files(spark, split(events[:1600], 4), EVENTS, f"{tmpdir_path}/a")
        first = run_to_table(pair_tagged_stream(ev), "shards", checkpoint=f"{tmpdir_path}/ck", state_partitions=2).collect()
        state = spark.read.format("statestore").option("stateVarName", "cells").load(f"{tmpdir_path}/ck")
        assert state.select("key").distinct().count() == 2
        initial = held_cells(spark, f"{tmpdir_path}/ck")
        assert initial.count() == initial.select("userId").distinct().count() > 200
        assert initial.where(F.col("has_user") & F.col("has_action")).count() == 0
        second = run_to_table(pair_tagged_stream(stream(spark, events[1600:], f"{tmpdir_path}/b"), initial), "more",
                              checkpoint=f"{tmpdir_path}/ck2", state_partitions=3).collect()
        assert counts((r.userId, r.name, r.action, r.seq) for r in [*first, *second]) == expected_pairs(events)
    finally:
        spark.conf.set(size, old)


def test_number_ids(spark, tmpdir_path):
    """Ids keep the table's type in the state too."""
    events = some_events(200, list(range(20)), seed=8)
    schema = EVENTS.replace("userId string", "userId long")
    ev = files(spark, split(events, 2), schema, f"{tmpdir_path}/in")
    out = run_to_table(pair_tagged_stream(ev), "numbers", checkpoint=f"{tmpdir_path}/ck", state_partitions=2)
    assert counts((r.userId, r.name, r.action, r.seq) for r in out.collect()) == expected_pairs(events)
    assert dict(held_cells(spark, f"{tmpdir_path}/ck").dtypes)["userId"] == "bigint"


def test_positions_stay_whole_beside_missing_ones():
    """Pandas has whole numbers as floats where one is missing; those of other frames of the shard stay exact."""
    big = 2**60 + 1
    rows = [pd.DataFrame({"userId": ["b", "a"], KIND: 1, "ts": at(1), "seq": [big, big + 2], "name": None, "action": "x"}),
            pd.DataFrame({"userId": ["a", "a"], KIND: 1, "ts": at(1), "seq": [float("nan"), 3.0], "name": None, "action": "y"})]
    got = arrival_sorted(rows)
    assert [(u, None if pd.isna(s) else int(s)) for u, s in zip(got["userId"], got["seq"], strict=True) if u == "a"] == [
        ("a", None), ("a", 3), ("a", big + 2)]
    assert [int(s) for s in got.loc[got["userId"] == "b", "seq"]] == [big]
