"""The pipeline's stages on a small table with planted cases, and its contract."""

import random

import corpus_pipeline
import pytest
from test_models import bad_text, prose

from tidal.llm import decontamination


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(8)
    folder = str(tmp_path_factory.mktemp("sf"))
    words = ["grumbleknock", "vilefoot", "dunderhead"]
    items = [(i, prose(rng, 30)) for i in range(6)]
    rows, kinds, labels = [], {}, []
    for i in range(420):
        text, kind = prose(rng, rng.randint(20, 120)), "clean"
        if i % 7 == 1:
            w = text.split()
            for _ in range(4):
                w.insert(rng.randint(0, len(w)), rng.choice(words))
            text, kind = " ".join(w), "toxic"
        elif i % 14 == 2:
            text, kind = bad_text(rng, i % 4), "bad"
        elif i % 14 == 3:
            text, kind = text + " " + items[i % 6][1], "leak"
        elif i % 14 == 4:
            text, kind = rows[i - 4][1] + (" one more" if i % 28 == 4 else ""), "copy"
        kinds[i] = kind
        labels.append((i, 1, int(kind == "toxic")))
        rows.append((i, text, "en", rng.choice(["a", "a", "b"]), len(text), i * 2))
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, copies int"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, kinds


def test_stages_drop_what_they_should_and_keep_the_rest(spark, tables):
    folder, rows, kinds = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = {r[0] for r in rows}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.written(stage(spark, docs, folder), name)
        assert out.columns == docs.columns
        ids = [r.doc_id for r in out.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= left
        gone = {kinds[i] for i in left - set(ids)}
        want = {"toxicity": "toxic", "quality_classifier": "bad", "ngram_join": "copy", "decontamination": "leak"}[name]
        dropped = [i for i in left - set(ids) if kinds[i] == want]
        assert len(dropped) >= 0.9 * sum(kinds[i] == want for i in left), (name, gone)
        assert len([i for i in left - set(ids) if kinds[i] == "clean"]) <= 2, name
        left, docs = set(ids), out
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in mixed} <= left and all(r.text == rows[r.doc_id][1] for r in mixed)
    assert all(1 <= r.copy <= r.copies <= 2 for r in mixed)


def test_run_and_contract(spark, tables):
    folder, rows, _ = tables
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_classifier", "ngram_join", "decontamination", "mixing"]
    out = corpus_pipeline.run(spark, folder)
    got = out.collect()
    assert got and {"doc_id", "text", "copy"} <= set(out.columns)
    again = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id, r.copy) for r in got) == sorted((r.doc_id, r.copy) for r in again)


def test_empty_tables(spark, tables, tmp_path):
    folder, _, _ = tables
    empty = str(tmp_path)
    for name in ("documents", "labels", "benchmark"):
        t = spark.read.parquet(f"{folder}/{name}.parquet")
        spark.createDataFrame([], t.schema).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_contaminated_stage_input_may_repeat_ids(spark, frame):
    bench = frame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id bigint, text string")
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    assert [r.doc_id for r in decontamination.contaminated(frame([(1, text), (1, text), (2, "x")]), bench).collect()] == [1]


CLASHING = ("_text", "_id", "_flag", "_cid", "_n", "_drop", "_kid", "_kcid", "copies", "n", "comp")


@pytest.mark.parametrize("which", range(len(corpus_pipeline.STAGES)))
def test_stages_take_nulls_long_and_repeated_rows_and_clashing_names(spark, tables, tmp_path, which):
    """Each stage on its own: rows go through whole or not at all, with all their columns."""
    folder, rows, _ = tables
    rng = random.Random(which)
    some = [(r[0], r[1], r[2], r[3], r[4]) for r in rows[:60]]
    odd = [(None, None, None, None, None), (None, None, None, None, None), (5000, "", "en", None, 0), (5001, None, None, "a", None),
           (5002, "long words here. " * 8000, "en", "a", 1), (5003, prose(rng, 40), "en", "b", 2)] + [(5004, prose(random.Random(1), 50), "en", "a", 3)] * 5
    fields = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame([(*r, *range(len(CLASHING))) for r in some + odd], fields + "".join(f", `{c}` int" for c in CLASHING))
    name, stage = corpus_pipeline.STAGES[which]
    docs.write.parquet(str(tmp_path / "in"))
    docs = spark.read.parquet(str(tmp_path / "in"))
    out = stage(spark, docs, folder)
    got = out.collect()
    if name != "mixing":
        assert out.columns == docs.columns
        before = {}
        for r in docs.collect():
            before[tuple(r)] = before.get(tuple(r), 0) + 1
        after = {}
        for r in got:
            after[tuple(r)] = after.get(tuple(r), 0) + 1
        assert all(n <= before.get(r, 0) for r, n in after.items())
        if name == "ngram_join":
            assert sum(n for r, n in after.items() if r[0] == 5004) == 1
    else:
        assert all(r.copies in (1, 2) for r in got) and {r.doc_id for r in got} <= {r[0] for r in some + odd}
