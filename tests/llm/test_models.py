"""Trained models: held-out accuracy, edge cases, the weak-label model."""

import inspect
import random
import zlib

import numpy as np
import pyarrow as pa

from tidal.llm import html_training, language, quality, toxicity


def prose(rng, n, letters="aeinorst"):
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))).capitalize() if rng.random() < 0.1
                    else "".join(rng.choices(letters, k=rng.randint(2, 7))) + rng.choice(["", "", "", "", ",", "."]) for _ in range(n))


def toxic_set(rng, n, words):
    texts, labels = [], []
    for i in range(n):
        w = prose(rng, rng.randint(5, 120)).split()
        if i % 3 == 0:
            for _ in range(rng.randint(2, 4)):
                w.insert(rng.randint(0, len(w)), rng.choice(words))
        texts.append(" ".join(w))
        labels.append(int(i % 3 == 0))
    return texts, labels


def test_toxicity_on_held_out_texts_and_misspellings():
    rng = random.Random(1)
    words = ["grumbleknock", "vilefoot", "dunderhead", "wretchling"]
    model = toxicity.train(*toxic_set(rng, 450, words), epochs=6)
    texts, labels = toxic_set(rng, 200, words)
    caught = model.score(toxicity.max_logits(pa.array(texts), model)) >= 0.7
    assert (caught == np.array(labels, bool)).mean() > 0.97
    texts, labels = toxic_set(rng, 200, ["grumbelknock", "vilef00t", "dunderrhead", "wretchlng"])
    score = model.score(toxicity.max_logits(pa.array(texts), model))
    y = np.array(labels, bool)
    assert np.median(score[y]) > 0.5 and (score[~y] >= 0.7).mean() < 0.03


def test_toxicity_edges(spark, frame):
    model = toxicity.train(["bad worm", "good day", "bad bad", "fine thing"] * 5, [1, 0, 1, 0] * 5, epochs=2)
    rows = [(1, ""), (2, None), (3, " \n"), (4, "x" * 200_000), (5, "bad " * 30_000), (5, "bad " * 30_000), (None, "good")]
    docs = frame([(d, t, 0.5, True) for d, t in rows], "doc_id bigint, text string, score double, table boolean")
    got = toxicity.score(docs, model).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert [r.score for r in got if r.doc_id in (1, 2, 3)] == [0.0] * 3
    assert toxicity.below(docs, model, 2.0).count() == 7 and toxicity.below(docs, model, 2.0).columns == docs.columns
    assert toxicity.score(frame([]), model).count() == 0
    one = toxicity.train(["a", "b"], [0, 0])
    assert toxicity.train([], []).score(np.array([0.0]))[0] < 0.5 and one.score(np.array([0.0]))[0] < 0.5


def test_toxicity_sample_uses_given_labels(spark, frame):
    docs = frame([(i, f"text {i}") for i in range(30)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(0, 1), (99, 1), (None, 1), (21, 7), (22, None)],
                                   "doc_id bigint, toxic int")
    texts, y = toxicity.labelled_sample(docs, labels, 5)
    assert y.count(0) == 5 and 4 <= y.count(1) <= 5      # a label may have no document
    assert all((int(t.split()[1]) % 2 == v) or t == "text 0" for t, v in zip(texts, y, strict=True))
    assert toxicity.fit(frame([]), labels).score(np.array([1.0])).shape == (1,)


def test_language_edges(spark, frame):
    rng = random.Random(2)
    rows = [(i, prose(rng, 40, "abcde" if i % 2 else "vwxyz"), "aa" if i % 2 else "zz", 1) for i in range(300)]
    rows += [(1000, "", "aa", 1), (1001, None, "zz", 1), (1002, "123 -- !!", "aa", 1), (1003, "abc", None, 1), (1004, "Ü", None, 1),
             (1005, "abcde " * 30_000, None, 1), (None, "vwxyz", "zz", 1), (7, "abcde bcd", "aa", 1), (7, "abcde bcd", "aa", 1)]
    docs = frame(rows, "doc_id bigint, text string, lang string, score int")
    got = language.identify(docs).collect()
    assert len(got) == len(rows)
    pred = {r.doc_id: r for r in got}
    assert all(pred[i].lang_pred == ("aa" if i % 2 else "zz") for i in range(300))
    assert [(pred[i].lang_pred, pred[i].score, pred[i].accepted) for i in (1000, 1001, 1002)] == [("und", 0.0, False)] * 3
    assert pred[1004].lang_pred in ("aa", "zz") and all(0 <= r.score <= 1 for r in got)
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert language.identify(frame([], "doc_id bigint, text string, lang string")).count() == 0
    alone = language.identify(frame([(1, "a", None)], "doc_id bigint, text string, lang string")).collect()
    assert [(r.lang_pred) for r in alone] == ["und"]


def bad_text(rng, kind):
    words = prose(rng, 80).split()
    if kind == 0:
        return " ".join(w + "$$$" for w in words)
    if kind == 1:
        return "!! ".join(words).upper() + "!!"
    if kind == 2:
        return " | ".join(words)
    return " ".join(w for w in words[:12] for _ in range(8))


def test_weak_labels_find_all_kinds_of_bad_text(spark, frame):
    rng = random.Random(3)
    rows = [(i, bad_text(rng, (i // 6) % 4) if i % 6 == 0 else prose(rng, rng.randint(5, 200)), i % 6 == 0) for i in range(900)]
    docs = frame([(i, t) for i, t, _ in rows])
    model = quality.fit(docs)
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    bad = np.array([b for _, _, b in rows])
    keep = np.array([got[i].score >= 0.5 for i, _, _ in rows])
    assert keep[~bad].mean() > 0.99 and keep[bad].mean() < 0.2
    assert all(g > 0.95 for _, g in model.weak.accuracies().values())


def test_quality_edges(spark, frame):
    rows = [(1, ""), (2, None), (3, " \n\t"), (4, "One."), (5, "word " * 30_000), (None, "A short text, fine."), (4, "One.")]
    docs = frame([(d, t, 1.0) for d, t in rows], "doc_id bigint, text string, score double")
    model = quality.fit(docs)
    got = quality.score(docs, model).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert [r.score for r in got if r.doc_id in (1, 2, 3)] == [0.0] * 3
    assert quality.at_least(docs, model, 0.0).columns == docs.columns
    assert quality.score(frame([]), quality.fit(frame([]))).count() == 0


def test_documented_training_bounds():
    bound = lambda f, name: inspect.signature(f).parameters[name].default
    assert (bound(toxicity.fit, "max_per_class"), bound(quality.fit, "max_rows"), bound(language.identify, "max_rows"),
            bound(html_training.training_pages, "n")) == (1500, 3000, 4000, 1200)


def test_language_sample_has_every_language(spark, frame):
    rng = random.Random(6)
    rows = [(i, prose(rng, 20, "vwxyz" if i % 1000 == 1 else "abcde"), "rare" if i % 1000 == 1 else "often") for i in range(8000)]
    rows += rows[1:2] * 3000
    docs = frame(rows, "doc_id bigint, text string, lang string")
    learned = {i for i, _, v in rows if v == "rare" and zlib.crc32(str(i).encode()) % 4 != 2}
    texts, languages = language.labelled_sample(docs, language.held_out("doc_id", 4, 2), 100)
    assert languages.count("rare") == len(learned) > 3 and len(texts) == 100
    assert (texts, languages) == language.labelled_sample(docs.repartition(7), language.held_out("doc_id", 4, 2), 100)
    got = language.identify(docs, max_rows=100).where("doc_id % 1000 = 1").collect()
    assert {r.lang_pred for r in got} == {"rare"}


def test_quality_sample_holds_distinct_texts(spark, frame, monkeypatch):
    rng = random.Random(7)
    texts = [prose(rng, 12) for _ in range(120)]
    least = frame([(i, t) for i, t in enumerate(texts)]).selectExpr("min(struct(xxhash64(text) k, text)).text t").first().t
    docs = frame([(i, t) for i, t in enumerate(texts + [least] * 5000)])
    monkeypatch.setattr(quality, "train", lambda sample, weak: sample)
    assert set(quality.fit(docs, max_rows=500)) == set(texts)
    assert len(quality.fit(docs, max_rows=50)) == 50
