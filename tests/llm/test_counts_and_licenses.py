"""Token histograms against plain sums; license notices and their inheritance."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from tidal.llm import licenses, token_counts as tc


@pytest.mark.skipif(not os.path.exists(tc.VOCABULARY), reason="no tokenizer file")
def test_lengths_and_suffix_sums(spark, frame):
    texts = ["", None, "a", "hello world " * 40, "x" * 5000, " \n\t ", "été 😀", "hello world", "hello world"] + ["w " * k for k in range(300)]
    docs = frame([(i, t, 9) for i, t in enumerate(texts)], "doc_id bigint, text string, n_tokens int")
    lengths = {r.doc_id: r.n_tokens for r in tc.token_lengths(docs).collect()}
    with open(tc.VOCABULARY, "rb") as f:
        encode = tc._encoder(f.read(), tc.PATTERN).encode_ordinary
    assert lengths == {i: len(encode(t or "")) for i, t in enumerate(texts)}
    all_lengths = list(lengths.values())
    table = tc.token_table(docs)
    for r in table.collect():
        over = [n for n in all_lengths if n >= r.n_tokens]
        assert (r.docs, r.docs_from, r.tokens_from) == (all_lengths.count(r.n_tokens), len(over), sum(over))
        assert r.kept_tokens == sum(min(n, r.n_tokens) for n in all_lengths)
        assert r.lost_tokens == sum(all_lengths) - r.kept_tokens
        assert r.docs_share == sum(n <= r.n_tokens for n in all_lengths) / len(all_lengths)
    for r in tc.at_limits(table, [0, 1, 57, 100, 10**6]).collect():
        assert (r.docs_over, r.kept_tokens) == (sum(n > r.limit for n in all_lengths), sum(min(n, r.limit) for n in all_lengths))
    for r in tc.quantiles(table, [0.0, 0.5, 1.0]).collect():
        assert r.n_tokens == min(n for n in all_lengths if sum(m <= n for m in all_lengths) >= r.share * len(all_lengths))
    assert tc.token_table(frame([])).count() == 0


def test_notices_and_nearest_directory(spark, frame):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    prose = "words of no license at all here and there " * 200
    rows = [("a/LICENSE", mit), ("a/x.py", prose), ("a/b/LICENSE.txt", apache), ("a/b/c/y.py", prose), ("a/b/z.py", "# " + mit + "\n" + prose),
            ("q/r.py", None), ("LICENSE", ""), ("a//b/w.py", ""), ("s/README", prose + "\nAll rights reserved.\n" + prose),
            (None, mit), ("a/x.py", ""), ("e/COPYING", "Licensed under CC BY-NC 4.0."), ("e/f/g/h/i.txt", "x")]
    files = frame([(p, t, "L", 1) for p, t in rows], "path string, text string, license string, file int")
    got = {r.path: (r.license, r.via, r.from_path) for r in licenses.scan(files).collect()}
    assert got == {
        "a/LICENSE": ("MIT", "notice", None), "a/x.py": ("MIT", "directory", "a/LICENSE"),
        "a/b/LICENSE.txt": ("Apache-2.0", "notice", None), "a/b/c/y.py": ("Apache-2.0", "directory", "a/b/LICENSE.txt"),
        "a/b/z.py": ("MIT", "notice", None), "q/r.py": (None, None, None), "LICENSE": (None, None, None),
        "a/b/w.py": ("Apache-2.0", "directory", "a/b/LICENSE.txt"), "s/README": ("Proprietary", "notice", None),
        "e/COPYING": ("CC-BY-NC-4.0", "notice", None), "e/f/g/h/i.txt": ("CC-BY-NC-4.0", "directory", "e/COPYING")}
    assert licenses.scan(frame([], "path string, text string")).count() == 0


def test_every_template_names_its_own_license(spark, frame):
    rows = [(f"{name}/{i}", text) for name, texts in licenses.TEMPLATES.items() for i, text in enumerate(texts)]
    got = {r.path: r.license for r in licenses.scan(frame(rows, "path string, text string")).collect()}
    assert got == {p: p.split("/")[0] for p, _ in rows}


def cosine(text, texts, template):
    """TF-IDF cosine by hand."""
    def weigh(t):
        terms = licenses._terms(t)
        return {x: terms.count(x) * (math.log((1 + len(texts)) / (1 + sum(x in licenses._terms(o) for o in texts))) + 1) for x in terms}
    a, b = weigh(text), weigh(template)
    return sum(a[x] * b.get(x, 0) for x in a) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))


def test_a_common_word_beside_the_notice_at_two_corpus_sizes(spark):
    for n in (2_000, 200_000):
        files = spark.range(n).selectExpr("cast(id as string) file", """case when id % 20 = 0 then
            'This file is licensed under the MIT License.' else 'A file of other words.' end text""")
        rare = math.log((1 + n) / (1 + n / 20)) + 1
        expected = 3 * rare * rare / math.sqrt(3 * rare * rare * (3 * rare * rare + 1))
        got = licenses.notices(files).agg(F.count("*").alias("n"), F.min("license").alias("l"), F.min("cosine").alias("lo"),
                                          F.max("cosine").alias("hi")).first()
        assert (got.n, got.l) == (n / 20, "MIT") and got.lo == got.hi == pytest.approx(expected, abs=1e-8)


def test_cosines_are_those_of_all_terms(spark, frame, monkeypatch):
    rng = random.Random(4)
    words = [f"w{int(k ** 1.7)}" for k in range(60)]
    base = [t for texts in licenses.TEMPLATES.values() for t in texts]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 6)) + rng.choice(base).split() + [f"only{i}"] * (i % 3)) for i in range(150)]
    rows = [(str(i), t) for i, t in enumerate(texts)]
    expected = {str(i): max(cosine(t, texts, b) for b in base) for i, t in enumerate(texts)}
    expected = {k: v for k, v in expected.items() if v >= licenses.THRESHOLD}
    assert 0 < len(expected) < len(texts)
    for bits, frequent in ((20, 1e-3), (20, 1.1), (2, 1.1)):        # also when terms aren't held, or share buckets
        monkeypatch.setattr(licenses, "BUCKET_BITS", bits)
        monkeypatch.setattr(licenses, "FREQUENT", frequent)
        got = {r.file: r.cosine for r in licenses.notices(frame(rows, "file string, text string")).collect()}
        assert got == pytest.approx(expected, abs=1e-8)


def test_documents_without_an_id_are_one_file_of_their_source(spark, frame):
    docs = frame([(None, "Licensed under the MIT License.", "s"), (None, "nothing here", "s"), (7, "plain words", "s")],
                 "doc_id bigint, text string, source string")
    got = {r.path: r.via for r in licenses.scan(licenses.document_files(docs)).collect()}
    assert set(got) == {"s/none.txt", "s/0/0/7.txt"} and got["s/none.txt"] == "notice"
