"""HTML extraction: exact marginals by enumeration, held-out layouts, messy markup."""

import itertools

import numpy as np
import pytest

from tidal.llm import html_extract as h
from tidal.llm.html_training import training_pages


@pytest.fixture(scope="module")
def model():
    return h.fit(training_pages(500))


def test_messages_give_exact_marginals():
    rng = np.random.default_rng(1)
    trees = h.Trees()
    trees.add(0, "<div>a<p>b</p><p>c</p></div>")
    g = h.Graph(trees)
    m = h.Model(rng.normal(size=(h.FEATURES, 3)), rng.normal(size=(5, 3, 3)))
    got, pairs, log_z = g.marginals(m)
    unary = g.unary(m)
    unary[0] += [0, -50, -50]
    total, want = 0.0, np.zeros((g.n, 3))
    for states in itertools.product(range(3), repeat=g.n):
        s = sum(unary[i, k] for i, k in enumerate(states))
        s += sum(m.edge[g.kind[i], states[p], states[i]] for i, p in enumerate(g.parent) if p >= 0)
        w = np.exp(s)
        total += w
        for i, k in enumerate(states):
            want[i, k] += w
    assert np.allclose(got, want / total) and np.isclose(log_z, np.log(total))
    assert np.allclose(pairs[1:].sum(2), got[g.parent[1:]])


def test_held_out_layouts(model):
    pages = training_pages(200, seed=77)
    trees = h.Trees()
    for i, page in enumerate(pages):
        trees.add(i, page)
    got, _, _ = h.Graph(trees).marginals(model)
    runs = np.array([t == "#text" for t in trees.tag])
    right = ((got[:, h.CONTENT] >= 0.5) == (np.array(trees.label) == h.CONTENT))[runs]
    assert right.mean() > 0.98


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><!-- <p>comment</p> -->
<div class="cookie-notice"><p>We use cookies.</p><button>OK</button></div>
<article><h1>Head &lt;1&gt;</h1><p><b>First&nbsp;para &amp; more.<br><p>Second,  para
 graph.</p><div class="ad">Buy now.</div><p>Third &#233;t&eacute;.</p>{extra}</article>
<section class="comments"><h3>Comments</h3><p>What a nice long comment this is, with many words in it, really.</p></section>
<aside><h3>Related</h3><ul><li><a href="#">Other story</a></li></ul></aside>
<form><label>Name</label><input><select><option>x</option></select></form><footer>&copy; 2024 Site</footer></body></html>"""


def test_whole_page(model):
    got = h.main_text([PAGE.format(extra="")], model)[0]
    assert got == "Head <1>\n\nFirst para & more.\n\nSecond, para graph.\n\nThird été."


def test_rows_and_edges(spark, frame, model):
    rows = [(1, "u1", PAGE.format(extra="")), (1, "u1", PAGE.format(extra="")), (2, None, None), (3, "u3", ""),
            (None, "u4", "plain text only"), (5, "u5", "<p" * 50), (6, "u6", "<div>" * 3000 + "deep" + "</p></div>" * 10),
            (7, "u7", PAGE.format(extra="".join(f"<p>{i} many words of text.</p>" for i in range(2000)))),
            (8, "u8", "a < b and \"c' <a href='x>y"), (9, "u9", "<script>never closed")]
    pages = frame([(*r, "t", 1) for r in rows], "page_id bigint, url string, html string, text string, n_chars int")
    got = h.extract(pages, model).collect()
    assert sorted((r.page_id or 0, r.url or "") for r in got) == sorted((r[0] or 0, r[1] or "") for r in rows)
    assert all(r.n_chars == len(r.text) for r in got)
    text = {r.page_id: r.text for r in got}
    assert text[2] == text[3] == text[9] == ""
    assert text[7].count("many words of text.") == 2000
    assert h.extract(frame([], "page_id bigint, url string, html string"), model).count() == 0


def test_very_deep_pages_keep_their_article(model):
    """Elements have no greatest depth: an article below thousands of nested ones is read as any other."""
    article = "".join(f"<p>This is sentence number {i} of an article that goes on for a while, with commas, and ends here.</p>" for i in range(6))
    for depth in (10, 500, 4000):
        page = "<html><body>" + "<div>" * depth + article + "</div>" * depth + "</body></html>"
        trees = h.Trees()
        trees.add(0, page)
        assert max(trees.depth) > depth
        assert len(h.Graph(trees).levels) == max(trees.depth)
        assert h.main_text([page], model)[0].count("sentence number") == 6
