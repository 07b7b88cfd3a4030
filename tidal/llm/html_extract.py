"""HTML extraction: a tree-structured graphical model over DOM nodes.

A page becomes a tree of block elements and text runs. Each node has one of three states: *mixed*
(holds both article and other parts), *content*, or *other*. The score of a labelling is the sum of
node potentials (log-linear in the node's features) and parent-child potentials (a 3 x 3 table per kind
of child). Marginals are exact: messages go up from the leaves and down from the root, level by level
for all pages of a batch at once in numpy. Text runs whose content marginal is at least one half make
up the main text.

The potentials are fitted by maximum likelihood on labelled pages (`training_pages`): page layouts with
a label on every part, filled with invented text of varied length. Class and id names are features, so
are tags, text length, link density, punctuation, place and share of the page's text.
"""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidal.llm.common import python_ready

MIXED, CONTENT, OTHER = 0, 1, 2
FEATURES = 1 << 13
PAGES_AT_ONCE = 256

# Elements of HTML by how they are read.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
                   "q ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style title noscript template svg iframe head object".split())
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 "
                     "h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
ITEMS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
         "th": ("tr", "table"), "option": ("select",)}
KINDS = {"#text": 0, "p": 1, "h1": 1, "h2": 1, "h3": 1, "h4": 1, "h5": 1, "h6": 1, "blockquote": 1, "pre": 1,
         "ul": 2, "ol": 2, "li": 2, "dl": 2, "table": 2, "tr": 2, "td": 2, "div": 3, "section": 3}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>"
                  r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>", re.S)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_LABEL = re.compile(r"\bdata-y\s*=\s*\"?([MCO])", re.I)
_WORD = re.compile(r"[a-z]+")
_end_tags: dict[str, re.Pattern] = {}


def _feature(name: str) -> int:
    return zlib.crc32(name.encode()) & (FEATURES - 1)


_known: dict[str, int] = {}


def _id(name: str) -> int:
    got = _known.get(name)
    if got is None:
        got = _feature(name)
        if len(_known) < 100_000:
            _known[name] = got
    return got


class Trees:
    """The nodes of a run of pages, as flat lists."""

    def __init__(self) -> None:
        self.page: list[int] = []
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.tag: list[str] = []
        self.names: list[tuple[str, ...]] = []
        self.text: list[str] = []
        self.linked: list[int] = []
        self.label: list[int] = []

    def _node(self, page: int, parent: int, tag: str, names: tuple[str, ...], label: int) -> int:
        self.page.append(page)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.tag.append(tag)
        self.names.append(names)
        self.text.append("")
        self.linked.append(0)
        self.label.append(label)
        return len(self.tag) - 1

    def add(self, page: int, source: str) -> None:
        """Parse one page. Malformed markup is read leniently; unclosed elements end with their parent."""
        root = self._node(page, -1, "#root", (), MIXED)
        stack: list[tuple[str, int]] = [("#root", root)]
        opened: dict[str, int] = {}
        run: list[str] = []
        linked = links = 0
        at, n = 0, len(source)

        def flush() -> None:
            nonlocal linked
            if run:
                text = " ".join("".join(run).split())
                if text:
                    top = stack[-1][1]
                    node = self._node(page, top, "#text", (), self.label[top])
                    self.text[node] = text
                    self.linked[node] = min(linked, len(text))
                run.clear()
            linked = 0

        def close(tag: str) -> None:
            while stack[-1][0] != tag:
                opened[stack.pop()[0]] -= 1
            opened[stack.pop()[0]] -= 1

        while at < n:
            m = _TAG.search(source, at)
            end = m.start() if m else n
            if end > at:
                piece = source[at:end]
                if "&" in piece:
                    piece = html.unescape(piece)
                run.append(piece)
                if links:
                    linked += len(piece.strip())
            if not m:
                break
            at = m.end()
            tag = m[2] or m[5]
            if tag is None:
                continue
            tag = tag.lower()
            closing = bool(m[1] or m[4])
            if tag in INLINE:
                if tag == "br":
                    run.append(" ")
                elif tag == "a":
                    links = 0 if closing else 1
                continue
            flush()
            links = 0
            if closing:
                if opened.get(tag):
                    close(tag)
                continue
            attributes = (m[3] if m[2] else m[6]) or ""
            if tag in SKIPPED:
                if tag == "head" or attributes.endswith("/"):
                    continue
                pattern = _end_tags.setdefault(tag, re.compile(rf"</{tag}\b[^>]*>", re.I))
                done = pattern.search(source, at)
                at = done.end() if done else n
                continue
            if tag in CLOSES_P and opened.get("p"):
                close("p")
            if tag in ITEMS and opened.get(tag):
                for name, _ in reversed(stack):
                    if name in ITEMS[tag]:
                        break
                    if name == tag:
                        close(tag)
                        break
            if tag in VOID:
                continue
            names: tuple[str, ...] = ()
            if attributes:
                names = tuple(w for a in _NAMED.finditer(attributes)
                              for w in _WORD.findall((a[2] or a[3] or a[4] or "").lower()))
                y = _LABEL.search(attributes)
            else:
                y = None
            top = stack[-1][1]
            label = "MCO".index(y[1].upper()) if y else (self.label[top])
            stack.append((tag, self._node(page, top, tag, names, label)))
            opened[tag] = opened.get(tag, 0) + 1
        flush()


@dataclass(frozen=True)
class Model:
    node: np.ndarray            # FEATURES x 3
    edge: np.ndarray            # kinds x 3 (parent) x 3 (child)


def _log2(x: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(x, 0) + 1)).astype(np.int64)


class Graph:
    """A forest as arrays: features of each node, levels and kinds."""

    def __init__(self, trees: Trees) -> None:
        n = len(trees.tag)
        self.n = n
        self.parent = np.array(trees.parent, np.int64)
        depth = np.array(trees.depth, np.int64)
        by_depth = np.argsort(depth, kind="stable")
        self.levels = np.split(by_depth, np.searchsorted(depth[by_depth], np.arange(1, int(depth.max(initial=0)) + 1)))[1:]
        self.kind = np.array([KINDS.get(t, 4) for t in trees.tag], np.int64)
        page = np.array(trees.page, np.int64)
        own = np.array([len(t) for t in trees.text], np.int64)
        linked = np.array(trees.linked, np.int64)
        runs = np.array([t == "#text" for t in trees.tag])
        long = (own >= 80).astype(np.int64)
        count = runs.astype(np.int64)
        total, link, big, leaves = own.copy(), linked.copy(), long, count
        big = big.copy()
        for level in reversed(self.levels):
            up = self.parent[level]
            for x in (total, link, big, leaves):
                np.add.at(x, up, x[level])
        roots = np.flatnonzero(self.parent < 0)
        whole = np.zeros(int(page.max(initial=-1)) + 1, np.int64)
        whole[page[roots]] = total[roots]
        before = np.cumsum(own) - own
        first = np.zeros(len(whole), np.int64)
        first[page[roots]] = before[roots]
        all_text = np.maximum(whole[page], 1)
        place = np.minimum((before - first[page]) * 10 // all_text, 9)
        share = total * 10 // all_text
        density = link * 5 // np.maximum(total, 1)
        stops = np.array([t[-1:] in ".!?:;" if t else False for t in trees.text])
        commas = np.array([min(t.count(","), 4) for t in trees.text], np.int64)
        nodes, features = [], []

        def put(where: np.ndarray, name: str, values: np.ndarray | None = None) -> None:
            if values is None:
                nodes.append(where)
                features.append(np.full(len(where), _id(name)))
                return
            low = int(values.min(initial=0))
            ids = np.array([_id(f"{name}={v}") for v in range(low, int(values.max(initial=0)) + 1)])
            nodes.append(where)
            features.append(ids[values - low])
        everything = np.arange(n)
        run_at, element = np.flatnonzero(runs), np.flatnonzero(~runs & (self.kind != 1))
        put(everything, "bias")
        tags = np.array([_id("tag " + t) for t in trees.tag])
        nodes.append(everything)
        features.append(tags)
        nodes.append(self.parent[self.parent >= 0])
        features.append(np.array([_id("child " + trees.tag[i]) for i in np.flatnonzero(self.parent >= 0)], np.int64))
        named = [(i, _id("name " + w)) for i, names in enumerate(trees.names) for w in names]
        if named:
            nodes.append(np.array([i for i, _ in named]))
            features.append(np.array([f for _, f in named]))
        put(run_at, "own", np.minimum(_log2(own[run_at]), 9))
        put(run_at, "link", density[run_at])
        put(run_at, "stop", (stops[run_at] * 5 + commas[run_at]).astype(np.int64))
        put(element, "size", np.minimum(_log2(total[element]), 10))
        put(element, "share", share[element])
        put(element, "density", density[element])
        put(element, "big", np.minimum(_log2(big[element]), 2))
        put(element, "mean", np.minimum(_log2(total[element] // np.maximum(leaves[element], 1)), 8))
        put(everything, "place", place)
        flat = np.concatenate(nodes)
        order = np.argsort(flat, kind="stable")
        self.node_of, self.features = flat[order], np.concatenate(features)[order]
        # the same child tag counts once a node
        key = np.unique(self.node_of * FEATURES + self.features)
        self.node_of, self.features = key // FEATURES, key % FEATURES

    def unary(self, model: Model) -> np.ndarray:
        out = np.zeros((self.n, 3))
        for k in range(3):
            out[:, k] = np.bincount(self.node_of, model.node[self.features, k], minlength=self.n)
        return out

    def marginals(self, model: Model) -> tuple[np.ndarray, np.ndarray, float]:
        """(node marginals, parent-child marginals, sum of log partition functions)."""
        belief = self.unary(model)
        up = np.zeros((self.n, 3))
        for level in reversed(self.levels):
            pair = model.edge[self.kind[level]] + belief[level][:, None, :]
            up[level] = _sum_exp(pair, 2)
            np.add.at(belief, self.parent[level], up[level])
        roots = np.flatnonzero(self.parent < 0)
        belief[roots] += np.array([0.0, -50.0, -50.0])      # a page as a whole is mixed
        log_z = _sum_exp(belief[roots], 1)
        pairs = np.zeros((self.n, 3, 3))
        for level in self.levels:
            p = self.parent[level]
            cavity = belief[p] - up[level]
            pair = model.edge[self.kind[level]] + belief[level][:, None, :] + cavity[:, :, None]
            belief[level] += _sum_exp(model.edge[self.kind[level]] + cavity[:, :, None], 1)
            pair -= pair.max((1, 2), keepdims=True)
            pairs[level] = np.exp(pair)
            pairs[level] /= pairs[level].sum((1, 2), keepdims=True)
        belief -= belief.max(1, keepdims=True)
        out = np.exp(belief)
        return out / out.sum(1, keepdims=True), pairs, float(log_z.sum())


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def fit(pages: list[str], epochs: int = 80, rate: float = 0.3, ridge: float = 2e-3) -> Model:
    """Maximum likelihood by AdaGrad on pages whose parts carry ``data-y`` labels (M, C or O)."""
    trees = Trees()
    for i, page in enumerate(pages):
        trees.add(i, page)
    g = Graph(trees)
    y = np.array(trees.label)
    y[g.parent < 0] = MIXED
    model = Model(np.zeros((FEATURES, 3)), np.zeros((5, 3, 3)))
    truth = np.zeros((g.n, 3))
    truth[np.arange(g.n), y] = 1
    child = np.flatnonzero(g.parent >= 0)
    true_pairs = np.zeros((5, 3, 3))
    np.add.at(true_pairs, (g.kind[child], y[g.parent[child]], y[child]), 1)
    seen_n, seen_e = np.full((FEATURES, 3), 1e-6), np.full((5, 3, 3), 1e-6)
    scale = 1 / len(pages)
    for _ in range(epochs):
        got, pairs, _ = g.marginals(model)
        gap = truth - got
        grad = np.stack([np.bincount(g.features, gap[g.node_of, k], minlength=FEATURES) for k in range(3)], 1)
        had = np.zeros((5, 3, 3))
        np.add.at(had, g.kind[child], pairs[child])
        grad = grad * scale - ridge * model.node
        edge = (true_pairs - had) * scale - ridge * model.edge
        seen_n += grad ** 2
        seen_e += edge ** 2
        model = Model(model.node + rate * grad / np.sqrt(seen_n), model.edge + rate * edge / np.sqrt(seen_e))
    return model


def main_text(pages: list[str], model: Model) -> list[str]:
    """The main text of each page: content blocks in page order, joined by blank lines."""
    out: list[list[str]] = [[] for _ in pages]
    trees = Trees()
    for i, page in enumerate(pages):
        trees.add(i, page)
    if trees.tag:
        got, _, _ = Graph(trees).marginals(model)
        for i in np.flatnonzero((got[:, CONTENT] >= 0.5) & np.array([t == "#text" for t in trees.tag])):
            out[trees.page[i]].append(trees.text[i])
    return ["\n\n".join(blocks) for blocks in out]


def _extractor(shared):
    def run(batches):
        model = shared.value
        for batch in batches:
            pages = batch.column("html").to_pylist()
            texts: list[str] = []
            group: list[str] = []
            size = 0
            for page in pages:
                group.append(page or "")
                size += len(group[-1])
                if len(group) >= PAGES_AT_ONCE or size >= 1 << 21:
                    texts += main_text(group, model)
                    group, size = [], 0
            texts += main_text(group, model) if group else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``; text is empty where no block is content.

    Null html is an empty page; null ids and urls are passed on; repeated rows are each extracted;
    columns besides page_id, url and html are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    python_ready(spark)
    if model is None:
        from tidal.llm.html_training import training_pages
        model = fit(training_pages())
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extractor(spark.sparkContext.broadcast(model)),
                           "page_id bigint, url string, text string, n_chars bigint")
