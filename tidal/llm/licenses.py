"""License scans: sparse TF-IDF cosine to license templates, then inheritance from the nearest directory.

Every line of every file and every file as a whole is a segment. Terms are lower-case runs of letters and
digits, without the commonest words; a term's weight is its count times its idf over all files. The files of
every term are counted first (distinct term hashes with partial sums). Where a segment is read, terms that
aren't held in memory take the least idf their bucket of hashes can have: that bounds the cosine from above,
and only segments which may pass move, to be weighed by the idf of each of their terms. A segment is a notice
of the template with the greatest cosine if that passes the threshold, and a file has the license of its best
segment.

A file without a notice inherits: licence files (named LICENSE, LICENCE or COPYING) name the license of
their directory, and a file's ancestors are joined with those directories; the deepest one wins.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidal.llm.common import (NOT_ALNUM, lower_ascii, python_ready, span_hashes, text_chunks, word_spans,
                              written)

THRESHOLD = 0.55
BUCKET_BITS = 20
FREQUENT = 1e-3
# Short notices of common licenses, by SPDX identifier where there is one.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Apache License Version 2.0, January 2004", "SPDX-License-Identifier: Apache-2.0"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "SPDX-License-Identifier: GPL-3.0-or-later",
                "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation, either version 3"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "Creative Commons Attribution-NonCommercial 4.0 International"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "Creative Commons Attribution 4.0 International"],
    "Proprietary": ["All rights reserved.", "Copyright. All rights reserved."],
}
COMMON = frozenset("the of and this is are by in to or for as it a an any with without under you can".split())
LICENSE_FILE = r"(?i)^(licen[cs]e|copying)(\.[a-z0-9]+)?$"


def _terms(text: str) -> list[str]:
    return [t for t in re.findall(r"[a-z0-9]+", text.lower()) if t not in COMMON]


def _vocabulary() -> list[str]:
    return sorted({t for texts in TEMPLATES.values() for text in texts for t in _terms(text)})


def _hashes_of(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), NOT_ALNUM)
    return span_hashes(data, starts, ends)


def _own_terms(texts: pa.Array):
    """(first row, row bounds, bytes, start, row, hash) of every term but the commonest, for runs of texts."""
    common = np.sort(_hashes_of(sorted(COMMON)))
    for first, data, offsets in text_chunks(texts):
        low = lower_ascii(data)
        starts, ends, rows = word_spans(low, offsets, NOT_ALNUM)
        h = span_hashes(low, starts, ends)
        own = ~np.isin(h, common)
        yield first, offsets, low, starts[own], rows[own], h[own]


def _runs(key: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, h), sorted, and how often each is there."""
    order = np.lexsort((h, key))
    key, h = key[order], h[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(fresh)
    return key[at], h[at], np.diff(np.r_[at, len(key)])


def _files_by_term(batches):
    """(h, files): every term of a batch and the number of its rows that hold it."""
    for batch in batches:
        parts = [_runs(rows, h)[1] for _, _, _, _, rows, h in _own_terms(batch.column("text"))]
        h, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "files"])


def _idf(n_files: int, files: np.ndarray) -> np.ndarray:
    return np.log((1 + n_files) / (1 + files)) + 1


@dataclass(frozen=True)
class _Weights:
    hashes: np.ndarray          # sorted: the templates' terms and the frequent ones
    idf: np.ndarray             # of those
    least: np.ndarray           # per bucket (first bits of a hash): no term in it has a smaller idf
    shift: int                  # from a hash to its bucket
    licenses: tuple[str, ...]   # of the template variants, ascending
    templates: np.ndarray       # hashes x variants: unit vectors

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``hashes``, whether it is there)."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return at, self.hashes[at] == h


def _weights(terms: DataFrame, n_files: int) -> _Weights:
    """From the number of files of every term. Held: the templates' terms, those in a share ``FREQUENT`` of the files
    (at most 1,000 times the mean number of distinct terms of a file), and a sum per bucket."""
    words = _vocabulary()
    own = _hashes_of(words)
    frequent = terms.where((F.col("files") >= FREQUENT * n_files) | F.col("h").isin(own.view(np.int64).tolist())).toArrow()
    h = frequent.column("h").to_numpy().view(np.uint64)
    seen = dict(zip(h.tolist(), frequent.column("files").to_numpy().tolist(), strict=True))
    hashes = np.unique(np.r_[h, own])
    idf = _idf(n_files, np.array([seen.get(x, 0) for x in hashes.tolist()], float))
    sums = terms.groupBy(F.shiftrightunsigned("h", 64 - BUCKET_BITS).alias("b")).agg(F.sum("files").alias("files")).toArrow()
    files = np.zeros(1 << BUCKET_BITS)
    files[sums.column("b").to_numpy()] = sums.column("files").to_numpy()
    place = dict(zip(words, np.searchsorted(hashes, own).tolist(), strict=True))
    variants = sorted((name, i, text) for name, texts in TEMPLATES.items() for i, text in enumerate(texts))
    templates = np.zeros((len(hashes), len(variants)))
    for k, (_, _, text) in enumerate(variants):
        for t in _terms(text):
            templates[place[t], k] += idf[place[t]]
    templates /= np.sqrt((templates ** 2).sum(0))
    return _Weights(hashes, idf, _idf(n_files, np.minimum(files, n_files)), 64 - BUCKET_BITS, tuple(v[0] for v in variants), templates)


_NEAR = ("file string, row bigint, segment int, license string, dot double, inside double, "
         "other array<bigint>, counts array<int>")


def _near_notices(shared, threshold: float):
    """Segments that may pass the threshold: with the least idf of a bucket for terms that aren't held, a
    segment's length is no more and its cosine no less than the true one. Of those that stay, the terms
    that aren't held go along, to be weighed by their own idf."""
    def run(batches):
        weights = shared.value
        used = weights.templates.any(1)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            files = batch.column("file")
            for first, offsets, low, starts, rows, h in _own_terms(batch.column("text")):
                at, held = weights.find(h)
                known = held & used[at]
                if not known.any():
                    continue
                breaks = np.r_[0, np.cumsum(low == 0x0A)]
                lines = breaks[offsets[1:]] - breaks[offsets[:-1]]
                line = breaks[starts] - breaks[offsets[rows]] + 1
                # segment 0 is the whole text; a text of one line has no other
                for segment, use in ((np.zeros(len(h), np.int64), np.ones(len(h), bool)), (line, lines[rows] > 0)):
                    key = rows * (1 << 32) + segment
                    use = use & np.isin(key, np.unique(key[known & use]))
                    if use.any():
                        yield from _passing(weights, threshold, files, first, row, *_runs(key[use], h[use]))
            row += len(files)
    return run


def _passing(weights: _Weights, threshold: float, files: pa.Array, first: int, row: int, key, h, tf):
    at, held = weights.find(h)
    w = tf * np.where(held, weights.idf[at], weights.least[(h >> np.uint64(weights.shift)).astype(np.int64)])
    edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    of = np.repeat(np.arange(len(edge)), np.diff(np.r_[edge, len(key)]))
    inside = np.bincount(of, np.where(held, w * w, 0), minlength=len(edge))
    norm = np.sqrt(np.add.reduceat(w * w, edge))
    v = np.flatnonzero(held & weights.templates.any(1)[at])
    dots = np.stack([np.bincount(of[v], w[v] * weights.templates[at[v], k], minlength=len(edge))
                     for k in range(weights.templates.shape[1])], 1)
    top = dots.max(1)
    near = np.flatnonzero(top >= (threshold - 1e-9) * norm)
    if not len(near):
        return
    # of equal ones the last license by name
    best = dots.shape[1] - 1 - (dots >= (top - 1e-9 * norm)[:, None])[:, ::-1].argmax(1)
    left = ~held & np.isin(of, near)
    cuts = pa.array(np.r_[0, np.cumsum(np.bincount(of[left], minlength=len(edge))[near])].astype(np.int32))
    here = (key[edge[near]] >> 32)
    yield pa.RecordBatch.from_arrays(
        [files.take(pa.array(first + here)), pa.array(row + first + here),
         pa.array((key[edge[near]] & 0xFFFFFFFF).astype(np.int32)),
         pa.array([weights.licenses[k] for k in best[near]], pa.string()), pa.array(top[near]), pa.array(inside[near]),
         pa.ListArray.from_arrays(cuts, pa.array(h[left].view(np.int64))),
         pa.ListArray.from_arrays(cuts, pa.array(tf[left].astype(np.int32)))],
        names=["file", "row", "segment", "license", "dot", "inside", "other", "counts"])


def notices(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(file, license, cosine, segment): the best notice of each file that has one.

    ``files``: file, text. Rows repeating a file are scanned one by one; the best notice of any counts.
    """
    spark = files.sparkSession
    python_ready(spark)
    terms = written(files.select("text").mapInArrow(_files_by_term, "h bigint, files bigint").groupBy("h").agg(
        F.sum("files").alias("files")), "terms")
    n = files.count()
    shared = spark.sparkContext.broadcast(_weights(terms, n))
    near = written(files.mapInArrow(_near_notices(shared, threshold), _NEAR), "near")
    each = near.select("row", "segment", F.explode(F.arrays_zip("other", "counts")).alias("t")).select(
        "row", "segment", F.col("t.other").alias("h"), F.col("t.counts").alias("tf"))
    w = F.col("tf") * (F.log((1.0 + n) / (1.0 + F.col("files"))) + 1)
    outside = each.join(terms, "h").groupBy("row", "segment").agg(F.sum(w * w).alias("outside"))
    scored = near.select("file", "row", "segment", "license", "dot", "inside").join(
        outside, ["row", "segment"], "left").withColumn(
        "cosine", F.col("dot") / F.sqrt(F.col("inside") + F.coalesce("outside", F.lit(0.0))))
    best = scored.where(F.col("cosine") >= threshold).groupBy("file").agg(
        F.max(F.struct(F.round("cosine", 9).alias("cosine"), -F.col("segment"), "license")).alias("m"))
    return best.select("file", F.col("m.license").alias("license"), F.col("m.cosine").alias("cosine"),
                       (-F.col("m.col2")).alias("segment"))


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per distinct path: path, license, cosine, via ('notice', 'directory' or null), from_path.

    ``files``: path, text. Paths are split at slashes; a null path is left out; rows
    repeating a path are scanned one by one and the best notice of any counts. A null or empty text has no notice. A file without a notice has the
    license of the nearest directory above it that holds a licence file with one (of several in a
    directory, the first by name), else null. An empty table gives no rows.
    """
    rows = files.where("path is not null").select(F.regexp_replace("path", "/+", "/").alias("file"),
                                                  F.col("text").cast("string").alias("text"))
    found = written(notices(rows, threshold), "notices")
    paths = written(rows.select("file").distinct(), "paths")
    name = F.regexp_extract("file", r"([^/]*)$", 1)
    folder = F.regexp_replace("file", r"/?[^/]*$", "")
    own = found.where(name.rlike(LICENSE_FILE)).groupBy(folder.alias("folder")).agg(
        F.min(F.struct("file", "license")).alias("m")).select("folder", "m.file", "m.license")
    parts = F.split("folder", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.concat_ws("/", F.slice(parts, 1, k)))
    open_files = paths.join(found.select("file"), "file", "left_anti").withColumn("folder", folder)
    above = open_files.select(F.col("file").alias("path"), F.explode(F.array_distinct(up)).alias("folder"))
    nearest = above.join(own, "folder").groupBy("path").agg(
        F.max(F.struct(F.length("folder").alias("depth"), F.col("file").alias("from_path"), "license")).alias("m"))
    inherited = nearest.select(F.col("path").alias("file"), F.col("m.license").alias("above_license"), "m.from_path")
    out = paths.join(found, "file", "left").join(inherited, "file", "left")
    return out.select(F.col("file").alias("path"), F.coalesce("license", "above_license").alias("license"), "cosine",
                      F.when(F.col("license").isNotNull(), "notice").when(F.col("above_license").isNotNull(), "directory")
                      .alias("via"), "from_path")


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files of a repository: a folder per source, folders of 1,000 and of 50 ids in it; the
    first id of each folder is its licence file. Those without an id are one file of their source's folder."""
    i = F.col("doc_id")
    top = F.concat(F.coalesce("source", F.lit("unknown")), F.lit("/"))
    place = (F.when(i.isNull(), top).when(i % 1000 == 0, F.concat(top, F.lit("LICENSE.")))
             .when(i % 50 == 0, F.concat(top, F.floor(i / 1000), F.lit("/"), F.floor(i / 50), F.lit("/LICENSE.")))
             .otherwise(F.concat(top, F.floor(i / 1000), F.lit("/"), F.floor(i / 50), F.lit("/"))))
    return docs.select(F.concat(place, F.coalesce(i.cast("string"), F.lit("none.txt")), F.when(i % 50 != 0, F.lit(".txt")).otherwise("")).alias("path"), "text")
