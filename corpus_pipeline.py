"""The corpus pipeline: five stages over the documents table, each one of the training-data operators.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last return the columns of documents.
Each stage decides over all rows its predecessor kept; a row goes on whole, with all its columns, or not at all.

Odd rows have a defined result in every stage. Empty tables give empty tables. Columns of any name go along; only ``copies``,
``rate`` and ``copy`` are replaced by the mix. Rows without a text, or with an empty one: never toxic; not good (a text
without words scores 0), so the quality stage drops them; no copies of each other; not contaminated; of size 0 in the mix,
which takes no words from them. Rows without a doc_id are judged by their text alone; the n-gram join drops them if an equal
text has a doc_id, and keeps one of equal ones. Repeated rows: scored alike; one is left by the n-gram join; mixed alike. Very
long texts are read whole. A score equal to the limit counts as toxic, or as good.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidal.llm import decontamination, mixing, ngram_join, quality, toxicity
from tidal.llm.common import read_table, without_ids, written
from tidal.llm.language import held_out

TOXIC_FROM = 0.7
GOOD_FROM = 0.5


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scoring below the limit; the model learns as in the toxicity query."""
    labels = read_table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~held_out("doc_id", 3, 1)))
    return toxicity.below(docs, model, TOXIC_FROM)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer trained on weak labels calls good."""
    return quality.at_least(docs, quality.fit(docs), GOOD_FROM)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    found = decontamination.contaminated(docs, read_table(spark, sf_dir, "benchmark"))
    return without_ids(docs, written(found.select("doc_id").distinct(), "contaminated"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for every copy taken of a document, with ``copies``, ``rate`` and ``copy``."""
    return mixing.mixed_copies(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality_classifier", quality_stage),
    ("ngram_join", ngram_join_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: Trained models, similarity links and rounding can't be put in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the mix as read back from Parquet."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
