"""The registered queries of the training-data operators, over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidal.llm import (conversations, decontamination, fingerprints, html_extract, language, language_model, licenses,
                       merkle, mixing, ngram_join, quality, token_counts, toxicity)
from tidal.llm.common import read_table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_table(read_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    apart = language.held_out("doc_id", 3, 1)
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels").where(~apart))
    scored = toxicity.score(docs.withColumn("held_out", apart), model, ("doc_id", "held_out")).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs))
    return scored.withColumn("kept", (F.col("score") >= 0.5).cast("int"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(read_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(read_table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(licenses.document_files(read_table(spark, sf_dir, "documents")))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(read_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(read_table(spark, sf_dir, "conversations")), "gone")


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_toxicity": op2_toxicity,
    "op3_quality": op3_quality,
    "op4_ngram_join": op4_ngram_join,
    "op5_language_id": op5_language_id,
    "op6_mixing": op6_mixing,
    "op7_decontamination": op7_decontamination,
    "op8_fingerprints": op8_fingerprints,
    "op9_licenses": op9_licenses,
    "op10_html_extract": op10_html_extract,
    "op11_language_model": op11_language_model,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_conversation_repair": op13_conversation_repair,
}

#: The others can't be put in SQL as a whole; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op12_merkle_manifest": merkle.oracle(),
    "op13_conversation_repair": conversations.oracle(),
}
