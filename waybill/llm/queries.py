"""Registered queries of the corpus operators, with production parameters, over whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import alignment, collocations, decontamination, exact_dedup, html, language, language_model, mixing, ngram_join, quality, quality_rules, sharding, toxicity
from waybill.llm.columns import fold
from waybill.llm.sql import ORACLE  # noqa: F401

SOURCE_WEIGHTS = {"src0": 2.0, "src1": 0.5}
SHARDS = [1.0] * 16
#: Folder of the public tokenizers' files.
TOKENIZERS = os.environ.get("WAYBILL_TOKENIZERS", "/opt/tokenizers")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Every copy of every document of one epoch in the target mix, in shuffled order."""
    return mixing.mixed(documents(spark, folder), SOURCE_WEIGHTS, epochs=1.0, seed=17)


def op2_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that holds a benchmark item, with the items."""
    return decontamination.report(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op3_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document by compression with dictionaries of good and bad text."""
    docs, labels = documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.fit(docs, labels, fold("doc_id", 4) != 2)
    return quality.scored(docs, model).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op4_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Near duplicates by five-word shingles at three quarters, and their components."""
    return ngram_join.near_duplicates(documents(spark, folder), width=5, percent=75)


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal texts; the row with the largest id stays."""
    return exact_dedup.equal_texts(documents(spark, folder), digest_all=True)


def op6_toxic_grammar(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document by the clause grammar."""
    docs, labels = documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(docs, labels, fold("doc_id", 5) != 0)
    return toxicity.measured(docs, model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "clauses"
    )


def op7_rendezvous_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards, and where they would be with one more."""
    return sharding.shard_sheet(documents(spark, folder), SHARDS, SHARDS + [1.0])


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, family first."""
    docs = documents(spark, folder)
    model = language.fit(docs, fold("doc_id", 4) != 2)
    return language.detected(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op9_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return html.extracted(spark.read.parquet(f"{folder}/pages.parquet"))


def op10_ngram_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Log10 probability of every document under a trigram model of six sevenths of them."""
    found = language_model.trained_and_scored(documents(spark, folder), fold("doc_id", 7) != 2)
    columns = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    return found.select("doc_id", (fold("doc_id", 7) == 2).alias("held_out"), *columns)


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 best phrases of two and three words of each language."""
    return collocations.collocations(documents(spark, folder), threshold=10, first=2000, percent=50)


def op12_token_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links, cuts and groups of byte-level and sentencepiece tokens of every document."""
    return alignment.alignment_report(documents(spark, folder), f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")


def op13_risk_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every document and whether the base rules and the certified cutoffs of its language keep it."""
    return quality_rules.verdicts(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


QUERIES = {f.__name__: f for f in (op1_source_mixing, op2_benchmark_leaks, op3_compression_quality, op4_ngram_join, op5_exact_dedup, op6_toxic_grammar, op7_rendezvous_shards, op8_language, op9_main_text, op10_ngram_trie, op11_collocations, op12_token_links, op13_risk_rules)}
