"""A training corpus in stages: each takes what its predecessor kept, written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tastecore.llm import langid, mixing, ngram_join, packing, secret_scan
from tastecore.llm.queries import MIX_SHARE, MIX_WEIGHTS, mix_domain, tokenizer_file
from tastecore.plans.staging import stage

MIN_LANGUAGE_SCORE = 0.25


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the corpus' languages; others, and those without a letter, go."""
    return langid.keep_identified(docs, langid.learn(langid.training_rows(docs)), MIN_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similar documents join: five words, 0.8 or more."""
    return ngram_join.one_of_each(docs, width=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced."""
    return secret_scan.redact(docs)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the rates say that bring the expected domain tokens to the target weights."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    classifier = mixing.learn_domains(docs, labels, mix_domain())
    return mixing.mixed(docs, classifier, MIX_WEIGHTS, MIX_SHARE)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequences and offsets."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), end_id=0, capacity=2048)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("ngram_jaccard", near_duplicates),
    ("secret_scan", secrets),
    ("soft_mixing", mixing_weights),
    ("best_fit_packing", packed),
]
#: SQL can state neither the learned filters nor the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
