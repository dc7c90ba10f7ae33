"""From raw documents to token ids: language, exact copies, near copies, source mix, encoding.

Each stage takes (spark, docs, sf_dir) and returns rows; they are written as Parquet
below the shared folder and read again as the next stage's documents. All stages but
the last return the columns of `documents`.

Nulls, empty and very long texts, ties, repeated rows and empty tables are as each operator
states for itself: a null text has no letter and goes with the first stage. Columns that
stages add and drop again are named so that no column of the documents is lost, whatever
its name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.catalog.registry import query
from postlens.catalog.tables import table
from postlens.llm import bpe, exact_dedup, language_id, mixing, ngram_join
from postlens.llm.common import saved, unused
from postlens.llm.queries import TARGETS, vocabulary

MIN_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose likeliest language is less than even odds."""
    model = language_id.train(docs, ~language_id.held_out(), F.col("doc_id"))
    language, odds = unused(docs, "_likeliest_language"), unused(docs, "_language_odds")
    scored = language_id.predict(docs, model, pred_col=language, score_col=odds)
    known = (F.col(language) != language_id.UNDETERMINED) & (F.col(odds) >= MIN_SCORE)
    return scored.filter(known).drop(language, odds)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of equal texts."""
    return exact_dedup.kept_rows(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class linked by five-word shingles at a similarity of 0.8."""
    return ngram_join.one_per_class(docs, n=5, num=80, den=100)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that every source has the same share on average."""
    number = unused(docs, "_copy_number")
    return mixing.mix(docs, TARGETS, copy_col=number).drop(number)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of their decoding."""
    return bpe.encode_documents(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("ngram_jaccard", without_near_copies),
    ("mixing", mixed_sources),
    ("bpe", token_ids),
]
# Naive Bayes, set joins and byte-pair merges have no SQL form; tests compare the rows to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


query("pipeline", ORACLE_SQL)(run)
