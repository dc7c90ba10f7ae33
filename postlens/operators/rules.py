"""Keyword rules that stand in for, or next to, a trained model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions import presets
from postlens.functions import text as tx
from postlens.schema import NEUTRAL


def classify_first(
    df: DataFrame,
    text: str = "text",
    kw0: Sequence[str] = tuple(presets.FIRST_MATCH_SECURITY),
    kw1: Sequence[str] = tuple(presets.FIRST_MATCH_PRODUCTIVITY),
    out: str = "pred",
) -> DataFrame:
    """Class 0 if any of its keywords occurs, else 1 if any of its, else 2."""
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    return df.withColumn(
        out,
        F.when(tx.contains_any(lowered, kw0), 0).when(tx.contains_any(lowered, kw1), 1).otherwise(NEUTRAL),
    )


def classify_majority(
    df: DataFrame,
    text: str = "text",
    kw0: Sequence[str] = tuple(presets.MAJORITY_SECURITY),
    kw1: Sequence[str] = tuple(presets.MAJORITY_PRODUCTIVITY),
    out: str = "pred",
) -> DataFrame:
    """The class with more distinct keywords in the text; 2 on a tie."""
    s0, s1 = F.col("score0"), F.col("score1")
    return df.withColumns(
        {"score0": tx.keyword_hits(F.col(text), kw0), "score1": tx.keyword_hits(F.col(text), kw1)}
    ).withColumn(out, F.when(s0 > s1, 0).when(s1 > s0, 1).otherwise(NEUTRAL))


def weak_label(
    df: DataFrame,
    label: str = "label",
    text: str = "text",
    kw0: Sequence[str] = tuple(presets.WEAK_LABEL_SECURITY),
    kw1: Sequence[str] = tuple(presets.WEAK_LABEL_PRODUCTIVITY),
) -> DataFrame:
    """Fill a missing label with the first-match rule."""
    return fill_from_rule(classify_first(df, text, kw0, kw1, out="_rule"), "_rule", label).drop("_rule")


def fill_from_rule(df: DataFrame, rule: str, label: str = "label") -> DataFrame:
    """Fill a missing label with a rule's class that is there already."""
    return df.withColumn(label, F.coalesce(F.col(label), F.col(rule)))


def parse_label(
    df: DataFrame, reply: str = "reply", strict: bool = False, missing: int = -1, out: str = "label"
) -> DataFrame:
    return df.withColumn(out, tx.parsed_label(F.col(reply), strict, missing))


def render_prompt(df: DataFrame, template: str, text: str = "text", n: int = 800, out: str = "prompt") -> DataFrame:
    return df.withColumn(out, tx.prompt(F.col(text), template, n))
