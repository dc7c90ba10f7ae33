"""Data-quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions import text as tx
from postlens.schema import LABELS


def post_rules(
    sources: Sequence[str] = ("reddit", "twitter"),
    required: Sequence[str] = ("post_id", "timestamp", "source", "text", "label", "upvotes", "comments"),
    labels: Sequence[int] = LABELS,
) -> dict[str, Column]:
    """Condition that each row must meet, by rule name."""
    rules = {f"{c}_present": F.col(c).isNotNull() for c in required}
    rules["label_in_range"] = F.col("label").isin(*labels)
    rules["text_not_empty"] = tx.has_length(F.col("text"), 1)
    rules["upvotes_not_negative"] = F.col("upvotes") >= 0
    rules["comments_not_negative"] = F.col("comments") >= 0
    rules["source_allowed"] = F.col("source").isin(*sources)
    return rules


def quality_checks(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows that break each rule, in one scan. An undecidable rule counts as broken."""
    rules = post_rules() if rules is None else rules
    names = list(rules)
    counted = df.agg(
        *[F.count_if(~F.coalesce(rules[r], F.lit(False))).alias(f"_r{i}") for i, r in enumerate(names)]
    )
    rows = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.col(f"_r{i}").alias("violations")) for i, r in enumerate(names)]
    )
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def balance_check(df: DataFrame, label: str = "label", cls: int = 0, limit: float = 0.6) -> DataFrame:
    """Share of one class and whether it stays below the limit."""
    is_class = F.coalesce(F.col(label) == cls, F.lit(False)).cast("double")
    return df.agg(F.coalesce(F.avg(is_class), F.lit(0.0)).alias("share")).withColumn("ok", F.col("share") < limit)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)
