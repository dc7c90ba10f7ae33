"""Serving views over the aggregate state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.labels import label_name
from postlens.operators.state import seed_classes, with_percentage


def daily_trends_view(state: DataFrame) -> DataFrame:
    """date, class name, source and posts; classes that share a name stay apart."""
    return (
        state.groupBy(F.to_date("stat_date").alias("date"), F.col("category").alias("_cls"), "source")
        .agg(F.sum("post_count").alias("post_count"))
        .select("date", label_name(F.col("_cls")).alias("category"), "source", "post_count")
    )


def overall_summary_view(state: DataFrame) -> DataFrame:
    """Class name, posts and percentage of every class, largest first."""
    seeded = with_percentage(seed_classes(state))
    return seeded.select(F.col("category_name").alias("category"), "total_count", "percentage").orderBy(
        F.desc("total_count"), "category"
    )


def top_keywords_view(state: DataFrame, n: int = 50) -> DataFrame:
    """The first `n` keywords over all classes, by class and then by count.

    `n` is one limit for the whole view, so a class rich in words can fill it.
    """
    first = state.orderBy("category", F.desc("frequency"), "keyword").limit(n)
    return first.select(label_name(F.col("category")).alias("category"), "keyword", "frequency")
