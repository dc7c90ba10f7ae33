"""Additive upserts and the state of the aggregate tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions.labels import label_name
from postlens.functions.numbers import percent
from postlens.operators.ranking import dedup_first
from postlens.operators.words import word_counts
from postlens.schema import LABEL_NAMES


def upsert_additive(target: DataFrame, delta: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Counters of the delta added to matching keys of the target, other keys inserted."""
    both = target.select(*keys, value).unionByName(delta.select(*keys, value))
    return both.groupBy(*keys).agg(F.sum(value).alias(value))


def daily_delta(
    df: DataFrame, ts: str = "timestamp", category: str = "category", source: str = "source"
) -> DataFrame:
    """Posts per (day, class, source)."""
    return df.groupBy(
        F.to_date(ts).alias("stat_date"), F.col(category).alias("category"), F.col(source).alias("source")
    ).agg(F.count(F.lit(1)).alias("post_count"))


def overall_delta(daily: DataFrame) -> DataFrame:
    """Posts per class, summed from the daily counts."""
    return daily.groupBy("category").agg(F.sum("post_count").alias("total_count"))


def keyword_delta(df: DataFrame, category: str = "category", text: str = "text") -> DataFrame:
    """Occurrences of each word per class."""
    return word_counts(df, [category], text, "frequency").withColumnRenamed("word", "keyword")


def with_percentage(df: DataFrame, count: str = "total_count", digits: int = 2) -> DataFrame:
    """Share of each row in the summed counter, as decimal(5, digits); 0 if the sum is 0.

    Meant for the folded class counters, of which there are a handful.
    """
    total = F.coalesce(F.sum(count).over(Window.partitionBy()), F.lit(0))
    return df.withColumn("percentage", percent(F.col(count), total, digits).cast(f"decimal(5,{digits})"))


def insert_if_absent(
    target: DataFrame, batch: DataFrame, key: str, order: Sequence[str | Column] | None = None
) -> DataFrame:
    """Target plus those batch rows whose key it lacks, one per key."""
    fresh = new_rows(target, batch, key, order)
    return target.unionByName(fresh.select(*target.columns))


def new_rows(
    target: DataFrame, batch: DataFrame, key: str, order: Sequence[str | Column] | None = None
) -> DataFrame:
    """Batch rows whose key the target lacks, one per key."""
    return absent(target, dedup_first(batch, key, order or [c for c in batch.columns if c != key]), key)


def absent(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Batch rows whose key the target lacks; of the target only the key is read.

    The target is first narrowed to the keys of the batch. In that join the batch is
    the side Spark may broadcast once its size allows, so that a large target is
    scanned in place and not shuffled; a large batch falls back to a shuffled join.
    """
    seen = target.select(key).join(batch.select(key), key, "left_semi")
    return batch.join(seen, key, "left_anti")


def seed_classes(
    state: DataFrame,
    names: Mapping[int, str] = LABEL_NAMES,
    category: str = "category",
    count: str = "total_count",
) -> DataFrame:
    """Every named class with its counter, 0 if it has none yet; other classes stay."""
    zeros = state.sparkSession.createDataFrame([(k, 0) for k in names], f"`{category}` int, `{count}` bigint")
    filled = upsert_additive(zeros, state, [category], count)
    return filled.select(category, label_name(F.col(category), names).alias("category_name"), count)
