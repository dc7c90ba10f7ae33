"""Counts and shares of classes, days, sources and lengths."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions import times
from postlens.functions.labels import label_name
from postlens.functions.numbers import percent
from postlens.operators.latency import quantile_columns
from postlens.schema import LABEL_NAMES


def overall_breakdown(df: DataFrame, label: str = "label", digits: int = 1) -> DataFrame:
    """Count and percentage of each label. The total is summed over the counted rows."""
    counted = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return (
        counted.withColumn("percentage", percent(F.col("count"), total, digits))
        .withColumn("category", label_name(F.col(label)))
        .orderBy(label)
    )


def daily_trend(df: DataFrame, ts: str = "timestamp", label: str = "label") -> DataFrame:
    return (
        df.groupBy(times.day_string(F.col(ts)).alias("date"), label)
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("category", label_name(F.col(label)))
        .orderBy("date", label)
    )


def by_source(df: DataFrame, source: str = "source", label: str = "label") -> DataFrame:
    return (
        df.groupBy(source, label)
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("category", label_name(F.col(label)))
        .orderBy(source, label)
    )


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count")).orderBy(label)


def distribution_filled(
    df: DataFrame, label: str = "label", names: Mapping[int, str] = LABEL_NAMES, digits: int = 1
) -> DataFrame:
    """Count and percentage of every named class, also of absent ones.

    The percentage is of all rows, whichever class they have.
    """
    cls = F.col(label).cast("int")
    counted = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(cls == k).alias(f"_n{k}") for k in names],
    )
    rows = F.array(
        *[
            F.struct(F.lit(k).alias("label"), F.lit(v).alias("category"), F.col(f"_n{k}").alias("count"))
            for k, v in names.items()
        ]
    )
    return counted.select("_total", F.explode(rows).alias("r")).select(
        "r.*", percent(F.col("r.count"), F.col("_total"), digits).alias("percentage")
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count of each value, most frequent first; nulls are left out."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), col)
    )


def describe_length(df: DataFrame, text: str = "text") -> DataFrame:
    """Count, mean, sample deviation, extremes and interpolated quartiles of the text length.

    Rows are counted by length first; there are as many different lengths as the longest
    text has characters, at most, and the rest works on those.
    """
    lengths = df.select(F.length(text).cast("double").alias("v")).filter(F.col("v").isNotNull())
    counted = lengths.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    total, summed = F.sum("n"), F.sum(F.col("v") * F.col("n"))
    squares = F.sum(F.col("v") * F.col("v") * F.col("n"))
    spread = F.greatest(squares - summed * summed / total, F.lit(0.0)) / F.nullif(total - 1, F.lit(0))
    return counted.agg(
        F.coalesce(total, F.lit(0)).alias("count"),
        F.try_divide(summed, total).alias("mean"),
        F.when(total > 1, F.sqrt(spread)).alias("std"),
        F.min("v").alias("min"),
        *[F.percentile("v", q, F.col("n")).alias(f"p{round(100 * q)}") for q in (0.25, 0.5, 0.75)],
        F.max("v").alias("max"),
    )


def row_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))
