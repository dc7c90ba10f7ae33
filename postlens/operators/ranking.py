"""Top rows overall and per group, and one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Parts of a group that are ranked apart before the whole group is.
SALTS = 64


def _columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def top_per_group(
    df: DataFrame, group: Sequence[str], n: int, order: Sequence[str | Column], salts: int = SALTS, by_task: bool = False
) -> DataFrame:
    """The first `n` rows of every group in the given order.

    Every group is first cut to `n` rows in each of its salted parts, which is exact
    because the first `n` rows of a group are among the first `n` of their parts; the
    rest, at most `salts * n` rows of a group, is ranked once more. The plan is the same
    for any `n`. Where Spark itself limits groups in the map tasks, the first step moves
    few rows. Rows that are equal in all columns share a part, or with `by_task` those of a
    map task, which then sends `n` rows of a group where it would send `salts` times as many.
    """
    order = _columns(order)
    hashable = [name for name, kind in df.dtypes if "map<" not in kind]
    dealt = F.spark_partition_id() if by_task else F.xxhash64(*[F.col(f"`{c}`") for c in hashable])
    salted = df.withColumn("_salt", F.pmod(dealt, F.lit(salts)))
    part = Window.partitionBy(*group, "_salt").orderBy(*order)
    cut = salted.withColumn("_rn", F.row_number().over(part)).filter(F.col("_rn") <= n).drop("_salt", "_rn")
    whole = Window.partitionBy(*group).orderBy(*order)
    return cut.withColumn("_rn", F.row_number().over(whole)).filter(F.col("_rn") <= n).drop("_rn")


def cap_per_group(df: DataFrame, group: str, n: int, order: Sequence[str | Column]) -> DataFrame:
    """At most `n` posts of each group."""
    return top_per_group(df, [group], n, order)


def sample_per_class(df: DataFrame, label: str, order: Sequence[str | Column], n: int = 3) -> DataFrame:
    """The first `n` rows of each class."""
    return top_per_group(df, [label], n, order)


def dedup_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in the given order (a frame has no input order).

    A task passes on one row of each of its keys, so a hot key is cut before the shuffle.
    """
    first = Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*_columns(order))
    return df.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") == 1).drop("_rn")


def top_posts(df: DataFrame, by: str = "upvotes", key: str = "post_id", n: int | None = None) -> DataFrame:
    """Posts by descending score; all of them, or the best `n`."""
    ranked = df.orderBy(F.desc(by), F.asc(key))
    return ranked if n is None else ranked.limit(n)


def head(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first `n` rows in the given order."""
    return df.orderBy(*_columns(order)).limit(n)
