"""Exact order statistics, latency and throughput."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions import times
from postlens.functions.numbers import ratio


def quantile_columns(
    df: DataFrame,
    value: str,
    quantiles: Mapping[str, tuple[float, str]],
    aggregates: Sequence[Column] = (),
    accuracy: int = 100_000,
) -> DataFrame:
    """One row with exact quantiles of a non-null column, next to plain aggregates.

    Each quantile is `(q, "linear")`, interpolated between the rows around
    `(n - 1) * q`, or `(q, "nearest")`, the row at `floor(n * q)` counted from 0.

    Neither the rows nor their distinct values are ever sorted in one task. A first
    pass takes approximate quantiles a guaranteed distance on each side of every
    q; a second pass counts the rows outside each bracket and, per distinct value,
    those inside, so that only about 4 rows in `accuracy` are left to be ordered.
    """
    margin = 2.0 / accuracy
    fractions: list[float] = []
    for q, _ in quantiles.values():
        fractions += [max(0.0, q - margin), min(1.0, q + margin)]
    bounds = F.percentile_approx(value, fractions, accuracy).alias("_bounds")
    summary = df.agg(F.struct(bounds, *aggregates).alias("s")).scalar()

    v = F.col(value)
    places = []
    for i in range(len(quantiles)):
        low = F.get(summary.getField("_bounds"), F.lit(2 * i))
        high = F.get(summary.getField("_bounds"), F.lit(2 * i + 1))
        side = F.when(v < low, -1).when(v <= high, 0).otherwise(1)
        inside = F.when((v >= low) & (v <= high), v)
        places.append(F.struct(F.lit(i).alias("i"), side.alias("side"), inside.alias("inside"), v.alias("v")))
    counted = (
        df.select(F.explode(F.array(*places)).alias("p"))
        .select("p.*")
        .groupBy("i", "side", "inside")
        .agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
    )
    by_value = Window.partitionBy("i").orderBy("side", "inside")
    ranked = counted.withColumns(
        {"upto": F.sum("c").over(by_value), "n": F.sum("c").over(Window.partitionBy("i"))}
    )

    def at(i: int, index: Column) -> Column:
        # With few rows a bracket may miss the wanted row by one place; that row is
        # then the last one below the bracket or the first one above it.
        first, last = F.col("upto") - F.col("c"), F.col("upto") - 1
        found = (
            F.when((F.col("side") == 0) & index.between(first, last), F.col("least"))
            .when((F.col("side") == -1) & (index == last), F.col("most"))
            .when((F.col("side") == 1) & (index == first), F.col("least"))
        )
        return F.max(F.when(F.col("i") == i, found))

    parts, results = [], []
    for i, (name, (q, kind)) in enumerate(quantiles.items()):
        if kind == "nearest":
            parts.append(at(i, F.floor(F.col("n") * F.lit(q))).alias(name))
            results.append(F.col(name))
            continue
        place = (F.col("n") - 1) * F.lit(q)
        parts += [
            at(i, F.floor(place)).alias(f"_lo{i}"),
            at(i, F.ceil(place)).alias(f"_hi{i}"),
            F.max(F.when(F.col("i") == i, place - F.floor(place))).alias(f"_f{i}"),
        ]
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        results.append((low + (high - low) * F.col(f"_f{i}")).alias(name))
    picked = ranked.agg(*parts).select(*results)
    names = df.agg(*aggregates).columns if aggregates else []
    return picked.select("*", *[summary.getField(c).alias(c) for c in names])


def with_latency(
    df: DataFrame, start: str = "timestamp", end: str = "created_at", out: str = "latency_ms"
) -> DataFrame:
    return df.withColumn(out, times.elapsed_ms(F.col(start), F.col(end)))


def latency_stats(df: DataFrame, start: str, end: str, digits: int = 2) -> DataFrame:
    """n, average, median, p95, p99, min and max of `end - start` in milliseconds."""
    gaps = with_latency(df, start, end, "v").select("v").filter(F.col("v").isNotNull())
    stats = quantile_columns(
        gaps,
        "v",
        {"median": (0.5, "linear"), "p95": (0.95, "nearest"), "p99": (0.99, "nearest")},
        [F.count(F.lit(1)).alias("n"), F.avg("v").alias("avg"), F.min("v").alias("min"), F.max("v").alias("max")],
    )
    return stats.select(
        "n", *[F.round(c, digits).alias(c) for c in ("avg", "median", "p95", "p99", "min", "max")]
    )


def throughput_stats(df: DataFrame, ts: str = "ts", error: str | Column | None = None) -> DataFrame:
    """Totals, seconds, average and peak rows per second, errors and their share in %."""
    failed = F.lit(False) if error is None else (F.col(error) if isinstance(error, str) else error)
    per_second = df.groupBy(F.date_trunc("second", ts).alias("second")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(failed).alias("errors"),
        F.min(ts).alias("first"),
        F.max(ts).alias("last"),
    )
    whole = per_second.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
        F.coalesce(F.max("rows"), F.lit(0)).alias("peak_rate"),
        F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"),
        (times.elapsed_ms(F.min("first"), F.max("last")) / 1000).alias("seconds"),
    )
    return whole.select(
        "total",
        F.round(F.coalesce("seconds", F.lit(0.0)), 2).alias("duration"),
        F.round(ratio(F.col("total"), F.col("seconds")), 2).alias("avg_rate"),
        "peak_rate",
        "errors",
        F.round(ratio(F.col("errors"), F.col("total")) * 100, 2).alias("error_rate"),
    )


def performance_report(
    df: DataFrame, start: str, end: str, error: str | Column | None = None
) -> DataFrame:
    """One row with throughput by `start` and latency from `start` to `end`."""
    gaps = latency_stats(df, start, end).select(F.struct("*").alias("s")).scalar()
    fields = ("avg", "median", "p95", "p99", "min", "max")
    return throughput_stats(df, start, error).select(
        F.col("total").alias("total_posts"),
        F.col("duration").alias("duration_seconds"),
        F.col("avg_rate").alias("average_throughput"),
        F.col("peak_rate").alias("peak_throughput"),
        *[gaps.getField(c).alias(f"{c}_latency_ms") for c in fields],
        F.col("errors").alias("error_count"),
        "error_rate",
    )
