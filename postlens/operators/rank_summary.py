"""Quantiles of a growing column from summaries that can be merged in any order, with the rank error they really have.

A summary has rows (value, prev, known, unsure), its values in ascending order: `known` rows
are over `prev` and up to `value`, and `unsure` of them are less than `value`. The first
value is the least of all and has no `prev`. So a summary tells, for any number, between
which two ranks it falls; these bounds add up over summaries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SUMMARY_SCHEMA = "value double, prev double, known bigint, unsure bigint"
STEPS = 256


def summarize(df: DataFrame, value: str, steps: int = STEPS, accuracy_per_step: int = 20) -> DataFrame:
    """At most `steps` + 1 rows on the non-null values of a column; each is one of them.

    Approximate quantiles give the steps, a second pass counts each step exactly, in the map
    tasks first. No value is sorted. A step has about rows / `steps` unsure rows, by
    the approximation at most a tenth more; rows that equal its value are never unsure.
    """
    rows = df.select(F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    fractions = [i / steps for i in range(1, steps)] or [0.5]
    ends = F.array(F.min("v"), F.max("v"))
    cuts = rows.agg(F.array_sort(F.array_distinct(F.concat(ends, F.percentile_approx("v", fractions, steps * accuracy_per_step)))).alias("c")).scalar()
    place = F.size(F.filter(F.col("cuts"), lambda c: c < F.col("v")))
    stepped = rows.withColumn("cuts", cuts).select("v", place.alias("i"), F.get("cuts", place).alias("value"), F.when(place > 0, F.get("cuts", place - 1)).alias("prev"))
    return stepped.groupBy("i", "value", "prev").agg(
        F.count(F.lit(1)).alias("known"), F.count_if(F.col("v") < F.col("value")).alias("unsure")
    ).drop("i")


def ranks(summaries: DataFrame) -> DataFrame:
    """(value, low, high, before): at least `low` and at most `high` rows are up to the value, and at most `before` are less.

    The rows of all summaries are ordered in one task: as many as steps times summaries; `fold` bounds them.
    """
    zero = F.lit(0).cast("bigint")
    ends = summaries.select("value", "known", (-F.col("unsure")).alias("unsure"))
    begins = summaries.filter("prev IS NOT NULL").select(F.col("prev").alias("value"), zero.alias("known"), "unsure")
    changes = ends.unionByName(begins).groupBy("value").agg(F.sum("known").alias("known"), F.sum("unsure").alias("unsure"))
    upto = Window.partitionBy().orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    low, open_rows = F.sum("known").over(upto), F.sum("unsure").over(upto)
    curve = changes.select("value", low.alias("low"), (low + open_rows).alias("high"))
    return curve.withColumn("before", F.coalesce(F.lag("high").over(Window.partitionBy().orderBy("value")), zero))


def fold(summaries: DataFrame, steps: int = STEPS) -> DataFrame:
    """One summary of about `steps` rows for any number of them; the rank error grows by rows / `steps` at most."""
    curve = ranks(summaries)
    ordered = Window.partitionBy().orderBy("value")
    whole = Window.partitionBy()
    step = F.floor(F.col("low") * F.lit(steps) / F.max("low").over(whole))
    stepped = curve.withColumn("step", step).withColumn("earlier", F.lag("step").over(ordered))
    kept = stepped.filter(F.col("earlier").isNull() | (F.col("step") > F.col("earlier")))
    below = F.coalesce(F.lag("low").over(ordered), F.lit(0))
    return kept.select(
        "value", F.lag("value").over(ordered).alias("prev"), (F.col("low") - below).alias("known"),
        F.when(F.lag("value").over(ordered).isNull(), 0).otherwise(F.col("before") - below).cast("bigint").alias("unsure"),
    )


def quantiles(summaries: DataFrame, of: Sequence[float]) -> DataFrame:
    """(quantile, rows, rank, value, error): the value at rank `floor(rows * q) + 1`, the last at most.

    The rows that equal the value have a rank that is at most `error` above that one, and none below:
    it is never less than the true quantile. No row if there are no values.
    """
    curve = ranks(summaries)
    total = curve.agg(F.max("low").alias("n")).scalar()
    wanted = F.array(*[F.struct(F.lit(float(q)).alias("q"), F.least(F.floor(F.col("n") * F.lit(float(q))) + 1, F.col("n")).alias("rank")) for q in of])
    places = curve.withColumn("n", total).select("value", "low", "before", "n", F.explode(wanted).alias("w"))
    reached = places.filter(F.col("low") >= F.col("w.rank")).groupBy("w.q", "n", "w.rank").agg(F.min(F.struct("value", "before")).alias("at"))
    return reached.select(
        F.col("q").alias("quantile"), F.col("n").alias("rows"), "rank", "at.value",
        F.greatest(F.col("at.before") - F.col("rank") + 1, F.lit(0)).alias("error"),
    )
