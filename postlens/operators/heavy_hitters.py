"""Frequent words per class from summaries of bounded size, made exact by counting only what their bounds leave open.

A summary has rows (category, keyword, low, high, missed): the word occurs at least `low` and
at most `high` times, and a word of the class that is not listed at most `missed` times. The
row without a keyword carries `missed` for the class. Bounds add up, so summaries of batches
can be merged in any order and grouping; each cut to `size` words raises `missed` to the
largest upper bound that it drops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.operators.ranking import top_per_group
from postlens.session import written

SUMMARY_SCHEMA = "category int, keyword string, low bigint, high bigint, missed bigint"


def _cut(words: DataFrame, size: int, others: DataFrame | None = None) -> DataFrame:
    """The `size` words of the largest upper bounds of each class; ties in the order of the words.

    `others` are the rows without a keyword that the classes have already.
    """
    order = [F.desc("high"), F.col("keyword")]
    first = top_per_group(words, ["category"], size + 1, order, by_task=True)
    placed = first.withColumn("place", F.row_number().over(Window.partitionBy("category").orderBy(*order)))
    if others is not None:
        placed = placed.unionByName(others.withColumn("place", F.lit(0)))
    dropped = F.max(F.when((F.col("place") > size) | F.col("keyword").isNull(), F.col("high")))
    # At most size + 2 rows of a class meet here.
    whole = Window.partitionBy("category")
    bounded = placed.withColumn("missed", F.coalesce(dropped.over(whole), F.lit(0)))
    bounded = bounded.withColumn("leads", F.row_number().over(whole.orderBy("place")) == 1)
    # The first row of a class also gives the row without a keyword, so that nothing is counted and ranked twice.
    listed = F.when((F.col("place") <= size) & F.col("keyword").isNotNull(), F.struct("keyword", "low", "high"))
    rest = F.when(F.col("leads"), F.struct(F.lit(None).cast("string").alias("keyword"), F.lit(0).cast("bigint").alias("low"), F.col("missed").alias("high")))
    rows = bounded.select("category", F.explode(F.array_compact(F.array(listed, rest))).alias("row"), "missed")
    return rows.select("category", "row.keyword", "row.low", "row.high", "missed")


def summarize(counts: DataFrame, size: int, category: str = "category", keyword: str = "keyword", count: str = "frequency") -> DataFrame:
    """The summary of exact counts, one row per class and word."""
    exact = F.col(count).cast("bigint")
    rows = counts.filter(F.col(keyword).isNotNull())
    return _cut(rows.select(F.col(category).alias("category"), F.col(keyword).alias("keyword"), exact.alias("low"), exact.alias("high")), size)


def merge(summaries: DataFrame, size: int) -> DataFrame:
    """One summary of the rows of any number of summaries."""
    added = summaries.groupBy("category", "keyword").agg(
        F.sum("low").alias("low"), F.sum(F.col("high") - F.col("missed")).alias("above"), F.sum("missed").alias("own")
    )
    # A summary that lists a word not at all may hide as many of it as it has missed.
    hidden = added.filter("keyword IS NULL").select("category", F.col("own").alias("hidden"))  # a row per class
    bounds = added.join(hidden, "category")
    bounds = bounds.select("category", "keyword", "low", (F.col("above") + F.col("hidden")).alias("high"))
    return _cut(bounds.filter("keyword IS NOT NULL"), size, bounds.filter("keyword IS NULL"))


def candidates(summary: DataFrame, n: int) -> DataFrame:
    """(category, keyword, low, high, open): the words that may be among the first `n` of their class.

    The n-th largest lower bound is reached by n words, so a word whose upper bound is
    less is none of them. A class is open, its one row without a keyword, if a word that is not listed may reach
    that bound: all of its words must be counted.
    """
    whole = Window.partitionBy("category")  # at most the size of the summary and one
    place = F.row_number().over(whole.orderBy(F.col("keyword").isNull(), F.desc("low"), "keyword"))
    ranked = summary.withColumn("place", place)
    reached = F.max(F.when((F.col("place") == n) & F.col("keyword").isNotNull(), F.col("low"))).over(whole)
    judged = ranked.withColumn("reached", F.coalesce(reached, F.lit(0)))
    judged = judged.withColumn("open", (F.col("missed") > 0) & (F.col("missed") >= F.col("reached")))
    wanted = F.when(F.col("open"), F.col("keyword").isNull()).otherwise(F.col("keyword").isNotNull() & (F.col("high") >= F.col("reached")))
    return judged.filter(wanted).select("category", "keyword", "low", "high", "open")


def exact_top(summary: DataFrame, occurrences: DataFrame, n: int, counts: Column | None = None) -> DataFrame:
    """(category, keyword, frequency): the first `n` words of every class with exact counts.

    `occurrences` (category, keyword, frequency) are what the summary was made of, counted or not, and
    are read, once, only if a candidate's bounds differ or a class is open; then only the words in
    doubt are shuffled. They may have words that were left out of the summary: `counts` holds
    for those that were not, and is looked at in open classes only, as a listed word was not left out.
    """
    found = written(candidates(summary, n), "candidates")
    sure = found.filter(~F.col("open") & (F.col("low") == F.col("high")))
    top = sure.select("category", "keyword", F.col("low").alias("frequency"))
    doubt = found.filter(~F.col("open") & (F.col("low") < F.col("high"))).select("category", "keyword")
    classes = found.filter("open").select("category")
    in_doubt = ~F.col("open") & (F.col("low") < F.col("high"))
    some = found.agg(F.count_if(F.col("open")).alias("classes"), F.count_if(in_doubt).alias("words")).first()
    if some["classes"] or some["words"]:
        again = occurrences.select("category", "keyword", "frequency")
        counts = F.lit(True) if counts is None else counts
        if not some["classes"]:
            again = again.join(doubt, ["category", "keyword"], "left_semi")
        elif not some["words"]:
            again = again.join(classes, "category", "left_semi").filter(counts)
        else:
            again = again.join(classes.withColumn("_open", F.lit(True)), "category", "left")
            again = again.join(doubt.withColumn("_doubt", F.lit(True)), ["category", "keyword"], "left")
            again = again.filter(F.col("_doubt") | (F.col("_open") & counts))
        top = top.unionByName(again.groupBy("category", "keyword").agg(F.sum("frequency").alias("frequency")))
    return top_per_group(top, ["category"], n, [F.desc("frequency"), F.col("keyword")], by_task=True)
