"""Bounded summaries: heavy hitters and ranks, against brute force."""

import random
from collections import Counter
from functools import reduce

import pytest
from pyspark.sql import functions as F

from postlens.operators import heavy_hitters, rank_summary

COUNTS = "category int, keyword string, frequency bigint"


def counted(spark, counter):
    return spark.createDataFrame([(c, w, n) for (c, w), n in counter.items()], COUNTS).coalesce(1)


def batches(seed, parts=4, rows=900):
    rng = random.Random(seed)
    word = lambda: f"w{min(int(rng.paretovariate(0.7)), 80):02d}"
    return [Counter((rng.choice([0, 0, 1]), word()) for _ in range(rows)) for _ in range(parts)]


def brute_top(whole, n):
    out = set()
    for c in {c for c, _ in whole}:
        ranked = sorted(((w, k) for (d, w), k in whole.items() if d == c), key=lambda x: (-x[1], x[0]))
        out |= {(c, w, k) for w, k in ranked[:n]}
    return out


def test_bounds_hold_in_any_order_of_merging(spark):
    parts = batches(1)
    whole = sum(parts, Counter())
    summaries = [heavy_hitters.summarize(counted(spark, p), 12).collect() for p in parts]
    frame = lambda rows: spark.createDataFrame(rows, heavy_hitters.SUMMARY_SCHEMA)
    at_once = heavy_hitters.merge(reduce(lambda a, b: a.unionByName(b), map(frame, summaries)), 12)
    one_by_one = reduce(lambda a, b: frame(heavy_hitters.merge(a.unionByName(frame(b)), 12).collect()), summaries[::-1][1:], frame(summaries[-1]))
    for merged in (at_once, one_by_one):
        rows = merged.collect()
        missed = {r.category: r.missed for r in rows if r.keyword is None}
        listed = {(r.category, r.keyword): r for r in rows if r.keyword is not None}
        assert max(Counter(c for c, _ in listed).values()) <= 12 and all(r.missed == missed[r.category] for r in rows)
        for key, n in whole.items():
            assert (listed[key].low <= n <= listed[key].high) if key in listed else n <= missed[key[0]]


@pytest.mark.parametrize("size,n,recount", [(30, 3, False), (14, 10, True), (4, 4, True)])
def test_top_is_exact_and_recounts_only_if_bounds_need_it(spark, size, n, recount):
    parts = batches(2)
    summaries = [r for p in parts for r in heavy_hitters.summarize(counted(spark, p), size).collect()]
    merged = heavy_hitters.merge(spark.createDataFrame(summaries, heavy_hitters.SUMMARY_SCHEMA).coalesce(1), size)
    whole = sum(parts, Counter())
    full = counted(spark, whole)
    found = heavy_hitters.candidates(merged, n).collect()
    assert any(r.open or r.low < r.high for r in found) == recount
    # What needs no recount never looks at the occurrences.
    occurrences = full if recount else full.withColumn("frequency", F.raise_error(F.lit("read")).cast("bigint"))
    got = {tuple(r) for r in heavy_hitters.exact_top(merged, occurrences, n).collect()}
    assert got == brute_top(whole, n)
    if size == 4:
        assert any(r.open and r.keyword is None for r in found)
    if size == 14:
        assert any(r.low < r.high for r in found) and not any(r.open for r in found)


def reads_counted(spark, whole):
    """The words of a counter as rows of one occurrence each, and a count of how often a row was read."""
    reads = spark.sparkContext.accumulator(0)
    rows = [(c, w, 1) for (c, w), k in whole.items() for _ in range(k)]
    rdd = spark.sparkContext.parallelize(rows, 2).map(lambda r: (reads.add(1), r)[1])
    return spark.createDataFrame(rdd, COUNTS), reads, len(rows)


@pytest.mark.parametrize("classes", [[0], [1], [0, 1]])
def test_occurrences_are_read_once_with_words_that_are_left_out(spark, classes):
    """They used to be read once for the words in doubt and once more for the open classes, even if there were none."""
    # The first class has a word in doubt, the second is open.
    listed = [(0, "a", 5, 5, 2), (0, "b", 3, 6, 2), (0, None, 0, 2, 2), (1, "x", 1, 1, 4), (1, None, 0, 4, 4)]
    summary = spark.createDataFrame([r for r in listed if r[0] in classes], heavy_hitters.SUMMARY_SCHEMA).coalesce(1)
    whole = Counter({(0, "a"): 5, (0, "b"): 6, (0, "c"): 2, (1, "x"): 1, (1, "y"): 4})
    occurrences, reads, rows = reads_counted(spark, whole + Counter({(0, "left out"): 9, (1, "left out"): 9}))
    top = heavy_hitters.exact_top(summary, occurrences, 1, F.col("keyword") != "left out")
    assert {tuple(r) for r in top.collect()} == {r for r in [(0, "b", 6), (1, "y", 4)] if r[0] in classes}
    assert reads.value == rows


def test_a_summary_reads_its_counts_once(spark):
    whole = sum(batches(3), Counter())
    occurrences, reads, rows = reads_counted(spark, whole)
    counts = occurrences.groupBy("category", "keyword").agg(F.sum("frequency").alias("frequency"))
    plan = heavy_hitters.summarize(counts, 12)._jdf.queryExecution().toString().split("Physical Plan")[-1]
    assert plan.count("Scan ExistingRDD") == 1
    got = heavy_hitters.summarize(counts, 12).collect()
    assert sum(r.keyword is None for r in got) == 2 and sum(r.keyword is not None for r in got) == 24


def test_summary_of_nothing_and_of_few_words(spark):
    empty = heavy_hitters.summarize(counted(spark, {}), 3)
    assert empty.collect() == []
    one = heavy_hitters.summarize(counted(spark, {(1, "a"): 2}), 3)
    assert {tuple(r) for r in one.collect()} == {(1, "a", 2, 2, 0), (1, None, 0, 0, 0)}
    assert [tuple(r) for r in heavy_hitters.exact_top(heavy_hitters.merge(one.unionByName(empty), 3), counted(spark, {}), 5).collect()] == [(1, "a", 2)]


def values(spark, xs):
    return spark.createDataFrame([(float(x) if x is not None else None,) for x in xs], "v double").coalesce(2)


def check_ranks(found, data, bound):
    ordered = sorted(data)
    for r in found:
        rank = min(int(len(ordered) * r["quantile"]) + 1, len(ordered))
        below, upto = sum(x < r.value for x in ordered), sum(x <= r.value for x in ordered)
        assert r.rows == len(ordered) and r["rank"] == rank and upto >= rank
        assert below - rank + 1 <= r.error <= bound, r


def test_ranks_of_merged_and_folded_summaries(spark):
    rng = random.Random(4)
    data = [[rng.lognormvariate(0, 2) for _ in range(3000)], [5.0] * 500 + [float(rng.randrange(9)) for _ in range(400)], [1.5], [rng.gauss(-3, 1) for _ in range(1500)]]
    steps, of = 40, [0.0, 0.25, 0.5, 0.95, 0.99, 1.0]
    summaries = [spark.createDataFrame(rank_summary.summarize(values(spark, [*d, None]), "v", steps).collect(), rank_summary.SUMMARY_SCHEMA) for d in data]
    together = [x for d in data for x in d]
    union = lambda dfs: reduce(lambda a, b: a.unionByName(b), dfs)
    one = rank_summary.quantiles(union(summaries), of).collect()
    other = rank_summary.quantiles(union(summaries[::-1]), of).collect()
    assert sorted(one) == sorted(other) and len(one) == len(of)
    check_ranks(one, together, 1.1 * len(together) / steps + len(data))
    folded = spark.createDataFrame(rank_summary.fold(union(summaries[:3]), steps).collect(), rank_summary.SUMMARY_SCHEMA)
    assert folded.count() <= steps + 2
    assert folded.agg(F.sum("known")).first()[0] == sum(map(len, data[:3]))
    late = rank_summary.quantiles(union([folded, summaries[3]]), of).collect()
    check_ranks(late, together, 2.1 * len(together) / steps + len(data))


def test_ranks_of_nothing_one_value_and_ties(spark):
    assert rank_summary.quantiles(rank_summary.summarize(values(spark, [None]), "v"), [0.5]).collect() == []
    for xs in ([7], [7] * 50):
        [r] = rank_summary.quantiles(rank_summary.summarize(values(spark, xs), "v", 10), [0.5]).collect()
        assert (r.rows, r.value, r.error) == (len(xs), 7.0, 0)
