"""Edge cases on small hand-made frames."""

import random

import pytest
from pyspark.sql import functions as F

from postlens.functions import presets, times
from postlens.functions import text as tx
from postlens.functions.numbers import percent, ratio
from postlens.operators import cleaning, evaluation, latency, quality, ranking, reports, rules, state, words
from postlens.plans import views
from postlens.plans.reports import clean_posts


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def one(spark, column, value, kind="string"):
    """Value of a column expression over one input value."""
    return frame(spark, [(value,)], f"x {kind}").select(column.alias("y")).first()["y"]


# --- text -----------------------------------------------------------------


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, False),
        ("", False),
        ("short", False),
        ("x" * 30, True),
        ("[TAG] " + "x" * 29, False),
        ("[TAG] " + "x" * 30, True),
        ("\n\t " + "x" * 29 + "  \n", False),
        ("a" + " " * 28 + "b", True),
        ("a" + " " * 27 + "b", False),
        ("please BUY NOW " + "x" * 30, False),
        ("please buy\nnow " + "x" * 30, True),
        ("FREE stuff and some Bitcoin " + "x" * 30, False),
        ("free stuff\nand some bitcoin " + "x" * 30, True),
        ("free stuff\rand some bitcoin " + "x" * 30, False),
        ("Make Money Fast" + "x" * 30, False),
        ("check my profile" + "x" * 30, False),
        ("[unclosed " + "x" * 30, True),
        ("[a\nb]" + "x" * 20, False),
        ("[a\nb]" + "x" * 25, True),
    ],
)
def test_quality(spark, text, expected):
    assert one(spark, tx.is_quality(F.col("x")), text) is expected


@pytest.mark.parametrize(
    "title, short, long",
    [
        (None, "Unknown", "Unknown"),
        ("", "Unknown", "Unknown"),
        ("[P] mine", "P", "Project"),
        ("about [Tutorial] and [D]", "Tutorial", "Tutorial"),
        ("[P2] no letters only", "Unknown", "Unknown"),
        ("[Other]", "Other", "Other"),
    ],
)
def test_title_tag(spark, title, short, long):
    assert one(spark, tx.title_tag(F.col("x")), title) == short
    assert one(spark, tx.title_tag(F.col("x"), expand=True), title) == long


@pytest.mark.parametrize(
    "reply, label, strict",
    [
        (None, -1, -1),
        ("2", 2, 2),
        ("Answer: 1 or 0", 1, 1),
        ("SECURITY", 0, -2),
        ("a gain", 1, -2),
        ("这是安全问题", 0, -2),
        ("生产力", 1, -2),
        ("nothing 9", 2, -2),
        ("", 2, -2),
    ],
)
def test_parsed_label(spark, reply, label, strict):
    assert one(spark, tx.parsed_label(F.col("x")), reply) == label
    assert one(spark, tx.parsed_label(F.col("x"), strict=True), reply) == strict


@pytest.mark.parametrize(
    "body, blank, empty, never",
    [(None, "t", "t", "t. "), ("", "t", "t", "t. "), (" \n", "t", "t.  \n", "t.  \n"), ("b", "t. b", "t. b", "t. b")],
)
def test_combined(spark, body, blank, empty, never):
    for skip, expected in (("blank", blank), ("empty", empty), ("never", never)):
        assert one(spark, tx.combined(F.lit("t"), F.col("x"), ". ", skip), body) == expected
    with pytest.raises(ValueError):
        tx.combined(F.lit("t"), F.lit("b"), skip="no")


def test_first_line(spark):
    assert one(spark, tx.first_line(F.col("x")), "one\ntwo") == "one"
    assert one(spark, tx.first_line(F.col("x")), None) == ""


def test_prompt_cuts_the_text_only(spark):
    assert one(spark, tx.prompt(F.col("x"), "<{text}> end", 3), "abcdef") == "<abc> end"


def test_epoch_is_utc_in_any_session_zone(spark):
    df = frame(spark, [(0.0,), (1711929600.9,), (None,)], "e double")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Shanghai"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r[0] for r in df.select(times.epoch_string(F.col("e"))).collect()]
            assert got == ["1970-01-01 00:00:00", "2024-04-01 00:00:00", "1970-01-01 00:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_unparsable_time_is_null(spark):
    df = frame(spark, [("2024-01-02 03:04:05",), ("yesterday",), (None,), ("2024-13-01 00:00:00",)], "timestamp string")
    assert [r[0] is None for r in cleaning.parse_ts(df).collect()] == [False, True, True, True]
    iso = frame(spark, [("2026-03-25T10:30:00.123456",)], "timestamp string")
    assert cleaning.parse_ts(iso, fmt=None).first()[0].microsecond == 123456


# --- numbers --------------------------------------------------------------


def test_percent_rounds_half_up_on_integers(spark):
    df = frame(spark, [(1027, 2000), (1, 3), (2, 3), (0, 0), (5, 5)], "n bigint, t bigint")
    got = [r[0] for r in df.select(percent(F.col("n"), F.col("t"))).collect()]
    assert got == [51.4, 33.3, 66.7, 0.0, 100.0]
    assert one(spark, percent(F.col("x"), F.lit(3), 2), 1, "bigint") == 33.33


def test_ratio_of_nothing_is_zero(spark):
    assert one(spark, ratio(F.col("x"), F.lit(0)), 1, "bigint") == 0.0


# --- reports --------------------------------------------------------------


def test_breakdown_of_empty_and_single(spark):
    empty = frame(spark, [], "label int, text string, source string, timestamp timestamp")
    assert reports.overall_breakdown(empty).count() == 0
    assert reports.daily_trend(empty).count() == 0
    assert words.top_keywords(empty).count() == 0
    filled = reports.distribution_filled(empty).collect()
    assert [(r["label"], r["count"], r["percentage"]) for r in filled] == [(0, 0, 0.0), (1, 0, 0.0), (2, 0, 0.0)]
    single = frame(spark, [(1,)], "label int")
    row = reports.overall_breakdown(single).first()
    assert (row["count"], row["percentage"], row["category"]) == (1, 100.0, "Productivity Gain")


def test_breakdown_keeps_the_null_class(spark):
    got = reports.overall_breakdown(frame(spark, [(0,), (None,), (None,)], "label int")).collect()
    assert [(r["label"], r["count"], r["percentage"], r["category"]) for r in got] == [
        (None, 2, 66.7, None), (0, 1, 33.3, "Security Risk"),
    ]


def test_value_counts_drops_nulls_and_orders(spark):
    df = frame(spark, [("b",), ("a",), ("b",), (None,), ("c",)], "v string")
    assert [tuple(r) for r in reports.value_counts(df, "v").collect()] == [("b", 2), ("a", 1), ("c", 1)]


def test_report_orders(spark):
    df = frame(
        spark,
        [(1, "x", "2024-01-02 00:00:00", "beta beta alpha"), (0, "y", "2024-01-01 10:00:00", "gamma"),
         (1, "x", "2024-01-01 00:00:00", "alpha delta")],
        "label int, source string, timestamp string, text string",
    ).withColumn("timestamp", F.to_timestamp("timestamp"))
    assert [r["date"] for r in reports.daily_trend(df).collect()] == [
        "2024-01-01 00:00:00", "2024-01-01 00:00:00", "2024-01-02 00:00:00",
    ]
    assert [tuple(r)[:3] for r in reports.by_source(df).collect()] == [("x", 1, 2), ("y", 0, 1)]
    assert [tuple(r) for r in words.word_freq(df).collect()] == [
        (0, "gamma", 1), (1, "alpha", 2), (1, "beta", 2), (1, "delta", 1),
    ]


def test_top_keywords_keeps_ties(spark):
    text = " ".join(f"{chr(97 + i // 26)}{chr(97 + i % 26)}word" for i in range(30)) + " best best"
    got = words.top_keywords(frame(spark, [(0, text)], "label int, text string"), n=2).collect()
    assert len(got) == 31
    assert {(r["freq"], r["rank"]) for r in got} == {(2, 1), (1, 2)}


def test_words_are_plain_lower_case(spark):
    df = frame(spark, [(0, "  Tool's toolbox\tTOOLS été\nabc word. four")], "label int, text string")
    assert {r["word"] for r in words.word_counts(df).collect()} == {"toolbox", "tools", "four"}
    assert words.word_counts(frame(spark, [(0, None), (0, "")], "label int, text string")).count() == 0


def test_describe_length_against_brute_force(spark):
    import statistics

    rng = random.Random(1)
    lengths = [rng.choice([0, 5, 5, 7, rng.randrange(400)]) for _ in range(501)]
    row = reports.describe_length(frame(spark, [("x" * n,) for n in lengths] + [(None,)], "text string")).first()
    quartiles = statistics.quantiles(lengths, n=4, method="inclusive")
    assert [row["p25"], row["p50"], row["p75"]] == pytest.approx(quartiles)
    assert (row["count"], row["min"], row["max"]) == (501, min(lengths), max(lengths))
    assert row["std"] == pytest.approx(statistics.stdev(lengths))


@pytest.mark.parametrize("n", [1, 999, 1000, 1001, 2000])
def test_top_rows_of_a_hot_group(spark, n):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 5).otherwise(-1).alias("g"), (F.col("id") * 7919 % 6007).alias("v"), "id"
    )
    got = ranking.top_per_group(df, ["g"], n, [F.desc("v"), "id"], salts=5)
    by_group = {}
    for r in df.collect():
        by_group.setdefault(r["g"], []).append((-r["v"], r["id"]))
    expected = sorted((g, k) for g, rows in by_group.items() for _, k in sorted(rows)[:n])
    assert sorted((r["g"], r["id"]) for r in got.collect()) == expected


def test_describe_length_of_one_or_no_text(spark):
    [one] = reports.describe_length(frame(spark, [("abc",)], "text string")).collect()
    assert tuple(one) == (1, 3.0, None, 3.0, 3.0, 3.0, 3.0, 3.0)
    [none] = reports.describe_length(frame(spark, [(None,)], "text string")).collect()
    assert tuple(none) == (0, *[None] * 7)


# --- order statistics -----------------------------------------------------


def nearest(values, q):
    return sorted(values)[int(len(values) * q)]


def linear(values, q):
    ordered, place = sorted(values), (len(values) - 1) * q
    low = int(place)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (place - low)


@pytest.mark.parametrize("accuracy", [10, 100, 100_000])
@pytest.mark.parametrize("shape", ["spread", "ties", "constant", "hot", "two", "single"])
def test_quantiles_against_brute_force(spark, accuracy, shape):
    rng = random.Random(7)
    values = {
        "spread": [rng.gauss(0, 1e3) for _ in range(997)],
        "ties": [float(rng.randrange(5)) for _ in range(1000)],
        "constant": [3.5] * 250,
        "hot": [1.0] * 400 + [rng.random() * 9 for _ in range(600)],
        "two": [1.0, 2.0],
        "single": [4.0],
    }[shape]
    asked = {f"l{int(q * 100)}": (q, "linear") for q in (0.0, 0.25, 0.3, 0.5, 0.75, 1.0)}
    asked |= {f"n{int(q * 100)}": (q, "nearest") for q in (0.0, 0.5, 0.95, 0.99)}
    df = frame(spark, [(v,) for v in values], "v double").repartition(5)
    row = latency.quantile_columns(df, "v", asked, accuracy=accuracy).first()
    for name, (q, kind) in asked.items():
        expected = (linear if kind == "linear" else nearest)(values, q)
        assert row[name] == pytest.approx(expected), name


def test_latency_of_nothing(spark):
    row = latency.latency_stats(frame(spark, [], "a timestamp, b timestamp"), "a", "b").first()
    assert row["n"] == 0 and row["p99"] is None


def test_throughput(spark):
    df = frame(
        spark, [("2024-01-01 00:00:00", 0), ("2024-01-01 00:00:00", 1), ("2024-01-01 00:00:04", 0)], "ts string, e int"
    ).withColumn("ts", F.to_timestamp("ts"))
    row = latency.throughput_stats(df, "ts", F.col("e") == 1).first()
    assert tuple(row) == (3, 4.0, 0.75, 2, 1, 33.33)
    empty = latency.throughput_stats(df.filter("e > 5"), "ts").first()
    assert tuple(empty) == (0, 0.0, 0.0, 0, 0, 0.0)


# --- ranking and dedup ----------------------------------------------------


def test_dedup_first_with_a_hot_key(spark):
    data = [(1, i, f"t{i}") for i in range(500)] + [(k, 0, "x") for k in range(2, 20)]
    df = frame(spark, data, "post_id int, pos int, text string").repartition(7)
    got = ranking.dedup_first(df, "post_id", ["pos"])
    assert got.count() == 19
    assert got.filter("post_id = 1").first()["text"] == "t0"
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("n", [1, 3, 1000, 1500])
def test_cap_per_group_is_exact(spark, n):
    data = [("hot", i) for i in range(2500)] + [("cold", i) for i in range(10)]
    got = ranking.cap_per_group(frame(spark, data, "g string, k int").repartition(6), "g", n, ["k"])
    hot = sorted(r["k"] for r in got.collect() if r["g"] == "hot")
    assert hot == list(range(n))
    assert got.filter("g = 'cold'").count() == min(n, 10)
    assert got.columns == ["g", "k"]


def test_top_posts(spark):
    df = frame(spark, [(1, 5), (2, 9), (3, 9)], "post_id int, upvotes int")
    assert [r["post_id"] for r in ranking.top_posts(df, n=2).collect()] == [2, 3]
    assert [r["post_id"] for r in ranking.top_posts(df).collect()] == [2, 3, 1]


# --- clean-up -------------------------------------------------------------


def test_keyword_search_takes_the_first_keyword_and_copy(spark):
    df = frame(
        spark, [(1, "beta and ALPHA", 1), (1, "beta", 0), (2, "nothing", 0), (3, "Alpha", 0)], "post_id int, text string, g int"
    )
    got = {r["post_id"]: r["matched_keyword"] for r in cleaning.keyword_search(df, ["alpha", "beta"], order=["g"]).collect()}
    assert got == {1: "beta", 3: "alpha"}


def test_keyword_filter_over_title_and_body(spark):
    df = frame(spark, [("has Tool", None), (None, "no"), ("a", "toolbox")], "title string, selftext string")
    assert cleaning.keyword_filter(df, "TOOL", ["title", "selftext"]).count() == 2


def test_preview_defaults(spark):
    df = frame(spark, [(None, None, None), (7, "s", "abc"), (0, "s", "abcdef")], "category int, source string, text string")
    assert [r["line"] for r in cleaning.preview(df, 3).collect()] == [
        "[Neutral] [] ...", "[Unknown] [s] abc...", "[Security Risk] [s] abc...",
    ]


def test_recent_posts_takes_a_date(spark):
    df = frame(spark, [(1, "2024-01-01 00:00:00", 0), (2, "2024-01-08 00:00:00", 5)], "post_id int, t string, category int")
    df = df.withColumn("created_at", F.to_timestamp("t"))
    assert [r["post_id"] for r in cleaning.recent_posts(df).collect()] == [2, 1]
    late = cleaning.recent_posts(df, as_of="2024-01-09 00:00:00").collect()
    assert [(r["post_id"], r["category_name"]) for r in late] == [(2, "Neutral")]


def test_attrition_with_null_keys(spark):
    good, bad = "x" * 40, "x"
    df = frame(spark, [(1, good), (1, good), (None, good), (None, good), (2, bad)], "post_id int, text string")
    assert tuple(cleaning.clean_attrition(df).first()) == (5, 1, 20.0, 2, 2)
    assert tuple(cleaning.clean_attrition(df.limit(0)).first()) == (0, 0, 0.0, 0, 0)


def test_clean_posts_with_and_without_web_columns(spark):
    body = "a body that is certainly long enough to pass"
    plain = frame(
        spark, [(1, "2024-01-01 00:00:00", "reddit", "r/a", f"[D] head\n{body}", 1, 2), (1, "2024-01-02 00:00:00", "reddit", "r/a", body, 1, 2)],
        "post_id int, timestamp string, source string, subreddit string, text string, upvotes int, comments int",
    )
    row = clean_posts(plain, ["timestamp"]).collect()
    assert len(row) == 1
    assert (row[0]["title"], row[0]["post_type"], row[0]["user_id"]) == ("[D] head", "D", "unknown")
    web = plain.withColumns(
        {"title": F.lit("[Q] why"), "author": F.lit(None).cast("string"), "score": F.lit(3), "link_flair": F.lit("f")}
    )
    cleaned = clean_posts(web, ["timestamp"])
    assert cleaned.columns[-2:] == ["score", "link_flair"]
    assert (cleaned.first()["post_type"], cleaned.first()["user_id"]) == ("Q", "unknown")


def test_union_of_different_columns(spark):
    got = cleaning.union_sources([frame(spark, [(1, "a")], "k int, x string"), frame(spark, [(2, 3.0)], "k int, y double")])
    assert sorted(map(tuple, got.collect())) == [(1, "a", None), (2, None, 3.0)]


# --- rules and evaluation -------------------------------------------------


def test_rules(spark):
    df = frame(spark, [("Found a VULNERABILITY, faster now",), ("faster workflow",), (None,), ("hello",)], "text string")
    assert [r["pred"] for r in rules.classify_first(df).collect()] == [0, 1, 2, 2]
    got = rules.classify_majority(df).collect()
    assert [(r["score0"], r["score1"], r["pred"]) for r in got] == [(1, 1, 2), (0, 2, 1), (0, 0, 2), (0, 0, 2)]


def test_repeated_keyword_counts_once(spark):
    df = frame(spark, [("hack hack hack, faster workflow",)], "text string")
    assert rules.classify_majority(df).first()["pred"] == 1


def test_weak_label_keeps_known_labels(spark):
    df = frame(spark, [(2, "exploit"), (None, "exploit"), (None, "plain")], "label int, text string")
    assert [r["label"] for r in rules.weak_label(df).collect()] == [2, 0, 2]


def test_preset_lists_are_disjoint():
    assert not set(presets.WEAK_LABEL_SECURITY) & set(presets.WEAK_LABEL_PRODUCTIVITY)


def pairs_frame(spark, counts):
    data = [(a, b) for (a, b), n in counts.items() for _ in range(n)]
    return frame(spark, data, "a int, b int")


def test_saved_comparison_of_twenty(spark):
    """14 of 19 valid pairs agree; class 2 has precision 14/14 and recall 14/19."""
    df = pairs_frame(spark, {(2, 2): 14, (1, 2): 2, (0, 2): 3, (2, -2): 1})
    row = evaluation.agreement(df, "a", "b").first()
    assert (row["valid"], row["agreements"], row["disagreements"]) == (19, 14, 5)
    assert row["rate"] == pytest.approx(73.684, abs=1e-3)
    valid = evaluation.valid_pairs(df, "a", "b")
    by_class = {r["label"]: r for r in evaluation.class_metrics(valid, "b", "a").collect()}
    assert (by_class[2]["precision"], by_class[2]["support"]) == (1.0, 19)
    assert by_class[2]["recall"] == pytest.approx(14 / 19)
    assert by_class[2]["f1"] == pytest.approx(28 / 33)
    for cls in (0, 1):
        assert [by_class[cls][c] for c in ("precision", "recall", "f1", "support")] == [0.0, 0.0, 0.0, 0]


def test_saved_comparison_of_fifteen(spark):
    df = pairs_frame(spark, {(2, 2): 12, (1, 2): 1, (0, 1): 1, (2, -3): 1})
    row = evaluation.agreement(df, "a", "b").first()
    assert (row["valid"], row["agreements"]) == (14, 12)
    assert row["rate"] == pytest.approx(85.714, abs=1e-3)
    assert evaluation.disagreements(df.withColumn("post_id", F.monotonically_increasing_id()).withColumn("text", F.lit("t")), "a", "b").count() == 2
    status = {r["status"] for r in evaluation.agreement_status(df, "a", "b").collect()}
    assert status == {"MATCH", "DIFF", "ERROR"}


def test_confusion_matrix_fills_absent_pairs(spark):
    df = pairs_frame(spark, {(0, 0): 2, (0, 1): 1})
    long = {(r["actual"], r["pred"]): r["n"] for r in evaluation.confusion_matrix(df, "a", "b").collect()}
    assert len(long) == 9 and long[0, 0] == 2 and long[0, 1] == 1 and sum(long.values()) == 3
    wide = evaluation.confusion_matrix(df, "a", "b", wide=True).collect()
    assert [tuple(r) for r in wide] == [(0, 2, 1, 0), (1, 0, 0, 0), (2, 0, 0, 0)]
    empty = evaluation.confusion_matrix(df.limit(0), "a", "b").collect()
    assert sum(r["n"] for r in empty) == 0 and len(empty) == 9


def test_threshold_levels(spark):
    df = frame(spark, [(0.92, 0.83, 0.5, 900.0)], "a double, b double, c double, d double")
    targets = {"a": (0.92, "min"), "b": (0.92, "min"), "c": (0.92, "min"), "d": (1000, "max")}
    got = {r["metric"]: r["status"] for r in evaluation.threshold_flags(df, targets).collect()}
    assert got == {"a": "PASS", "b": "ACCEPTABLE", "c": "BELOW TARGET", "d": "PASS"}


# --- quality and state ----------------------------------------------------


def test_quality_rules(spark):
    df = frame(
        spark,
        [(1, "t", "reddit", "ok", 0, 0, 0), (2, "t", "blog", " \n", 9, -1, -5), (None, None, None, None, None, None, None)],
        "post_id int, timestamp string, source string, text string, label int, upvotes int, comments int",
    )
    got = {r["rule"]: r["violations"] for r in quality.quality_checks(df).collect()}
    assert got["post_id_present"] == 1
    assert all(got[r] == 2 for r in ("label_in_range", "text_not_empty", "upvotes_not_negative", "comments_not_negative", "source_allowed"))
    assert all(r["violations"] == 0 for r in quality.quality_checks(df.limit(0)).collect())


def test_balance(spark):
    assert tuple(quality.balance_check(frame(spark, [(0,), (0,), (1,)], "label int")).first()) == (pytest.approx(2 / 3), False)
    assert tuple(quality.balance_check(frame(spark, [], "label int")).first()) == (0.0, True)


def test_key_violations(spark):
    df = frame(spark, [(1, "a"), (1, "a"), (1, "b")], "k int, s string")
    assert [tuple(r) for r in quality.key_violations(df, ["k", "s"]).collect()] == [(1, "a", 2)]


def test_upsert_adds_and_inserts(spark, rows):
    target = frame(spark, [(0, 5), (1, 1)], "category int, total_count bigint")
    delta = frame(spark, [(1, 2), (2, 7)], "category int, total_count bigint")
    assert rows(state.upsert_additive(target, delta, ["category"], "total_count")) == [(0, 5), (1, 3), (2, 7)]
    assert rows(state.upsert_additive(target.limit(0), delta, ["category"], "total_count")) == [(1, 2), (2, 7)]


def test_percentage_of_zero_total(spark):
    zero = frame(spark, [(0, 0), (1, 0)], "category int, total_count bigint")
    assert {str(r["percentage"]) for r in state.with_percentage(zero).collect()} == {"0.00"}


def test_insert_if_absent_keeps_the_stored_row(spark, rows):
    target = frame(spark, [(1, "old")], "post_id int, text string")
    batch = frame(spark, [(1, "new"), (2, "b"), (2, "a")], "post_id int, text string")
    assert rows(state.insert_if_absent(target, batch, "post_id", ["text"])) == [(1, "old"), (2, "a")]


def test_views(spark):
    empty = frame(spark, [], "category int, total_count bigint")
    summary = views.overall_summary_view(empty).collect()
    assert [r["category"] for r in summary] == ["Neutral", "Productivity Gain", "Security Risk"]
    assert {r["total_count"] for r in summary} == {0}
    keywords = frame(spark, [(1, "b", 9), (0, "z", 1), (0, "a", 1), (0, "c", 5)], "category int, keyword string, frequency bigint")
    top = views.top_keywords_view(keywords, 3).collect()
    assert [(r["category"], r["keyword"]) for r in top] == [("Security Risk", k) for k in ("c", "a", "z")]
