"""Comparison of labellers, latency, throughput and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens.catalog.registry import query
from postlens.catalog.tables import (
    KW0,
    KW1,
    PAIRS_SQL,
    labelled_texts,
    posts,
    table,
    texts,
    with_labels,
    with_posts,
)
from postlens.operators import cleaning, evaluation, latency, quality, rules

_CLASSES = "(VALUES (0), (1), (2)) c(k)"


def pairs(spark, sf_dir):
    """Posts with their label, the first-match rule and the majority rule."""
    ruled = rules.classify_first(texts(spark, sf_dir), "text", KW0, KW1, out="rule")
    both = rules.classify_majority(ruled, "text", KW0, KW1)
    return with_labels(both, spark, sf_dir).select("post_id", "text", "label", "rule", "pred")


def labelled_pairs(spark, sf_dir):
    return cleaning.filter_labelled(pairs(spark, sf_dir))


@query(
    "c17_accuracy",
    with_posts(
        "SELECT avg(CAST(label = rule AS INTEGER)) AS accuracy FROM pairs WHERE label IS NOT NULL", PAIRS_SQL
    ),
)
def c17(spark, sf_dir):
    return evaluation.accuracy(labelled_pairs(spark, sf_dir), "label", "rule")


_METRICS_SQL = f"""metrics AS (
  SELECT k AS label, count(*) FILTER (label = k AND rule = k) AS tp,
         count(*) FILTER (rule = k) AS pp, count(*) FILTER (label = k) AS ap
  FROM pairs, {_CLASSES} WHERE label IS NOT NULL GROUP BY k
)"""
_P, _R = "coalesce(tp / nullif(pp, 0), 0)", "coalesce(tp / nullif(ap, 0), 0)"
_F1 = "coalesce(2 * tp / nullif(pp + ap, 0), 0)"


@query(
    "c18_weighted_metrics",
    with_posts(
        f"""SELECT round(sum({_P} * ap) / sum(ap), 6) AS w_precision, round(sum({_R} * ap) / sum(ap), 6) AS w_recall,
                   round(sum({_F1} * ap) / sum(ap), 6) AS w_f1 FROM metrics""",
        PAIRS_SQL,
        _METRICS_SQL,
    ),
)
def c18(spark, sf_dir):
    row = evaluation.weighted_metrics(labelled_pairs(spark, sf_dir), "label", "rule")
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


_STATUS = "CASE WHEN label IS NULL THEN 'ERROR' WHEN rule = label THEN 'MATCH' ELSE 'DIFF' END"


@query(
    "d11_agreement_rate",
    with_posts(
        """SELECT count(label) AS valid, count(*) FILTER (rule = label) AS agreements,
                  count(*) FILTER (rule <> label) AS disagreements,
                  round(100.0 * count(*) FILTER (rule = label) / count(label), 6)::DOUBLE AS rate FROM pairs""",
        PAIRS_SQL,
    ),
)
def d11(spark, sf_dir):
    # An unlabelled post stands for a labeller's error code.
    coded = pairs(spark, sf_dir).withColumn("label", F.coalesce("label", F.lit(-3)))
    return evaluation.agreement(coded, "rule", "label").withColumn("rate", F.round("rate", 6))


@query("d11_agreement_status", with_posts(f"SELECT post_id, {_STATUS} AS status FROM pairs", PAIRS_SQL))
def d11_status(spark, sf_dir):
    return evaluation.agreement_status(pairs(spark, sf_dir), "rule", "label").select("post_id", "status")


@query(
    "d12_confusion_matrix",
    with_posts(
        f"""SELECT a.k AS actual, b.k AS pred, count(post_id) AS n
            FROM {_CLASSES.replace('c(k)', 'a(k)')} CROSS JOIN {_CLASSES.replace('c(k)', 'b(k)')}
            LEFT JOIN pairs ON label = a.k AND rule = b.k GROUP BY a.k, b.k""",
        PAIRS_SQL,
    ),
)
def d12(spark, sf_dir):
    return evaluation.confusion_matrix(labelled_pairs(spark, sf_dir), "label", "rule")


@query(
    "d12_confusion_matrix_wide",
    with_posts(
        f"""SELECT k AS actual, count(*) FILTER (rule = 0) AS pred_0, count(*) FILTER (rule = 1) AS pred_1,
                   count(*) FILTER (rule = 2) AS pred_2 FROM {_CLASSES} LEFT JOIN pairs ON label = k GROUP BY k""",
        PAIRS_SQL,
    ),
)
def d12_wide(spark, sf_dir):
    return evaluation.confusion_matrix(labelled_pairs(spark, sf_dir), "label", "rule", wide=True)


@query(
    "d13_class_metrics",
    with_posts(
        f"""SELECT label, round({_P}, 6) AS precision, round({_R}, 6) AS recall, round({_F1}, 6) AS f1, ap AS support
            FROM metrics""",
        PAIRS_SQL,
        _METRICS_SQL,
    ),
)
def d13(spark, sf_dir):
    rows = evaluation.class_metrics(labelled_pairs(spark, sf_dir), "label", "rule")
    return rows.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(
    "d14_class_accuracy",
    with_posts(f"SELECT label, round({_R}, 6) AS accuracy FROM metrics", PAIRS_SQL, _METRICS_SQL),
)
def d14(spark, sf_dir):
    rows = evaluation.class_accuracy(labelled_pairs(spark, sf_dir), "label", "rule")
    return rows.withColumn("accuracy", F.round("accuracy", 6))


@query(
    "d15_paired_distribution",
    with_posts(
        f"""SELECT k AS label, count(*) FILTER (rule = k) AS count_a, count(*) FILTER (label = k) AS count_b
            FROM pairs, {_CLASSES} WHERE label IS NOT NULL GROUP BY k""",
        PAIRS_SQL,
    ),
)
def d15(spark, sf_dir):
    return evaluation.paired_distribution(pairs(spark, sf_dir), "rule", "label")


@query(
    "d16_disagreements_sample",
    with_posts(
        """SELECT post_id, substr(text, 1, 80) AS text_preview, rule AS a, label AS b FROM pairs
           WHERE rule <> label ORDER BY post_id LIMIT 5""",
        PAIRS_SQL,
    ),
)
def d16(spark, sf_dir):
    return evaluation.disagreements(pairs(spark, sf_dir), "rule", "label", n=5)


@query(
    "d16_disagreements_all",
    with_posts(
        """SELECT post_id, substr(text, 1, 80) AS text_preview, rule AS a, pred AS b FROM pairs WHERE rule <> pred""",
        PAIRS_SQL,
    ),
)
def d16_all(spark, sf_dir):
    return evaluation.disagreements(pairs(spark, sf_dir), "rule", "pred", n=None)


# The value of an event is taken as the milliseconds until it was consumed.
_LATENCY_SQL = """gaps AS (
  SELECT event_id, (epoch_us(ts + to_microseconds(CAST(round(value * 1000) AS BIGINT))) - epoch_us(ts)) / 1000.0::DOUBLE AS v
  FROM events
)"""


def consumed_events(spark, sf_dir):
    delay = F.make_dt_interval(secs=F.round(F.col("value") / 1000, 6).cast("decimal(18,6)"))
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", "ts", (F.col("ts") + delay).alias("consumed")
    )


_GAP_STATS_SQL = """ordered AS (
  SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS n FROM gaps
), gap_stats AS (
  SELECT count(*) AS n, round(avg(v), 2) AS avg, round(median(v), 2) AS median,
         round(max(v) FILTER (i = floor(n * 0.95::DOUBLE)), 2) AS p95,
         round(max(v) FILTER (i = floor(n * 0.99::DOUBLE)), 2) AS p99,
         round(min(v), 2) AS min, round(max(v), 2) AS max FROM ordered
)"""


@query("d17_latency_stats", f"WITH {_LATENCY_SQL}, {_GAP_STATS_SQL} SELECT * FROM gap_stats")
def d17(spark, sf_dir):
    return latency.latency_stats(consumed_events(spark, sf_dir), "ts", "consumed")


@query("i8_end_to_end_latency", f"WITH {_LATENCY_SQL} SELECT event_id, v AS latency_ms FROM gaps")
def i8(spark, sf_dir):
    return latency.with_latency(consumed_events(spark, sf_dir), "ts", "consumed").select("event_id", "latency_ms")


_THROUGHPUT_SQL = """throughput AS (
  SELECT CAST(sum(n) AS BIGINT) AS total, round((epoch_us(max(l)) - epoch_us(min(f))) / 1e6, 2) AS duration,
         round(sum(n) / ((epoch_us(max(l)) - epoch_us(min(f))) / 1e6), 2) AS avg_rate, max(n) AS peak_rate,
         CAST(sum(e) AS BIGINT) AS errors, round(100.0::DOUBLE * sum(e) / sum(n), 2) AS error_rate
  FROM (SELECT date_trunc('second', ts) AS s, count(*) AS n, count(*) FILTER (event_type = 'error') AS e,
               min(ts) AS f, max(ts) AS l FROM events GROUP BY 1)
)"""


@query("d18_throughput_stats", f"WITH {_THROUGHPUT_SQL} SELECT * FROM throughput")
def d18(spark, sf_dir):
    return latency.throughput_stats(table(spark, sf_dir, "events"), "ts", F.col("event_type") == "error")


@query(
    "d18_performance_report",
    f"""WITH {_LATENCY_SQL}, {_GAP_STATS_SQL}, {_THROUGHPUT_SQL}
        SELECT total AS total_posts, duration AS duration_seconds, avg_rate AS average_throughput,
               peak_rate AS peak_throughput, avg AS avg_latency_ms, median AS median_latency_ms,
               p95 AS p95_latency_ms, p99 AS p99_latency_ms, min AS min_latency_ms, max AS max_latency_ms,
               errors AS error_count, error_rate FROM throughput, gap_stats""",
)
def d18_report(spark, sf_dir):
    return latency.performance_report(consumed_events(spark, sf_dir), "ts", "consumed", F.col("event_type") == "error")


@query(
    "d19_threshold_flags",
    f"""WITH {_THROUGHPUT_SQL}
        SELECT metric, value, target, CASE
                 WHEN kind = 'min' AND value >= target THEN 'PASS'
                 WHEN kind = 'min' AND value >= target * 0.9::DOUBLE THEN 'ACCEPTABLE'
                 WHEN kind = 'min' THEN 'BELOW TARGET'
                 WHEN value < target THEN 'PASS' ELSE 'ABOVE TARGET' END AS status
        FROM (SELECT 'total' AS metric, CAST(total AS DOUBLE) AS value, 6800.0::DOUBLE AS target, 'min' AS kind FROM throughput
              UNION ALL SELECT 'avg_rate', avg_rate, 80.0, 'min' FROM throughput
              UNION ALL SELECT 'peak_rate', CAST(peak_rate AS DOUBLE), 2.1, 'min' FROM throughput
              UNION ALL SELECT 'error_rate', error_rate, 1000.0, 'max' FROM throughput)""",
)
def d19(spark, sf_dir):
    targets = {
        "total": (6800, "min"), "avg_rate": (80, "min"), "peak_rate": (2.1, "min"), "error_rate": (1000, "max"),
    }
    return evaluation.threshold_flags(d18(spark, sf_dir), targets)


_SOURCES = [f"src{i}" for i in range(15)]


@query(
    "k1_quality_checks",
    with_posts(
        "SELECT rule, violations FROM (SELECT "
        + ", ".join(
            f"count(*) FILTER ({c} IS NULL) AS {c}_present"
            for c in ("post_id", '"timestamp"', "source", "text", "label", "upvotes", "comments")
        ).replace('"timestamp"_present', "timestamp_present")
        + """, count(*) FILTER (label IS NULL OR label NOT IN (0, 1, 2)) AS label_in_range,
              count(*) FILTER (text IS NULL OR NOT regexp_matches(text, '\\S')) AS text_not_empty,
              count(*) FILTER (upvotes IS NULL OR upvotes < 0) AS upvotes_not_negative,
              count(*) FILTER (comments IS NULL OR comments < 0) AS comments_not_negative,
              count(*) FILTER (source NOT IN ("""
        + ", ".join(repr(s) for s in _SOURCES)
        + ")) AS source_allowed FROM posts) UNPIVOT (violations FOR rule IN (COLUMNS(*)))",
    ),
)
def k1(spark, sf_dir):
    return quality.quality_checks(posts(spark, sf_dir), quality.post_rules(sources=_SOURCES))


@query(
    "k2_label_balance_check",
    with_posts(
        """SELECT avg(CAST(label = 0 AS INTEGER)) AS share, avg(CAST(label = 0 AS INTEGER)) < 0.6 AS ok
           FROM posts WHERE label IS NOT NULL"""
    ),
)
def k2(spark, sf_dir):
    return quality.balance_check(cleaning.filter_labelled(labelled_texts(spark, sf_dir)))


@query(
    "g7_primary_key_check",
    "SELECT doc_id % 10 AS part, source, count(*) AS count FROM documents GROUP BY 1, 2 HAVING count(*) > 1",
)
def g7(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select((F.col("doc_id") % 10).alias("part"), "source")
    return quality.key_violations(rows, ["part", "source"])
