"""Scans, messages and sinks, each written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.catalog.evaluation_queries import pairs
from postlens.catalog.registry import query
from postlens.catalog.report_queries import _WORDS_SQL
from postlens.catalog.tables import (
    KW0,
    KW1,
    PAIRS_SQL,
    RULE_SQL,
    labelled_texts,
    posts,
    posts_as_text,
    table,
    utc,
    with_posts,
)
from postlens.operators import cleaning, evaluation, rules, words
from postlens.plans.reports import export_reports
from postlens.schema import post_schema
from postlens.session import new_path
from postlens.sources import codec, readers, writers

_ALL_SQL = """post_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", source, subreddit, text,
              upvotes, comments, label"""


@query("a1_scan_csv", with_posts(f"SELECT {_ALL_SQL} FROM posts"))
def a1(spark, sf_dir):
    path = new_path(spark, "posts-csv")
    writers.write_csv(posts_as_text(spark, sf_dir), path)
    return readers.read_posts_csv(spark, path, post_schema(labelled=True))


@query("a2_scan_typed_rows", with_posts(f"SELECT * REPLACE ('t3_' || post_id AS post_id) FROM (SELECT {_ALL_SQL} FROM posts)"))
def a2(spark, sf_dir):
    path = new_path(spark, "web-posts-csv")
    web = posts_as_text(spark, sf_dir).withColumn("post_id", F.concat(F.lit("t3_"), "post_id"))
    writers.write_csv(web, path)
    return readers.read_posts_csv(spark, path, post_schema(T.StringType(), labelled=True))


@query("a3_sink_csv", with_posts("SELECT label, word, freq FROM words", _WORDS_SQL))
def a3(spark, sf_dir):
    path = new_path(spark, "word-freq-csv")
    writers.write_csv(words.word_counts(labelled_texts(spark, sf_dir)), path)
    return readers.read_posts_csv(spark, path, "label int, word string, freq bigint", multi_line=False)


@query(
    "a4_sink_csv_overwrite",
    with_posts(
        f"""SELECT post_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", source, text,
                   {RULE_SQL} AS category FROM posts"""
    ),
)
def a4(spark, sf_dir):
    path = new_path(spark, "classified-csv")
    rows = cleaning.project_classified(rules.classify_first(posts_as_text(spark, sf_dir), "text", KW0, KW1), "pred")
    writers.write_csv(rows.filter("category = 0"), path)
    writers.write_csv(rows, path)
    return readers.read_posts_csv(spark, path, rows.schema)


@query(
    "a6_decode_json",
    """SELECT event_id AS post_id, CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END
              AS upvotes FROM events""",
)
def a6(spark, sf_dir):
    # The counter of an error event is not a number, which must cost that field only.
    number = F.when(F.col("event_type") == "error", F.lit('"many"')).otherwise(F.get_json_object("props", "$.k"))
    value = F.format_string('{"post_id": %d, "upvotes": %s}', "event_id", number)
    messages = table(spark, sf_dir, "events").select(value.cast("binary").alias("value"))
    return codec.decode_posts(messages).select("post_id", "upvotes")


@query("a7_encode_json", with_posts(f"SELECT {_ALL_SQL} FROM posts"))
def a7(spark, sf_dir):
    messages = codec.to_payload(posts_as_text(spark, sf_dir))
    return codec.decode_posts(messages, post_schema(labelled=True))


@query(
    "a10_sink_json_report",
    with_posts(
        """SELECT count(label) AS valid, count(*) FILTER (rule = label) AS agreements,
                  count(*) FILTER (rule <> label) AS disagreements,
                  round(100.0 * count(*) FILTER (rule = label) / count(label), 6)::DOUBLE AS rate,
                  count(label) AS result_rows FROM pairs""",
        PAIRS_SQL,
    ),
)
def a10(spark, sf_dir):
    path = new_path(spark, "comparison")
    both = pairs(spark, sf_dir)
    metrics = evaluation.agreement(both, "rule", "label").withColumn("rate", F.round("rate", 6))
    rows = evaluation.valid_pairs(both, "rule", "label").select("post_id", "rule", "label")
    writers.write_report(metrics, rows, path)
    stored = spark.read.schema(metrics.schema).json(f"{path}/metrics")
    counted = spark.read.schema(rows.schema).json(f"{path}/results").agg(F.count("post_id").alias("n"))
    return stored.withColumn("result_rows", counted.scalar())


def api_responses(spark, sf_dir):
    """Posts as pages of a web API: 20 posts to a page by id, failed pages among them."""
    rows = posts(spark, sf_dir)
    item = F.struct(
        F.concat(F.lit("t3_"), "post_id").alias("id"),
        F.col("source").alias("title"),
        F.when(F.col("label").isNotNull(), F.col("text")).alias("selftext"),
        F.unix_seconds(utc(F.col("timestamp"))).alias("created_utc"),
        F.when(F.col("upvotes") > 20, F.col("upvotes")).alias("ups"),
        F.col("comments").alias("num_comments"),
        F.when(F.col("label") == 1, F.col("source")).alias("author"),
        F.substring("subreddit", 3, 2).alias("subreddit"),
    )
    # Ids are unique, so a page holds 20 posts at most.
    page = F.floor(F.col("post_id") / 20)
    pages = rows.groupBy(page.alias("page"), (F.col("comments") == 0).alias("failed")).agg(
        F.collect_list(F.struct(item.alias("data"))).alias("posts")
    )
    body = F.struct((~F.col("failed")).alias("success"), F.struct("posts").alias("data"))
    return pages.select(F.to_json(body).alias("value"))


@query(
    "a12_flatten_api_dump",
    with_posts(
        r"""SELECT 't3_' || post_id AS post_id, CASE WHEN label = 1 THEN source ELSE 'unknown' END AS author,
              strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", 'reddit' AS source, subreddit,
              'unknown' AS post_type, '' AS link_flair,
              source || CASE WHEN label IS NOT NULL AND regexp_matches(text, '\S') THEN ' ' || text ELSE '' END AS text,
              source AS title, CASE WHEN label IS NOT NULL THEN text ELSE '' END AS selftext,
              CASE WHEN upvotes > 20 THEN upvotes ELSE 0 END AS upvotes, 0 AS downs, 0 AS score, comments,
              'https://www.reddit.com/' || subreddit || '/comments/t3_' || post_id AS permalink,
              NULL::INTEGER AS label
            FROM posts WHERE comments <> 0"""
    ),
)
def a12(spark, sf_dir):
    path = new_path(spark, "api-dump")
    api_responses(spark, sf_dir).write.text(path)
    return readers.flatten_posts(readers.read_api_dump(spark, path))


_SLOTS = "(SELECT count(*) FROM (SELECT DISTINCT {} FROM posts))"


@query(
    "a13_export_audit",
    with_posts(
        f"""SELECT 'overall_breakdown' AS name, {_SLOTS.format('label')} AS rows, true AS ok
            UNION ALL SELECT 'daily_trend', {_SLOTS.format("date_trunc('day', timestamp), label")}, true
            UNION ALL SELECT 'by_source', {_SLOTS.format('source, label')}, true
            UNION ALL SELECT 'top_keywords', (SELECT count(*) FROM (
              SELECT rank() OVER (PARTITION BY label ORDER BY freq DESC) AS rk FROM words) WHERE rk <= 20), true
            UNION ALL SELECT 'weekly_trend', NULL, false""",
        _WORDS_SQL,
    ),
)
def a13(spark, sf_dir):
    out_dir = new_path(spark, "exports")
    paths = export_reports(posts(spark, sf_dir), out_dir)
    return readers.audit_outputs(spark, {**paths, "weekly_trend": f"{out_dir}/weekly_trend"})


