"""The posts view over the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Keywords that occur in the given texts; the rules take any list.
KW0 = ["license", "token", "free"]
KW1 = ["thing", "ering", "ation"]

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

_LABEL_SQL = """CASE WHEN l.toxic = 1 THEN 0 WHEN l.quality = 1 THEN 1 WHEN l.quality = 0 THEN 2 END"""

POSTS_SQL = f"""posts AS (
  SELECT d.doc_id AS post_id, e.ts AS "timestamp", d.source, 'r/' || d.lang AS subreddit, d.text,
         CAST(floor(e.value) AS INTEGER) AS upvotes,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS comments,
         {_LABEL_SQL} AS label
  FROM documents d JOIN events e ON e.event_id = d.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id
)"""

_L = "lower(coalesce(text, ''))"
RULE_SQL = (
    f"CASE WHEN {' OR '.join(f'contains({_L}, {k!r})' for k in KW0)} THEN 0 "
    f"WHEN {' OR '.join(f'contains({_L}, {k!r})' for k in KW1)} THEN 1 ELSE 2 END"
)
SCORE0_SQL = " + ".join(f"CAST(contains({_L}, {k!r}) AS INTEGER)" for k in KW0)
SCORE1_SQL = " + ".join(f"CAST(contains({_L}, {k!r}) AS INTEGER)" for k in KW1)
MAJORITY_SQL = f"CASE WHEN {SCORE0_SQL} > {SCORE1_SQL} THEN 0 WHEN {SCORE1_SQL} > {SCORE0_SQL} THEN 1 ELSE 2 END"

# Both labellers next to the text.
PAIRS_SQL = f"""pairs AS (
  SELECT post_id, text, label, {RULE_SQL} AS rule, {MAJORITY_SQL} AS pred FROM posts
)"""


def with_posts(sql: str, *more: str) -> str:
    """SELECT over the posts view and any further common table expressions."""
    return f"WITH {', '.join([POSTS_SQL, *more])} {sql}"


def name_sql(label: str, default: str | None = None) -> str:
    """Class name of an SQL expression."""
    other = "" if default is None else f" ELSE '{default}'"
    return (
        f"CASE {label} WHEN 0 THEN 'Security Risk' WHEN 1 THEN 'Productivity Gain' "
        f"WHEN 2 THEN 'Neutral'{other} END"
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts without the columns that take a join."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("post_id"), "source", F.concat(F.lit("r/"), "lang").alias("subreddit"), "text"
    )


def utc(ts: Column) -> Column:
    """The zone-free times of the tables as instants, read as UTC in any session."""
    return F.concat(ts.cast("string"), F.lit("Z")).cast("timestamp")


def with_labels(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add the class of each post, null where none is known.

    Rules go before this join, so that their result is shuffled and not the text.
    """
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("post_id"),
        F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 1).when(F.col("quality") == 0, 2).alias("label"),
    )
    return df.join(labels, "post_id", "left")


def with_events(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add time and counters: those of the event of the same id."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("post_id"),
        F.col("ts").alias("timestamp"),
        F.floor("value").cast("int").alias("upvotes"),
        F.get_json_object("props", "$.k").cast("int").alias("comments"),
    )
    return df.join(events, "post_id")


def labelled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_labels(texts(spark, sf_dir), spark, sf_dir)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All post columns."""
    return with_events(labelled_texts(spark, sf_dir), spark, sf_dir).select(
        "post_id", "timestamp", "source", "subreddit", "text", "upvotes", "comments", "label"
    )


def posts_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with the time as text, the way files and messages carry it."""
    return posts(spark, sf_dir).withColumn("timestamp", F.date_format("timestamp", TIME_FORMAT))
