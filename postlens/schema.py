"""Row types of posts, API responses and aggregate state."""

from __future__ import annotations

from pyspark.sql import types as T

# The three classes and their names.
LABEL_NAMES = {0: "Security Risk", 1: "Productivity Gain", 2: "Neutral"}
LABELS = (0, 1, 2)
NEUTRAL = 2


def post_schema(key_type: T.DataType | None = None, labelled: bool = False) -> T.StructType:
    """Post as it arrives; web ids need `key_type=StringType()`."""
    schema = (
        T.StructType()
        .add("post_id", key_type or T.LongType())
        .add("timestamp", T.StringType())
        .add("source", T.StringType())
        .add("subreddit", T.StringType())
        .add("text", T.StringType())
        .add("upvotes", T.IntegerType())
        .add("comments", T.IntegerType())
    )
    return schema.add("label", T.IntegerType()) if labelled else schema


def classified_schema(key_type: T.DataType | None = None) -> T.StructType:
    return (
        T.StructType()
        .add("post_id", key_type or T.LongType())
        .add("timestamp", T.StringType())
        .add("source", T.StringType())
        .add("text", T.StringType())
        .add("category", T.IntegerType())
        .add("created_at", T.TimestampType())
    )


# One post inside a web API response.
API_POST_SCHEMA = (
    T.StructType()
    .add("id", T.StringType())
    .add("title", T.StringType())
    .add("selftext", T.StringType())
    .add("created_utc", T.DoubleType())
    .add("ups", T.IntegerType())
    .add("downs", T.IntegerType())
    .add("score", T.IntegerType())
    .add("num_comments", T.IntegerType())
    .add("author", T.StringType())
    .add("link_flair_text", T.StringType())
    .add("subreddit", T.StringType())
    .add("permalink", T.StringType())
)

API_RESPONSE_SCHEMA = (
    T.StructType()
    .add("success", T.BooleanType())
    .add(
        "data",
        T.StructType().add(
            "posts", T.ArrayType(T.StructType().add("data", API_POST_SCHEMA))
        ),
    )
)

# Keys and counter column of each aggregate table.
STATE_TABLES = {
    "daily_stats": (("stat_date", "category", "source"), "post_count"),
    "overall_stats": (("category",), "total_count"),
    "top_keywords": (("category", "keyword"), "frequency"),
}

STATE_SCHEMAS = {
    "daily_stats": "stat_date date, category int, source string, post_count bigint",
    "overall_stats": "category int, total_count bigint",
    "top_keywords": "category int, keyword string, frequency bigint",
}
