"""JSON messages <-> posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.schema import post_schema

_RAW = "_raw_message"
BAD = "bad_message"


def decode_posts(df: DataFrame, schema: T.StructType | None = None, value: str = "value") -> DataFrame:
    """Message -> post columns. A broken message gives nulls, as does a bad field."""
    parsed = F.from_json(F.col(value).cast("string"), schema or post_schema())
    return df.select(parsed.alias("d")).select("d.*")


def split_bad(
    df: DataFrame, schema: T.StructType | None = None, value: str = "value", key: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(decoded posts, dead letters). Each message is in exactly one of the two.

    A dead letter keeps the raw text: broken JSON, a field of the wrong type, a null
    message, or one without the `key` field.
    """
    marked = mark_bad(df, schema, value, key)
    return marked.filter(F.col(BAD).isNull()).drop(BAD), marked.filter(F.col(BAD).isNotNull()).select(F.col(BAD).alias("value"))


def mark_bad(
    df: DataFrame, schema: T.StructType | None = None, value: str = "value", key: str | None = None
) -> DataFrame:
    """Decoded post columns, and `bad_message`: the raw text of a message that is no good, else null.

    A null message has the empty string there.
    """
    schema = schema or post_schema()
    with_raw = T.StructType(schema.fields + [T.StructField(_RAW, T.StringType())])
    text = F.col(value).cast("string")
    parsed = df.select(
        text.alias("value"),
        F.from_json(text, with_raw, {"columnNameOfCorruptRecord": _RAW}).alias("d"),
    )
    is_bad = F.col("value").isNull() | F.col(f"d.{_RAW}").isNotNull()
    if key is not None:
        is_bad = is_bad | F.col(f"d.{key}").isNull()
    raw = F.when(is_bad, F.coalesce("value", F.lit("")))
    return parsed.select(*[f"d.{f.name}" for f in schema.fields], raw.alias(BAD))


def to_payload(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON messages (`value`), with an optional message key."""
    body = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), body) if key else df.select(body)
