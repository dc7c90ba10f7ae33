"""Batch and streaming scans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.functions import text as tx
from postlens.functions import times
from postlens.schema import API_RESPONSE_SCHEMA
from postlens.sources import offset_topic

# A quoted field may hold newlines and doubled quotes.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def read_posts_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    multi_line: bool = True,
    null_mark: str | None = None,
) -> DataFrame:
    """CSV with a header row, its columns taken by name and cast to the given types.

    Nothing is inferred from the data. A column the files lack is null, as is a value
    that does not cast; columns the schema lacks are not parsed. All files of one call
    must have the same header: each is compared to the first one's, and the read fails
    if its columns differ or stand in another order; read such files in calls of their
    own and unite them by name. A file whose fields hold newlines cannot be split
    between tasks, so large data wants many files (see `write_csv`); `multi_line=False`
    splits files without them. `null_mark` is the text that stands for null; without
    one, an empty text is null, too.
    """
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    options = {**CSV_OPTIONS, "multiLine": str(multi_line).lower()}
    if null_mark is not None:
        options |= {"nullValue": null_mark, "emptyValue": ""}
    header = spark.read.options(**options).csv(path).schema
    # With a schema given and not enforced, every file's header is checked against it.
    raw = spark.read.options(**options, enforceSchema="false").schema(header).csv(path)

    def typed(field: T.StructField) -> Column:
        if field.name not in raw.columns:
            return F.lit(None).cast(field.dataType)
        value = F.col(f"`{field.name}`").try_cast(field.dataType)
        if isinstance(field.dataType, T.IntegralType):
            # Counters of a column with gaps are often written as 3.0.
            return F.coalesce(value, F.col(f"`{field.name}`").try_cast("double").try_cast(field.dataType))
        return value

    return raw.select(*[typed(f).alias(f.name) for f in fields])


def read_api_dump(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed web API responses, one JSON document per line."""
    return spark.read.schema(API_RESPONSE_SCHEMA).json(path)


def flatten_posts(
    responses: DataFrame,
    subreddit: str | None = None,
    limit: int | None = None,
    sep: str = " ",
    skip: str = "blank",
) -> DataFrame:
    """One row per post of every successful response, absent fields filled in.

    `subreddit` fixes the group name; by default each post names its own. `limit`
    keeps that many posts of a response. `sep` and `skip` say how title and body
    make the text (see `functions.text.combined`).
    """
    posts = F.col("data.posts")
    if limit is not None:
        posts = F.slice(posts, 1, limit)
    p = responses.filter(F.col("success")).select(F.explode(posts).alias("p")).select("p.data.*")
    group = F.lit(subreddit) if subreddit else F.coalesce(F.col("subreddit"), F.lit(""))
    key = F.coalesce("id", F.lit(""))
    title, body = (F.coalesce(F.col(c), F.lit("")) for c in ("title", "selftext"))

    def counter(name: str):
        return F.coalesce(F.col(name), F.lit(0))

    return p.select(
        key.alias("post_id"),
        F.coalesce("author", F.lit("unknown")).alias("author"),
        times.epoch_string(F.col("created_utc")).alias("timestamp"),
        F.lit("reddit").alias("source"),
        F.concat(F.lit("r/"), group).alias("subreddit"),
        F.lit("unknown").alias("post_type"),
        F.coalesce("link_flair_text", F.lit("")).alias("link_flair"),
        tx.combined(title, body, sep, skip).alias("text"),
        title.alias("title"),
        body.alias("selftext"),
        counter("ups").alias("upvotes"),
        counter("downs").alias("downs"),
        counter("score").alias("score"),
        counter("num_comments").alias("comments"),
        tx.permalink(F.concat(F.lit("r/"), group), key).alias("permalink"),
        F.lit(None).cast("int").alias("label"),
    )


def read_stream(
    spark: SparkSession,
    fmt: str,
    schema: T.StructType | str | None = None,
    path: str | None = None,
    starting_offsets: str | None = None,
    rate_limit: int | None = None,
    **options: str,
) -> DataFrame:
    """Unbounded messages with a `value` column.

    For `kafka` the offsets (default: latest) and the rate limit become `startingOffsets`
    and `maxOffsetsPerTrigger`; for file formats the limit is files per trigger. The format
    `offset_topic` reads what `offset_topic.land` has landed, from the same kinds of
    offsets. Formats without offsets, or without a limit, refuse the option.
    """
    if fmt == offset_topic.FORMAT:
        offset_topic.register(spark)
        if rate_limit is not None:
            raise ValueError(f"{fmt} has no rate limit")
    elif fmt != "kafka" and starting_offsets is not None:
        raise ValueError(f"{fmt} has no offsets to start from")
    reader = spark.readStream.format(fmt)
    if fmt in ("kafka", offset_topic.FORMAT):
        offsets = starting_offsets or "latest"
        reader = reader.option("startingOffsets", offsets if fmt == "kafka" else offset_topic.checked_offsets(offsets))
    if fmt == "kafka":
        if rate_limit is not None:
            reader = reader.option("maxOffsetsPerTrigger", str(rate_limit))
    elif rate_limit is not None:
        reader = reader.option("maxFilesPerTrigger", str(rate_limit))
    if schema is not None:
        reader = reader.schema(schema)
    reader = reader.options(**options)
    return reader.load(path) if path else reader.load()


def audit_outputs(spark: SparkSession, paths: Mapping[str, str], fmt: str = "csv") -> DataFrame:
    """(name, rows, ok) for each expected output; a missing one has null rows."""
    rows = []
    for name, path in paths.items():
        try:
            # The wide quoted CSV needs its record rules to be counted right.
            found = spark.read.options(**(CSV_OPTIONS if fmt == "csv" else {})).format(fmt).load(path)
            counted = found.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("name"), "rows", F.lit(True).alias("ok")
            )
        except AnalysisException:
            counted = spark.range(1).select(
                F.lit(name).alias("name"),
                F.lit(None).cast("bigint").alias("rows"),
                F.lit(False).alias("ok"),
            )
        rows.append(counted)
    report = rows[0]
    for part in rows[1:]:
        report = report.unionByName(part)
    return report
