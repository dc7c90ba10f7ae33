"""Classify a stream of posts and keep the aggregates up to date."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from postlens.operators.cleaning import preview, project_classified, stamp_processing
from postlens.schema import classified_schema, post_schema
from postlens.sources.codec import BAD, decode_posts, mark_bad, split_bad
from postlens.sources.readers import read_stream
from postlens.streaming.state_store import write_batch

Scorer = Callable[[DataFrame], DataFrame]
DEDUP_MODES = ("none", "state", "keyed", "watermark")


def classify_stream(
    messages: DataFrame,
    scorer: Scorer,
    schema: T.StructType | None = None,
    pred: str = "pred",
    dedup: str = "none",
    late: str = "1 day",
    keep_bad: bool = False,
) -> DataFrame:
    """Messages -> classified posts stamped with the processing time.

    Messages that do not decode, or lack a key, are left out; with `keep_bad` they are
    rows, too, with their raw text in `bad_message`, which is null in all others. With
    `dedup='watermark'` a repeat of a post that arrives within `late` of the first one
    is dropped. The mark follows the time of arrival, so a post with an old timestamp is
    no late one, and every post that is not a repeat goes through.
    """
    posts = mark_bad(messages, schema or post_schema(), key="post_id")
    if not keep_bad:
        posts = posts.filter(F.col(BAD).isNull())
    if dedup == "watermark":
        good = (
            posts.filter(F.col(BAD).isNull())
            .withColumn("_arrival", F.current_timestamp())
            .withWatermark("_arrival", late)
            .dropDuplicatesWithinWatermark(["post_id"])
            .drop("_arrival")
        )
        posts = good.unionByName(posts.filter(F.col(BAD).isNotNull())) if keep_bad else good
    return stamp_processing(project_with_day(scorer(posts), pred, keep_bad))


def project_with_day(scored: DataFrame, pred: str, keep_bad: bool = False) -> DataFrame:
    """Classified columns with the event time parsed; an unreadable one is null."""
    more = [BAD] if keep_bad else []
    columns = project_classified(scored, pred, keep=more)
    return columns.withColumn("timestamp", F.try_to_timestamp("timestamp"))


def start_classify(
    messages: DataFrame,
    scorer: Scorer,
    state_dir: str,
    checkpoint: str,
    schema: T.StructType | None = None,
    pred: str = "pred",
    trigger: Mapping[str, object] | None = None,
    dedup: str = "none",
    late: str = "1 day",
    day: str = "timestamp",
    keyword_size: int | None = None,
    latency_steps: int | None = None,
) -> StreamingQuery:
    """Start the job. `trigger` is passed on, e.g. `{"processingTime": "10 seconds"}`;
    by default all waiting messages are taken and the query ends.

    `dedup`: "none" counts every message; "state" leaves out posts an earlier batch
    stored (reads the stored keys in every batch); "keyed" does the same through filters
    next to the keys, and opens only key buckets that may hold a repeat; "watermark" bounds that memory to
    a time span after the first arrival. A replayed batch never counts twice in any mode.
    Messages that are no good are stored with the batch they came in; see
    `state_store.read_dead_letters`. `keyword_size` and `latency_steps` keep summaries of
    bounded size; see `state_store.write_batch`.
    """
    if dedup not in DEDUP_MODES:
        raise ValueError(f"dedup is one of {DEDUP_MODES}, not {dedup!r}")
    classified = classify_stream(messages, scorer, schema, pred, dedup, late, keep_bad=True)

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, state_dir, dedup if dedup in ("state", "keyed") else False, day, keyword_size, latency_steps)

    return (
        classified.writeStream.foreachBatch(sink)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_dead_letters(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    schema: T.StructType | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Append the raw text of every message that `classify_stream` cannot use to parquet.

    For a topic whose posts no job classifies; `start_classify` stores its own.
    """
    _, bad = split_bad(messages, schema or post_schema(), key="post_id")
    return (
        bad.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )


def read_classified_topic(
    spark: SparkSession, fmt: str, n: int = 80, key_type: T.DataType | None = None, **source
) -> DataFrame:
    """Classified posts of an output topic as preview lines."""
    messages = read_stream(spark, fmt, **source)
    return preview(decode_posts(messages, classified_schema(key_type)), n).select("line")
