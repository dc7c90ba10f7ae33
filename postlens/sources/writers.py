"""Sinks. Every one is written by the executors; nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from postlens.sources.codec import to_payload


def write_csv(
    df: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = 500_000, null_mark: str | None = None
) -> None:
    """CSV with a header. Files stay small because quoted newlines make them unsplittable.

    An empty text reads back as null, unless nulls have a mark of their own.
    """
    marks = {} if null_mark is None else {"nullValue": null_mark}
    (
        df.write.mode(mode)
        .options(**marks)
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per row, null fields kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_report(metrics: DataFrame, results: DataFrame, path: str) -> None:
    """Comparison report: the metric row(s) and the compared rows, side by side.

    The rows are not nested into the metrics: a single array would have to be
    built by one task.
    """
    write_json(metrics, f"{path}/metrics")
    write_json(results, f"{path}/results")


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    connections: int = 16,
    batch_size: int = 10_000,
) -> None:
    """Append rows to a database table over at most `connections` parallel connections."""
    (
        df.write.format("jdbc")
        .options(**(properties or {}))
        .option("url", url)
        .option("dbtable", table)
        .option("numPartitions", connections)
        .option("batchsize", batch_size)
        .mode("append")
        .save()
    )


def write_stream_topic(
    df: DataFrame,
    fmt: str,
    checkpoint: str,
    path: str | None = None,
    key: str | None = None,
    trigger: Mapping[str, object] | None = None,
    **options: str,
) -> StreamingQuery:
    """Send rows as JSON messages to a topic (`fmt='kafka'`) or to files (`fmt='text'`)."""
    messages = to_payload(df, key)
    writer = (
        messages.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .options(**options)
        .trigger(**(trigger or {"availableNow": True}))
    )
    return writer.start(path) if path else writer.start()
