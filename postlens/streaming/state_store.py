"""Aggregate tables kept as one folder per micro-batch.

Every batch overwrites only its own `batch_id=<n>` folder of every table, so a
replayed batch replaces what it wrote before and nothing counts twice. Readers add
the folders up. `compact` folds old batches into one snapshot of every table and then
marks it as live for all tables at once; readers open the live snapshot and later batches,
and `expire` removes what no reader opens any more.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.functions.text import WORD_PATTERN
from postlens.operators import heavy_hitters, rank_summary
from postlens.operators import state as st
from postlens.operators.latency import with_latency
from postlens.operators.ranking import dedup_first
from postlens.operators.words import explode_words
from postlens.schema import STATE_SCHEMAS, STATE_TABLES
from postlens.sources.codec import BAD
from postlens.streaming.key_store import KeyStore

CLASSIFIED = "classified_posts"
FINISHED = "finished_batches"
KEYS = "keys"
LIVE = "live_snapshots"
# Tables of bounded summaries, kept by jobs that ask for them.
KEYWORD_SUMMARY = "keyword_summary"
LATENCY_SUMMARY = "latency_summary"
SUMMARY_SCHEMAS = {KEYWORD_SUMMARY: heavy_hitters.SUMMARY_SCHEMA, LATENCY_SUMMARY: rank_summary.SUMMARY_SCHEMA}
SUMMARY_SIZES = {KEYWORD_SUMMARY: 10_000, LATENCY_SUMMARY: rank_summary.STEPS}
# Partition of the stored rows that tells messages that were no good from posts.
SIDE = "is_bad"


def _table(state_dir: str, name: str) -> str:
    return f"{state_dir}/{name}"


def _read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of all batch folders with their `batch_id`; none before the first batch."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    schema = T.StructType(schema.fields + [T.StructField("batch_id", T.LongType())])
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_batch(
    batch: DataFrame,
    batch_id: int,
    state_dir: str,
    dedup: bool | str = False,
    day: str = "timestamp",
    keyword_size: int | None = None,
    latency_steps: int | None = None,
) -> None:
    """Store the classified rows of a batch, and its messages that were no good, then its three deltas.

    The rows are scored once, by the first write; the deltas read that folder back,
    each with just its own columns. `dedup` leaves out posts that an earlier batch
    has stored; with `"keyed"` they are found through the filters of a `KeyStore`, which
    then has to have been on from the first batch. `day` is the column the daily counts go by: event time
    (`timestamp`) or processing time (`created_at`). With `keyword_size` a summary of that many
    words a class is kept instead of the count of every word; with `latency_steps`, a
    summary of the time from a post's own to its classification.
    """
    spark = batch.sparkSession
    own = f"batch_id={batch_id}"
    rows_path = f"{_table(state_dir, CLASSIFIED)}/{own}"
    if BAD not in batch.columns:
        batch = batch.withColumn(BAD, F.lit(None).cast("string"))
    batch = batch.withColumn(SIDE, F.col(BAD).isNotNull())

    def stored_at(path: str) -> DataFrame:
        return spark.read.schema(batch.schema).parquet(path)

    keys = KeyStore(spark, f"{state_dir}/{KEYS}", "post_id")
    if dedup:
        earlier = _read(spark, _table(state_dir, CLASSIFIED), batch.schema).filter((F.col("batch_id") < batch_id) & ~F.col(SIDE))

        def unseen(rows: DataFrame) -> DataFrame:
            return keys.unseen(rows, batch_id) if dedup == "keyed" else st.absent(earlier, rows, "post_id")

        # Keys alone tell what is new. Texts are shuffled only where a new key repeats within the
        # batch, or where some keys are new and others not and the new ones are many.
        good, bad = batch.filter(~F.col(SIDE)), batch.filter(F.col(SIDE))
        keys_path = f"{state_dir}/_incoming_keys/{own}"
        good.groupBy("post_id").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(keys_path)
        counted = spark.read.schema(T.StructType([batch.schema["post_id"], T.StructField("n", T.LongType())])).parquet(keys_path)
        # Written, so that its size tells Spark how to join.
        new_path = f"{state_dir}/_incoming_new/{own}"
        unseen(counted).select("post_id", "n").write.mode("overwrite").parquet(new_path)
        new = spark.read.schema(counted.schema).parquet(new_path)
        sums = new.agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows")).first()
        if not sums["keys"]:
            batch = bad
        elif sums["keys"] < counted.count():
            known = new.withColumnRenamed("post_id", "_new_key")
            batch = good.join(known, F.col("post_id").eqNullSafe(F.col("_new_key")), "left_semi").unionByName(bad)
        if sums["keys"] and sums["rows"] > sums["keys"]:
            # Scored once into a folder of its own.
            incoming_path = f"{state_dir}/_incoming/{own}"
            batch.write.mode("overwrite").partitionBy(SIDE).parquet(incoming_path)
            incoming = stored_at(incoming_path)
            first = dedup_first(incoming.filter(~F.col(SIDE)), "post_id", ["timestamp", "source", "text"])
            batch = first.select(*batch.columns).unionByName(incoming.filter(F.col(SIDE)).select(*batch.columns))
    batch.write.mode("overwrite").partitionBy(SIDE).parquet(rows_path)
    stored = stored_at(rows_path).filter(~F.col(SIDE))

    def write(delta: DataFrame, name: str) -> str:
        path = f"{_table(state_dir, name)}/{own}"
        delta.write.mode("overwrite").parquet(path)
        return path

    def counts() -> None:
        daily_path = write(st.daily_delta(stored, day), "daily_stats")
        daily = spark.read.schema(STATE_SCHEMAS["daily_stats"]).parquet(daily_path)
        write(st.overall_delta(daily), "overall_stats")

    def keywords() -> None:
        if keyword_size is None:
            write(st.keyword_delta(stored), "top_keywords")
        else:
            write(heavy_hitters.summarize(st.keyword_delta(stored), keyword_size), KEYWORD_SUMMARY)

    def latencies() -> None:
        if latency_steps is not None:
            write_latency(stored, batch_id, state_dir, "timestamp", "created_at", latency_steps)

    # Independent chains of jobs; the threads only submit them to Spark.
    with ThreadPoolExecutor(max_workers=2) as pool:
        for chain in [pool.submit(inheritable_thread_target(spark)(f)) for f in (counts, keywords, latencies)]:
            chain.result()
    if dedup == "keyed":
        keys.store(stored.select("post_id"), batch_id)
    # The mark comes last: a batch that has it is complete in every table.
    spark.range(1).select(F.current_timestamp().alias("at")).write.mode("overwrite").parquet(f"{_table(state_dir, FINISHED)}/{own}")


def write_latency(
    batch: DataFrame, batch_id: int, state_dir: str, start: str, end: str, steps: int = SUMMARY_SIZES[LATENCY_SUMMARY]
) -> None:
    """The summary of a batch's milliseconds from `start` to `end`; a replayed batch replaces its own."""
    summary = rank_summary.summarize(with_latency(batch, start, end), "latency_ms", steps)
    summary.write.mode("overwrite").parquet(f"{_table(state_dir, LATENCY_SUMMARY)}/batch_id={batch_id}")


def read_summary(spark: SparkSession, state_dir: str, name: str) -> DataFrame:
    """The rows of all live summaries of a table, to be merged by the functions of its module."""
    return _summed(spark, live_folders(spark, state_dir, name), name)


def read_top_keywords(
    spark: SparkSession, state_dir: str, n: int, size: int = SUMMARY_SIZES[KEYWORD_SUMMARY]
) -> DataFrame:
    """The first `n` keywords of every class, exact; stored posts are read only where the summaries leave a word open."""
    merged = heavy_hitters.merge(read_summary(spark, state_dir, KEYWORD_SUMMARY), size)
    posts = read_classified(spark, state_dir, T.StructType.fromDDL("category int, text string"))
    occurrences = explode_words(posts, ["category"]).select("category", F.col("word").alias("keyword"), F.lit(1).alias("frequency"))
    return heavy_hitters.exact_top(merged, occurrences, n, F.col("keyword").rlike(WORD_PATTERN))


def read_classified(spark: SparkSession, state_dir: str, schema: T.StructType) -> DataFrame:
    """Stored posts of all batches with their `batch_id`."""
    sided = T.StructType([*schema.fields, T.StructField(SIDE, T.BooleanType())])
    return _read(spark, _table(state_dir, CLASSIFIED), sided).filter(~F.col(SIDE)).drop(SIDE)


def read_dead_letters(spark: SparkSession, state_dir: str) -> DataFrame:
    """Raw text of the messages that were no good, with the batch they came in."""
    rows = _read(spark, _table(state_dir, CLASSIFIED), f"{BAD} string, {SIDE} boolean")
    return rows.filter(F.col(SIDE)).select(F.col(BAD).alias("value"), "batch_id")


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Batches that have a folder below a path, from one listing."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    names = [s.getPath().getName() for s in system.listStatus(folder) if s.isDirectory()]
    return sorted(int(n.removeprefix("batch_id=")) for n in names if re.fullmatch(r"batch_id=\d+", n))


def _snapshot(state_dir: str, name: str, upto: int) -> str:
    return f"{_table(state_dir, name)}_snapshot/batch_id={upto}"


def _snapshots(spark: SparkSession, state_dir: str, name: str, live: list[int]) -> list[str]:
    """Folders of live snapshots; a table of summaries has none from before it was kept."""
    if name in SUMMARY_SCHEMAS:
        there = set(_numbers(spark, f"{_table(state_dir, name)}_snapshot"))
        live = [n for n in live if n in there]
    return [_snapshot(state_dir, name, n) for n in live]


def live_snapshots(spark: SparkSession, state_dir: str) -> list[int]:
    """Batches up to which there is a complete snapshot of every table; readers take the last."""
    marks = _read(spark, _table(state_dir, LIVE), "at timestamp")
    return sorted(r["batch_id"] for r in marks.select("batch_id").distinct().collect())  # a row per compaction


def live_folders(spark: SparkSession, state_dir: str, name: str) -> list[str]:
    """What a reader of a table opens: the live snapshot and the batches after it."""
    live = live_snapshots(spark, state_dir)
    later = [n for n in _numbers(spark, _table(state_dir, name)) if not live or n > live[-1]]
    return [*_snapshots(spark, state_dir, name, live[-1:]), *[f"{_table(state_dir, name)}/batch_id={n}" for n in later]]


def read_state(spark: SparkSession, state_dir: str, name: str) -> DataFrame:
    """Current counters of one aggregate table."""
    keys, value = STATE_TABLES[name]
    return _summed(spark, live_folders(spark, state_dir, name), name).groupBy(*keys).agg(F.sum(value).alias(value))


def _summed(spark: SparkSession, folders: list[str], name: str) -> DataFrame:
    schema = STATE_SCHEMAS.get(name) or SUMMARY_SCHEMAS[name]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _folded(rows: DataFrame, name: str, sizes: Mapping[str, int]) -> DataFrame:
    """The rows of one snapshot from those of several batches."""
    if name == KEYWORD_SUMMARY:
        return heavy_hitters.merge(rows, sizes[name])
    if name == LATENCY_SUMMARY:
        return rank_summary.fold(rows, sizes[name])
    keys, value = STATE_TABLES[name]
    return rows.groupBy(*keys).agg(F.sum(value).alias(value))


def compact(spark: SparkSession, state_dir: str, upto: int, sizes: Mapping[str, int] = SUMMARY_SIZES) -> None:
    """Fold all batches up to and including `upto` into a snapshot of each table.

    `upto` must be a batch that is complete in all tables; as batches are written one
    after another, the ones before it are, too. Any other number is refused: readers
    skip every batch up to it, so one that is written later would be lost. The snapshots
    become live by one mark, a single small file that is written last: a reader sees those
    of all tables or none, and what a crash leaves behind is never read and written anew.
    A batch that is folded already changes nothing. Folders stay until `expire`. Summaries
    are folded to `sizes`; their bounds stay true, and a rank's grows by one step a compaction.
    """
    finished = _read(spark, _table(state_dir, FINISHED), "at timestamp")
    if finished.filter(F.col("batch_id") == upto).isEmpty():
        raise ValueError(f"batch {upto} is not complete")
    live = live_snapshots(spark, state_dir)
    if live and upto <= live[-1]:
        return
    for name in (*STATE_TABLES, *SUMMARY_SCHEMAS):
        later = [n for n in _numbers(spark, _table(state_dir, name)) if n <= upto and (not live or n > live[-1])]
        folders = [*_snapshots(spark, state_dir, name, live[-1:]), *[f"{_table(state_dir, name)}/batch_id={n}" for n in later]]
        _folded(_summed(spark, folders, name), name, sizes).write.mode("overwrite").parquet(_snapshot(state_dir, name, upto))
    mark = spark.range(1).select(F.current_timestamp().alias("at")).coalesce(1)
    mark.write.mode("overwrite").parquet(f"{_table(state_dir, LIVE)}/batch_id={upto}")


def expire(spark: SparkSession, state_dir: str, keep: int = 1) -> list[str]:
    """Remove the batch folders and snapshots that newer snapshots stand for; returns what was removed.

    What readers opened before each of the last `keep` compactions stays, so a reader that
    has begun can end. Only the aggregate tables lose folders; the stored posts stay.
    """
    live = live_snapshots(spark, state_dir)
    if len(live) <= keep:
        return []
    oldest = live[-1 - keep]
    gone = [f"{_table(state_dir, LIVE)}/batch_id={n}" for n in live if n < oldest]
    for name in (*STATE_TABLES, *SUMMARY_SCHEMAS):
        gone += [f"{_table(state_dir, name)}/batch_id={n}" for n in _numbers(spark, _table(state_dir, name)) if n <= oldest]
        gone += [_snapshot(state_dir, name, n) for n in _numbers(spark, f"{_table(state_dir, name)}_snapshot") if n < oldest]
    for path in gone:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return gone
