"""Streams over files of messages, run until nothing waits."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.catalog.registry import query
from postlens.catalog.state_queries import _CLASSIFIED_SQL, _OVERALL_SQL, _TOP50_SQL, _TOP500_SQL, _WORDS_SQL
from postlens.catalog.tables import KW0, KW1, RULE_SQL, name_sql, posts_as_text, table, with_posts
from postlens.catalog.evaluation_queries import _LATENCY_SQL, consumed_events
from postlens.operators import cleaning, latency, rank_summary, rules, state
from postlens.plans import views
from postlens.schema import classified_schema, post_schema
from postlens.session import new_path
from postlens.sources import codec, offset_topic, readers, writers
from postlens.streaming import job, state_store



def scorer(df):
    return rules.classify_first(df, "text", KW0, KW1)


def message_files(spark, sf_dir, extra=None):
    """Posts as JSON messages in several files; returns their folder."""
    path = new_path(spark, "messages")
    messages = codec.to_payload(posts_as_text(spark, sf_dir).drop("label"))
    if extra is not None:
        messages = messages.unionByName(extra)
    files = max(4, spark.sparkContext.defaultParallelism)
    messages.repartition(files).write.text(path)
    return path


def source(spark, path, **options):
    return readers.read_stream(spark, "text", path=path, **options)


def run_job(spark, path, rate_limit=None, state_dir=None, checkpoint=None, scorer=scorer, **options):
    """Run the job over all waiting files; returns the folder of its state."""
    state_dir = state_dir or new_path(spark, "state")
    checkpoint = checkpoint or new_path(spark, "checkpoint")
    messages = source(spark, path, rate_limit=rate_limit)
    job.start_classify(messages, scorer, state_dir, checkpoint, **options).awaitTermination()
    return state_dir


@query(
    "a5_source_stream",
    with_posts(
        """SELECT post_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", source, subreddit, text,
                  upvotes, comments FROM posts"""
    ),
)
def a5(spark, sf_dir):
    decoded = codec.decode_posts(source(spark, message_files(spark, sf_dir)))
    out = new_path(spark, "decoded")
    writer = decoded.writeStream.format("parquet").option("checkpointLocation", new_path(spark, "checkpoint"))
    writer.trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(post_schema()).parquet(out)


_CLASSIFIED_OUT = with_posts(
    f"""SELECT post_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", source, text,
               {RULE_SQL} AS category FROM posts"""
)


def classified_topic(spark, sf_dir):
    """Classified posts sent on as messages; returns the folder of the topic."""
    classified = job.classify_stream(source(spark, message_files(spark, sf_dir)), scorer)
    topic = new_path(spark, "classified-topic")
    writers.write_stream_topic(classified, "text", new_path(spark, "checkpoint"), path=topic).awaitTermination()
    return topic


@query("a8_sink_stream_topic", _CLASSIFIED_OUT)
def a8(spark, sf_dir):
    sent = codec.decode_posts(spark.read.text(classified_topic(spark, sf_dir)), classified_schema())
    at = F.date_format(F.try_to_timestamp("timestamp"), "yyyy-MM-dd HH:mm:ss")
    return sent.withColumn("timestamp", at).drop("created_at")


@query(
    "i1_stream_classify_job",
    with_posts(
        """SELECT CAST("timestamp" AS DATE) AS stat_date, category, source, count(*) AS post_count
           FROM classified GROUP BY 1, 2, 3""",
        _CLASSIFIED_SQL,
    ),
)
def i1(spark, sf_dir):
    return state_store.read_state(spark, run_job(spark, message_files(spark, sf_dir)), "daily_stats")


@query("i1_processing_day", with_posts("SELECT category, source, count(*) AS post_count FROM classified GROUP BY 1, 2", _CLASSIFIED_SQL))
def i1_processing_day(spark, sf_dir):
    """Daily counts by the day of processing: at most the two days a run can touch."""
    state_dir = run_job(spark, message_files(spark, sf_dir), day="created_at")
    daily = state_store.read_state(spark, state_dir, "daily_stats")
    near = F.abs(F.date_diff("stat_date", F.current_date())) <= 1
    return daily.filter(near).groupBy("category", "source").agg(F.sum("post_count").alias("post_count"))


@query(
    "i8_job_latency",
    with_posts("SELECT count(*) AS count, true AS ordered, true AS positive FROM classified", _CLASSIFIED_SQL),
)
def i8_job(spark, sf_dir):
    """From a post's own time to its classification, for every post that the job stored."""
    state_dir = run_job(spark, message_files(spark, sf_dir))
    columns = "post_id bigint, timestamp timestamp, created_at timestamp"
    rows = state_store.read_classified(spark, state_dir, T.StructType.fromDDL(columns))
    s = latency.latency_stats(rows, "timestamp", "created_at")
    ordered = (F.col("min") <= F.col("median")) & (F.col("median") <= F.col("p99")) & (F.col("p99") <= F.col("max"))
    return s.select(F.col("n").alias("count"), ordered.alias("ordered"), (F.col("min") > 0).alias("positive"))


@query(
    "i2_foreach_batch_multi_sink",
    with_posts(
        """SELECT 'classified_posts' AS name, count(*) AS rows, CAST(sum(category) AS BIGINT) AS total FROM classified
           UNION ALL SELECT 'daily_stats', count(*), CAST(sum(n) AS BIGINT) FROM (
             SELECT count(*) AS n FROM classified GROUP BY CAST("timestamp" AS DATE), category, source)
           UNION ALL SELECT 'overall_stats', count(*), CAST(sum(total_count) AS BIGINT) FROM overall
           UNION ALL SELECT 'top_keywords', count(*), CAST(sum(frequency) AS BIGINT) FROM keywords""",
        _CLASSIFIED_SQL,
        _OVERALL_SQL,
        _WORDS_SQL,
    ),
)
def i2(spark, sf_dir):
    state_dir = run_job(spark, message_files(spark, sf_dir), rate_limit=2)
    schema = job.project_with_day(scorer(posts_as_text(spark, sf_dir)), "pred").schema
    rows = state_store.read_classified(spark, state_dir, schema)
    report = rows.agg(F.lit("classified_posts").alias("name"), F.count("post_id").alias("rows"), F.sum("category").alias("total"))
    for name, value in (("daily_stats", "post_count"), ("overall_stats", "total_count"), ("top_keywords", "frequency")):
        table_rows = state_store.read_state(spark, state_dir, name)
        report = report.unionByName(
            table_rows.agg(F.lit(name).alias("name"), F.count(value).alias("rows"), F.sum(value).alias("total"))
        )
    return report


@query(
    "i3_checkpoint_recovery",
    with_posts(
        """SELECT category, 2 * count(*) AS total_count FROM classified GROUP BY category""", _CLASSIFIED_SQL
    ),
)
def i3(spark, sf_dir):
    """Stop after a first load, add the same messages as new files, restart from the checkpoint."""
    path, state_dir, checkpoint = message_files(spark, sf_dir), new_path(spark, "state"), new_path(spark, "checkpoint")
    run_job(spark, path, state_dir=state_dir, checkpoint=checkpoint)
    spark.read.text(path).write.mode("append").text(path)
    run_job(spark, path, state_dir=state_dir, checkpoint=checkpoint)
    return state_store.read_state(spark, state_dir, "overall_stats")


@query(
    "i4_replay_safe_state",
    with_posts("SELECT category, count(*) AS total_count FROM classified GROUP BY category", _CLASSIFIED_SQL),
)
def i4(spark, sf_dir):
    """As above with repeats left out, then a batch written once more as a restart would."""
    path, state_dir, checkpoint = message_files(spark, sf_dir), new_path(spark, "state"), new_path(spark, "checkpoint")
    run_job(spark, path, state_dir=state_dir, checkpoint=checkpoint, dedup="state")
    spark.read.text(path).write.mode("append").text(path)
    run_job(spark, path, state_dir=state_dir, checkpoint=checkpoint, dedup="state")
    again = job.classify_stream(spark.read.text(path), scorer)
    state_store.write_batch(again, 1, state_dir, dedup=True)
    return state_store.read_state(spark, state_dir, "overall_stats")


@query(
    "i4_keyed_repeats",
    with_posts("SELECT category, count(*) AS total_count FROM classified GROUP BY category", _CLASSIFIED_SQL),
)
def i4_keyed(spark, sf_dir):
    """All messages twice, then a batch once more; repeats are found through the filters of the key buckets."""
    path, state_dir, checkpoint = message_files(spark, sf_dir), new_path(spark, "state"), new_path(spark, "checkpoint")
    run_job(spark, path, state_dir=state_dir, checkpoint=checkpoint, dedup="keyed")
    spark.read.text(path).write.mode("append").text(path)
    run_job(spark, path, state_dir=state_dir, checkpoint=checkpoint, dedup="keyed")
    again = job.classify_stream(spark.read.text(path), scorer)
    state_store.write_batch(again, 1, state_dir, dedup="keyed")
    return state_store.read_state(spark, state_dir, "overall_stats")


TOPIC_PARTITIONS = 4


def landed(spark, sf_dir, path, which):
    """Posts for which `which` holds, appended to a topic in the order of their ids."""
    posts = posts_as_text(spark, sf_dir).drop("label").filter(which)
    messages = codec.to_payload(posts, key="post_id").withColumn("post_id", F.col("key").cast("bigint"))
    offset_topic.land(messages, path, F.col("post_id") % TOPIC_PARTITIONS, "post_id")


def decoded_topic(spark, path, offsets, out, checkpoint):
    """Run a stream over what waits in a topic, appending to `out`."""
    messages = readers.read_stream(spark, offset_topic.FORMAT, path=path, starting_offsets=offsets)
    writer = codec.decode_posts(messages).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(post_schema()).parquet(out)


@query(
    "i5_starting_offsets",
    with_posts("SELECT source, count(*) AS count FROM posts GROUP BY source"),
)
def i5(spark, sf_dir):
    """Start from the earliest message: everything already there is read."""
    path = new_path(spark, "topic")
    landed(spark, sf_dir, path, F.lit(True))
    rows = decoded_topic(spark, path, "earliest", new_path(spark, "decoded"), new_path(spark, "checkpoint"))
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("count"))


@query("i5_latest", with_posts("SELECT post_id, source FROM posts WHERE post_id % 3 = 0"))
def i5_latest(spark, sf_dir):
    """Start from the latest message: what was there before is passed over, what is landed later is read once."""
    path, out, checkpoint = (new_path(spark, n) for n in ("topic", "decoded", "checkpoint"))
    landed(spark, sf_dir, path, "post_id % 3 > 0")
    decoded_topic(spark, path, "latest", out, checkpoint)
    landed(spark, sf_dir, path, "post_id % 3 = 0")
    decoded_topic(spark, path, "latest", out, checkpoint)
    return decoded_topic(spark, path, "latest", out, checkpoint).select("post_id", "source")


@query(
    "i5_explicit",
    with_posts(
        f"""SELECT post_id, source FROM (
              SELECT post_id, source, post_id % {TOPIC_PARTITIONS} AS p, row_number() OVER (PARTITION BY post_id % {TOPIC_PARTITIONS} ORDER BY post_id) - 1 AS o FROM posts)
            WHERE p = 0 AND o >= 7 OR p = 1 OR p = 3"""
    ),
)
def i5_explicit(spark, sf_dir):
    """Offsets by partition: one from its eighth message, one from the earliest, one from the latest, one not named."""
    path = new_path(spark, "topic")
    landed(spark, sf_dir, path, F.lit(True))
    offsets = '{"0": 7, "1": -2, "2": -1}'
    return decoded_topic(spark, path, offsets, new_path(spark, "decoded"), new_path(spark, "checkpoint")).select("post_id", "source")


@query(
    "i6_rate_limit",
    with_posts("SELECT category, keyword, frequency FROM keywords", _CLASSIFIED_SQL, _WORDS_SQL),
)
def i6(spark, sf_dir):
    """One file to a batch: many batches add up to what one would give."""
    return state_store.read_state(spark, run_job(spark, message_files(spark, sf_dir), rate_limit=1), "top_keywords")


@query(
    "i7_trigger_interval",
    with_posts("SELECT category, total_count, percentage FROM overall", _CLASSIFIED_SQL, _OVERALL_SQL),
)
def i7(spark, sf_dir):
    """A timed trigger, stopped once the waiting files are through."""
    state_dir = new_path(spark, "state")
    running = job.start_classify(
        source(spark, message_files(spark, sf_dir)), scorer, state_dir, new_path(spark, "checkpoint"),
        trigger={"processingTime": "1 second"},
    )
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return state.with_percentage(state_store.read_state(spark, state_dir, "overall_stats"))


@query(
    "i3_compacted_state",
    with_posts(
        """SELECT 'daily_stats' AS name, count(*) AS rows, CAST(sum(n) AS BIGINT) AS total FROM (
             SELECT count(*) AS n FROM classified GROUP BY CAST("timestamp" AS DATE), category, source)
           UNION ALL SELECT 'overall_stats', count(*), CAST(sum(total_count) AS BIGINT) FROM overall
           UNION ALL SELECT 'top_keywords', count(*), CAST(sum(frequency) AS BIGINT) FROM keywords""",
        _CLASSIFIED_SQL,
        _OVERALL_SQL,
        _WORDS_SQL,
    ),
)
def i3_compacted(spark, sf_dir):
    """Three compactions, each followed by the removal of folded folders: every table still counts all posts."""
    state_dir = run_job(spark, message_files(spark, sf_dir), rate_limit=1)
    for upto in (0, 1, 3):
        state_store.compact(spark, state_dir, upto)
        state_store.expire(spark, state_dir, keep=0)
    values = (("daily_stats", "post_count"), ("overall_stats", "total_count"), ("top_keywords", "frequency"))
    return cleaning.union_sources(
        [
            state_store.read_state(spark, state_dir, name).agg(F.lit(name).alias("name"), F.count(value).alias("rows"), F.sum(value).alias("total"))
            for name, value in values
        ]
    )


@query("i6_stream_views", _TOP50_SQL)
def i6_views(spark, sf_dir):
    """Compacted state serves the same view as the batches it folds."""
    state_dir = run_job(spark, message_files(spark, sf_dir), rate_limit=3)
    state_store.compact(spark, state_dir, 1)
    return views.top_keywords_view(state_store.read_state(spark, state_dir, "top_keywords"))


@query("h3_bounded_top", _TOP500_SQL)
def h3_bounded(spark, sf_dir):
    """The view of all keywords, from summaries of 600 words a class that the job keeps instead of them."""
    state_dir = run_job(spark, message_files(spark, sf_dir), rate_limit=3, keyword_size=600)
    return views.top_keywords_view(state_store.read_top_keywords(spark, state_dir, 500, 600), 500)


STREAM_QUANTILES = (0.5, 0.95, 0.99)


@query(
    "i8_stream_quantiles",
    f"""WITH {_LATENCY_SQL}, ordered AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS n FROM gaps)
        SELECT q AS quantile, max(n) AS rows, round(max(v) FILTER (i = least(floor(n * q), n - 1)), 2) AS exact, true AS within
        FROM ordered, (VALUES {', '.join(f'({q}::DOUBLE)' for q in STREAM_QUANTILES)}) t(q) GROUP BY q""",
)
def i8_stream(spark, sf_dir):
    """Latency quantiles of a stream's batches: the exact value, and whether the merged summaries' value is as near in rank as they say, and within 1 % of the rows."""
    arriving, state_dir = new_path(spark, "consumed"), new_path(spark, "state")
    events = consumed_events(spark, sf_dir)
    events.repartition(4, "event_id").write.parquet(arriving)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(arriving)

    def sink(batch, batch_id):
        state_store.write_latency(batch, batch_id, state_dir, "ts", "consumed")

    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", new_path(spark, "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    summaries = state_store.read_summary(spark, state_dir, state_store.LATENCY_SUMMARY)
    found = rank_summary.quantiles(summaries, STREAM_QUANTILES).collect()  # a row per quantile
    gaps = latency.with_latency(events, "ts", "consumed", "v").filter("v IS NOT NULL")
    names = {r["quantile"]: f"q{i}" for i, r in enumerate(found)}
    counts = [c for r in found for c in (F.count_if(F.col("v") < r["value"]).alias(f"below_{names[r['quantile']]}"), F.count_if(F.col("v") <= r["value"]).alias(f"upto_{names[r['quantile']]}"))]
    exact = latency.quantile_columns(gaps, "v", {names[q]: (q, "nearest") for q in names}, counts)

    def judged(r):
        name = names[r["quantile"]]
        near = (F.col(f"below_{name}") < r["rank"] + r["error"]) & (F.col(f"upto_{name}") >= r["rank"])
        within = near & F.lit(r["error"] <= r["rows"] // 100)
        return F.struct(F.lit(r["quantile"]).alias("quantile"), F.lit(r["rows"]).cast("bigint").alias("rows"), F.round(name, 2).alias("exact"), within.alias("within"))

    return exact.select(F.explode(F.array(*[judged(r) for r in found])).alias("r")).select("r.*")


@query(
    "i9_bad_record_split",
    """SELECT 'good' AS side, count(*) AS rows FROM documents
       UNION ALL SELECT 'dead_letter', count(*) FROM events WHERE event_type IN ('error', 'signup')""",
)
def i9(spark, sf_dir):
    """Broken JSON and string ids among the messages go to the dead letters, raw text and all, in one job."""
    kind = F.col("event_type")
    broken = F.when(kind == "error", F.format_string('{"post_id": %d, "text"', "event_id")).otherwise(
        F.format_string('{"post_id": "1rih%d", "source": "reddit"}', "event_id")
    )
    bad = table(spark, sf_dir, "events").filter(kind.isin("error", "signup")).select(broken.alias("value"))
    state_dir = run_job(spark, message_files(spark, sf_dir, bad))
    good = state_store.read_state(spark, state_dir, "overall_stats")
    letters = state_store.read_dead_letters(spark, state_dir)
    return good.agg(F.lit("good").alias("side"), F.sum("total_count").alias("rows")).unionByName(
        letters.agg(F.lit("dead_letter").alias("side"), F.count("value").alias("rows"))
    )


@query(
    "i10_stream_topic_reader",
    with_posts(
        f"""SELECT '[' || {name_sql('category')} || '] [' || source || '] ' || substr(text, 1, 80) || '...' AS line
            FROM classified""",
        _CLASSIFIED_SQL,
    ),
)
def i10(spark, sf_dir):
    lines = job.read_classified_topic(spark, "text", path=classified_topic(spark, sf_dir))
    out = new_path(spark, "lines")
    lines.writeStream.format("parquet").option("checkpointLocation", new_path(spark, "checkpoint")).trigger(
        availableNow=True
    ).start(out).awaitTermination()
    return spark.read.schema("line string").parquet(out)


