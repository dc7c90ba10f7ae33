"""Counts, shares, words and rankings."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from postlens.catalog.registry import query
from postlens.catalog.tables import labelled_texts, name_sql, posts, table, texts, with_labels, with_posts
from postlens.operators import cleaning, ranking, reports, words

_WORDS_SQL = """words AS (
  SELECT label, word, count(*) AS freq
  FROM (SELECT label, unnest(regexp_split_to_array(lower(trim(text)), '\\s+')) AS word FROM posts)
  WHERE regexp_matches(word, '^[a-z]{4,}$') GROUP BY label, word
)"""


@query(
    "c1_explode_words",
    with_posts(
        r"SELECT post_id, unnest(regexp_split_to_array(lower(trim(text)), '\s+')) AS word FROM posts"
    ),
)
def c1(spark, sf_dir):
    return words.explode_words(texts(spark, sf_dir), ["post_id"])


@query(
    "c2_word_filter",
    with_posts(
        r"""SELECT post_id, word FROM (
              SELECT post_id, unnest(regexp_split_to_array(lower(trim(text)), '\s+')) AS word FROM posts)
            WHERE regexp_matches(word, '^[a-z]{4,}$')"""
    ),
)
def c2(spark, sf_dir):
    return words.filter_words(words.explode_words(texts(spark, sf_dir), ["post_id"]))


@query(
    "d1_overall_breakdown",
    with_posts(
        f"""SELECT label, n AS count, ((2000 * n + t) // (2 * t)) / 10.0::DOUBLE AS percentage,
                   {name_sql('label')} AS category
            FROM (SELECT label, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS t
                  FROM posts GROUP BY label) ORDER BY label"""
    ),
)
def d1(spark, sf_dir):
    return reports.overall_breakdown(labelled_texts(spark, sf_dir))


@query(
    "d2_daily_trend",
    with_posts(
        f"""SELECT strftime(date_trunc('day', "timestamp"), '%Y-%m-%d %H:%M:%S') AS date, label,
                   count(*) AS count, {name_sql('label')} AS category
            FROM posts GROUP BY 1, 2 ORDER BY 1, 2"""
    ),
)
def d2(spark, sf_dir):
    return reports.daily_trend(posts(spark, sf_dir))


@query(
    "d2_daily_trend_events",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS date, event_type, count(*) AS count
       FROM events GROUP BY 1, 2""",
)
def d2_events(spark, sf_dir):
    return reports.daily_trend(table(spark, sf_dir, "events"), "ts", "event_type").drop("category")


@query(
    "d3_by_source",
    with_posts(
        f"""SELECT source, label, count(*) AS count, {name_sql('label')} AS category
            FROM posts GROUP BY source, label ORDER BY source, label"""
    ),
)
def d3(spark, sf_dir):
    return reports.by_source(labelled_texts(spark, sf_dir))


def labelled_words(spark, sf_dir):
    """The real words of each post with its label: words are picked before the join."""
    return with_labels(words.real_words(texts(spark, sf_dir).select("post_id", "text")), spark, sf_dir)


@query("d4_word_freq", with_posts("SELECT label, word, freq FROM words", _WORDS_SQL))
def d4(spark, sf_dir):
    return words.word_freq(labelled_words(spark, sf_dir))


@query(
    "d5_label_distribution",
    with_posts("SELECT label, count(*) AS count FROM posts WHERE label IS NOT NULL GROUP BY label"),
)
def d5(spark, sf_dir):
    return reports.label_distribution(cleaning.filter_labelled(labelled_texts(spark, sf_dir)))


@query(
    "d6_distribution_zero_filled",
    with_posts(
        """SELECT d.label, d.category, count(p.post_id) AS count,
                  coalesce((2000 * count(p.post_id) + t) // (2 * t), 0) / 10.0::DOUBLE AS percentage
           FROM (VALUES (0, 'Security Risk'), (1, 'Productivity Gain'), (2, 'Neutral')) d(label, category)
           CROSS JOIN (SELECT count(*) AS t FROM posts)
           LEFT JOIN posts p ON p.label = d.label GROUP BY d.label, d.category, t"""
    ),
)
def d6(spark, sf_dir):
    return reports.distribution_filled(labelled_texts(spark, sf_dir))


@query(
    "d7_value_counts",
    with_posts("SELECT subreddit, count(*) AS count FROM posts WHERE subreddit IS NOT NULL GROUP BY subreddit"),
)
def d7(spark, sf_dir):
    return reports.value_counts(texts(spark, sf_dir), "subreddit")


@query(
    "d8_describe_length",
    with_posts(
        """SELECT count(n) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std,
                  min(n) AS min, quantile_cont(n, 0.25) AS p25, quantile_cont(n, 0.5) AS p50,
                  quantile_cont(n, 0.75) AS p75, max(n) AS max
           FROM (SELECT CAST(length(text) AS DOUBLE) AS n FROM posts)"""
    ),
)
def d8(spark, sf_dir):
    stats = reports.describe_length(texts(spark, sf_dir))
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query("d9_row_totals", with_posts("SELECT count(*) AS total FROM posts"))
def d9(spark, sf_dir):
    return reports.row_total(posts(spark, sf_dir))


@query(
    "e1_top_keywords",
    with_posts(
        f"""SELECT label, word, freq, CAST(rk AS INTEGER) AS rank, {name_sql('label')} AS category
            FROM (SELECT *, rank() OVER (PARTITION BY label ORDER BY freq DESC) AS rk FROM words)
            WHERE rk <= 20""",
        _WORDS_SQL,
    ),
)
def e1(spark, sf_dir):
    return words.top_keywords(labelled_words(spark, sf_dir))


@query(
    "e2_dedup_first",
    with_posts(
        """SELECT post_id, source, text, copy FROM (
             SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY copy) AS rn FROM (
               SELECT post_id, source, text, 1 AS copy FROM posts
               UNION ALL SELECT post_id, source, 'copy of ' || text, 0 FROM posts WHERE label IS NOT NULL))
           WHERE rn = 1"""
    ),
)
def e2(spark, sf_dir):
    rows = labelled_texts(spark, sf_dir)
    copies = cleaning.filter_labelled(rows).withColumn("text", F.concat(F.lit("copy of "), "text")).withColumn("copy", F.lit(0))
    both = rows.withColumn("copy", F.lit(1)).unionByName(copies).select("post_id", "source", "text", "copy")
    return ranking.dedup_first(both, "post_id", ["copy"])


@query(
    "e3_top_posts",
    with_posts("SELECT post_id, source, upvotes, comments FROM posts ORDER BY upvotes DESC, post_id LIMIT 100"),
)
def e3(spark, sf_dir):
    rows = posts(spark, sf_dir).select("post_id", "source", "upvotes", "comments")
    return ranking.top_posts(rows, "upvotes", "post_id", 100)


@query(
    "e4_sample_per_class",
    with_posts(
        """SELECT post_id, label, text FROM (
             SELECT *, row_number() OVER (PARTITION BY label ORDER BY post_id) AS rn FROM posts) WHERE rn <= 3"""
    ),
)
def e4(spark, sf_dir):
    rows = labelled_texts(spark, sf_dir).select("post_id", "label", "text")
    return ranking.sample_per_class(rows, "label", ["post_id"], 3)


@query(
    "f1_head_sample",
    with_posts("SELECT post_id, source, subreddit, text FROM posts ORDER BY post_id LIMIT 20"),
)
def f1(spark, sf_dir):
    return ranking.head(texts(spark, sf_dir).select("post_id", "source", "subreddit", "text"), ["post_id"], 20)


@query(
    "f3_ordered_outputs",
    with_posts(
        """SELECT row_number() OVER (ORDER BY label NULLS FIRST) AS position, label, count(*) AS count
           FROM posts GROUP BY label"""
    ),
)
def f3(spark, sf_dir):
    """The order of a report made visible: its rows (one per class) numbered as they come out."""
    report = reports.label_distribution(labelled_texts(spark, sf_dir))
    numbered = report.withColumn("_id", F.monotonically_increasing_id())
    position = F.row_number().over(Window.orderBy("_id")).cast("bigint")
    return numbered.withColumn("position", position).drop("_id")
