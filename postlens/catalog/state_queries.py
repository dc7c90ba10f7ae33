"""Additive upserts and the views over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens.catalog.registry import query
from postlens.catalog.tables import KW0, KW1, RULE_SQL, name_sql, texts, with_events, with_posts
from postlens.operators import rules, state
from postlens.operators.cleaning import recent_posts
from postlens.plans import views
from postlens.schema import STATE_TABLES
from postlens.session import new_path

# English posts are the stored part, the other languages the arriving batch.
_STORED = "subreddit = 'r/en'"
_CLASSIFIED_SQL = f'classified AS (SELECT post_id, "timestamp", source, subreddit, text, {RULE_SQL} AS category FROM posts)'
_WORDS_SQL = """keywords AS (
  SELECT category, word AS keyword, count(*) AS frequency
  FROM (SELECT category, unnest(regexp_split_to_array(lower(trim(text)), '\\s+')) AS word FROM classified)
  WHERE regexp_matches(word, '^[a-z]{4,}$') GROUP BY category, word
)"""


def classified(df):
    return rules.classify_first(df, "text", KW0, KW1, out="category")


def stored_and_batch(df):
    stored = F.col("subreddit") == "r/en"
    return df.filter(stored), df.filter(~stored)


def classified_posts(spark, sf_dir):
    """Classified posts with their time; the text is left behind before the join."""
    return with_events(classified(texts(spark, sf_dir)).drop("text"), spark, sf_dir)


def upserted(df, delta, name):
    stored, batch = stored_and_batch(df)
    keys, value = STATE_TABLES[name]
    return state.upsert_additive(delta(stored), delta(batch), keys, value)


def daily_state(spark, sf_dir):
    return upserted(classified_posts(spark, sf_dir), state.daily_delta, "daily_stats")


def overall_state(spark, sf_dir):
    rows = classified(texts(spark, sf_dir))
    return upserted(
        rows, lambda df: df.groupBy("category").agg(F.count(F.lit(1)).alias("total_count")), "overall_stats"
    )


def keyword_state(spark, sf_dir):
    return upserted(classified(texts(spark, sf_dir)), state.keyword_delta, "top_keywords")


@query(
    "g1_upsert_daily",
    with_posts(
        """SELECT CAST("timestamp" AS DATE) AS stat_date, category, source, count(*) AS post_count
           FROM classified GROUP BY 1, 2, 3""",
        _CLASSIFIED_SQL,
    ),
)
def g1(spark, sf_dir):
    return daily_state(spark, sf_dir)


@query(
    "g2_upsert_overall",
    with_posts("SELECT category, count(*) AS total_count FROM classified GROUP BY category", _CLASSIFIED_SQL),
)
def g2(spark, sf_dir):
    return overall_state(spark, sf_dir)


_OVERALL_SQL = """overall AS (
  SELECT category, n AS total_count, CAST(((20000 * n + t) // (2 * t)) / 100.0 AS DECIMAL(5, 2)) AS percentage
  FROM (SELECT category, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS t FROM classified GROUP BY category)
)"""


@query(
    "g3_recalc_percentages",
    with_posts("SELECT category, total_count, percentage FROM overall", _CLASSIFIED_SQL, _OVERALL_SQL),
)
def g3(spark, sf_dir):
    return state.with_percentage(overall_state(spark, sf_dir))


@query(
    "g4_upsert_keywords",
    with_posts("SELECT category, keyword, frequency FROM keywords", _CLASSIFIED_SQL, _WORDS_SQL),
)
def g4(spark, sf_dir):
    return keyword_state(spark, sf_dir)


@query(
    "g5_insert_if_absent",
    with_posts(
        f"""SELECT post_id, text FROM posts WHERE {_STORED}
            UNION ALL SELECT post_id, 'again ' || text FROM posts WHERE NOT ({_STORED})"""
    ),
)
def g5(spark, sf_dir):
    rows = texts(spark, sf_dir).select("post_id", "subreddit", "text")
    stored, _ = stored_and_batch(rows)
    # Every post arrives, twice.
    batch = rows.withColumn("text", F.concat(F.lit("again "), "text"))
    return state.insert_if_absent(
        stored.select("post_id", "text"), batch.unionByName(batch).select("post_id", "text"), "post_id"
    )


@query(
    "g6_seed_dimension",
    with_posts(
        f"""SELECT c.k AS category, {name_sql('c.k')} AS category_name, count(o.post_id) AS total_count
            FROM (VALUES (0), (1), (2)) c(k)
            LEFT JOIN (SELECT * FROM classified WHERE category <> 1) o ON o.category = c.k GROUP BY c.k""",
        _CLASSIFIED_SQL,
    ),
)
def g6(spark, sf_dir):
    return state.seed_classes(overall_state(spark, sf_dir).filter(F.col("category") != 1))


@query(
    "h1_vw_daily_trends",
    with_posts(
        f"""SELECT CAST("timestamp" AS DATE) AS date, {name_sql('category')} AS category, source, count(*) AS post_count
            FROM classified GROUP BY 1, 2, 3""",
        _CLASSIFIED_SQL,
    ),
)
def h1(spark, sf_dir):
    return views.daily_trends_view(daily_state(spark, sf_dir))


@query(
    "h2_vw_overall_summary",
    with_posts(
        f"SELECT {name_sql('category')} AS category, total_count, percentage FROM overall ORDER BY total_count DESC",
        _CLASSIFIED_SQL,
        _OVERALL_SQL,
    ),
)
def h2(spark, sf_dir):
    return views.overall_summary_view(overall_state(spark, sf_dir))


_TOP50_SQL = with_posts(
    f"""SELECT {name_sql('category')} AS category, keyword, frequency
        FROM (SELECT * FROM keywords ORDER BY category, frequency DESC, keyword LIMIT 50)""",
    _CLASSIFIED_SQL,
    _WORDS_SQL,
)


@query("f2_view_top50", _TOP50_SQL)
def f2(spark, sf_dir):
    return views.top_keywords_view(keyword_state(spark, sf_dir))


_TOP500_SQL = with_posts(
    f"""SELECT {name_sql('category')} AS category, keyword, frequency
        FROM (SELECT * FROM keywords ORDER BY category, frequency DESC, keyword LIMIT 500)""",
    _CLASSIFIED_SQL,
    _WORDS_SQL,
)


@query("h3_vw_top_keywords", _TOP500_SQL)
def h3(spark, sf_dir):
    return views.top_keywords_view(keyword_state(spark, sf_dir), 500)


@query(
    "h4_bi_custom_query",
    with_posts(
        f"""SELECT {name_sql('category', 'Neutral')} AS category_name, source, count(*) AS count FROM classified
            WHERE "timestamp" >= (SELECT max("timestamp") FROM classified) - INTERVAL 1 DAY GROUP BY 1, 2""",
        _CLASSIFIED_SQL,
    ),
)
def h4(spark, sf_dir):
    # Joined once and stored: the newest time and the posts near it are both read from there.
    path = new_path(spark, "classified")
    rows = classified_posts(spark, sf_dir).select("post_id", "timestamp", "source", "category")
    rows.write.parquet(path)
    recent = recent_posts(spark.read.schema(rows.schema).parquet(path), "timestamp", days=1)
    return recent.groupBy("category_name", "source").agg(F.count(F.lit(1)).alias("count"))


@query(
    "j3_merge_match",
    with_posts(
        f"""SELECT CAST("timestamp" AS DATE) AS stat_date, category, source, count(*) FILTER ({_STORED}) AS stored,
                   count(*) FILTER (NOT ({_STORED})) AS arriving FROM classified GROUP BY 1, 2, 3""",
        _CLASSIFIED_SQL,
    ),
)
def j3(spark, sf_dir):
    """The match the upserts rest on: full outer equality of state and batch on the key."""
    stored, batch = stored_and_batch(classified_posts(spark, sf_dir))
    keys = ["stat_date", "category", "source"]
    a = state.daily_delta(stored).withColumnRenamed("post_count", "stored")
    b = state.daily_delta(batch).withColumnRenamed("post_count", "arriving")
    zero = F.lit(0).cast("bigint")
    return a.join(b, keys, "full_outer").select(
        *keys, F.coalesce("stored", zero).alias("stored"), F.coalesce("arriving", zero).alias("arriving")
    )
