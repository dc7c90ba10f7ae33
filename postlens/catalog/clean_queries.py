"""Clean-up, projection and keyword rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens.catalog.registry import query
from postlens.catalog.tables import (
    KW0,
    KW1,
    MAJORITY_SQL,
    RULE_SQL,
    SCORE0_SQL,
    SCORE1_SQL,
    TIME_FORMAT,
    labelled_texts,
    name_sql,
    posts,
    posts_as_text,
    table,
    texts,
    utc,
    with_labels,
    with_posts,
)
from postlens.functions import presets
from postlens.operators import cleaning, ranking, rules
from postlens.plans.reports import clean_posts

_TAG = "CASE post_id % 4 WHEN 0 THEN '[P] ' WHEN 1 THEN '[D] ' WHEN 2 THEN '[R] ' ELSE '' END"
_SPAM = "CASE WHEN post_id % 7 = 0 THEN ' Click HERE' ELSE '' END"
_RAW_SQL = f"raw AS (SELECT * REPLACE ({_TAG} || text || {_SPAM} AS text) FROM posts)"
_EDGE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"
_GOOD_SQL = (
    rf"(length(regexp_replace(regexp_replace(text, '\[.*?\]', '', 'g'), '^{_EDGE}|{_EDGE}$', '', 'g')) >= 30"
    + "".join(f" AND NOT regexp_matches(text, '(?i){p}')" for p in presets.SPAM_PATTERNS)
    + ")"
)


def raw_posts(df):
    """Texts with a title tag in front and a spam phrase behind some of them."""
    k = F.col("post_id") % 4
    tag = F.when(k == 0, "[P] ").when(k == 1, "[D] ").when(k == 2, "[R] ").otherwise("")
    spam = F.when(F.col("post_id") % 7 == 0, " Click HERE").otherwise("")
    return df.withColumn("text", F.concat(tag, "text", spam))


@query("b1_filter_labelled", with_posts("SELECT post_id, label FROM posts WHERE label IS NOT NULL"))
def b1(spark, sf_dir):
    return cleaning.filter_labelled(labelled_texts(spark, sf_dir)).select("post_id", "label")


@query(
    "b2_fill_null_text",
    with_posts(
        """SELECT post_id, coalesce(CASE WHEN label IS NOT NULL THEN text END, '') AS text,
                  coalesce(CASE WHEN label = 1 THEN source END, 'unknown') AS author FROM posts"""
    ),
)
def b2(spark, sf_dir):
    holes = labelled_texts(spark, sf_dir).select(
        "post_id",
        F.when(F.col("label").isNotNull(), F.col("text")).alias("text"),
        F.when(F.col("label") == 1, F.col("source")).alias("author"),
    )
    return cleaning.fill_nulls(holes, {"text": "", "author": "unknown"})


@query(
    "b3_label_name",
    with_posts(
        f"""SELECT post_id, {name_sql('label')} AS name_or_null, {name_sql('label', 'Neutral')} AS name_or_neutral,
                   {name_sql('label', 'Unknown')} AS name_or_unknown FROM posts"""
    ),
)
def b3(spark, sf_dir):
    named = labelled_texts(spark, sf_dir).select("post_id", "label")
    for out, default in (("name_or_null", None), ("name_or_neutral", "Neutral"), ("name_or_unknown", "Unknown")):
        named = cleaning.with_label_name(named, default=default, out=out)
    return named.drop("label")


@query(
    "b4_project_rename",
    with_posts(
        f"""SELECT post_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", source, text,
                   {RULE_SQL} AS category FROM posts"""
    ),
)
def b4(spark, sf_dir):
    return cleaning.project_classified(rules.classify_first(posts_as_text(spark, sf_dir), "text", KW0, KW1), "pred")


@query(
    "b4_project_predictions",
    with_posts(
        f"""SELECT post_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", source, subreddit, text,
                   upvotes, comments, {RULE_SQL} AS predicted_label,
                   {name_sql(f'({RULE_SQL})', 'Neutral')} AS predicted_category FROM posts"""
    ),
)
def b4_predictions(spark, sf_dir):
    return cleaning.project_predictions(
        rules.classify_first(posts_as_text(spark, sf_dir), "text", KW0, KW1), "pred"
    )


@query(
    "b5_keyword_filter",
    with_posts("SELECT post_id, text FROM posts WHERE contains(lower(text), 'license')"),
)
def b5(spark, sf_dir):
    return cleaning.keyword_filter(texts(spark, sf_dir), "License").select("post_id", "text")


@query(
    "b6_keyword_search_multi",
    with_posts(
        """SELECT post_id, matched_keyword, copy FROM (
             SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY copy, pos) AS rn FROM (
               SELECT post_id, copy, k.pos, k.word AS matched_keyword
               FROM (SELECT post_id, text, 0 AS copy FROM posts WHERE label IS NOT NULL
                     UNION ALL SELECT post_id, text, 1 FROM posts) p
               JOIN (VALUES (0, 'license'), (1, 'token'), (2, 'free'), (3, 'thing')) k(pos, word)
                 ON contains(lower(p.text), k.word)))
           WHERE rn = 1"""
    ),
)
def b6(spark, sf_dir):
    rows = labelled_texts(spark, sf_dir)
    copies = cleaning.filter_labelled(rows).withColumn("copy", F.lit(0)).unionByName(rows.withColumn("copy", F.lit(1)))
    found = cleaning.keyword_search(
        copies.select("post_id", "text", "copy"), ["license", "token", "free", "thing"], order=["copy"]
    )
    return found.select("post_id", "matched_keyword", "copy")


@query(
    "b7_per_group_cap",
    with_posts(
        """SELECT post_id, source FROM (
             SELECT *, row_number() OVER (PARTITION BY source ORDER BY post_id) AS rn FROM posts) WHERE rn <= 25"""
    ),
)
def b7(spark, sf_dir):
    return ranking.cap_per_group(texts(spark, sf_dir).select("post_id", "source"), "source", 25, ["post_id"])


@query("b8_optional_columns", with_posts("SELECT post_id, source, upvotes, comments FROM posts"))
def b8(spark, sf_dir):
    return cleaning.select_with_optional(
        posts(spark, sf_dir), ["post_id", "source"], ["downs", "upvotes", "score", "comments"]
    )


_PARTS_SQL = """parts AS (
  SELECT post_id, source AS title, CASE WHEN label IS NULL THEN NULL WHEN label = 0 THEN '' WHEN label = 2 THEN ' ' || chr(9)
         ELSE text END AS body FROM posts
)"""


@query(
    "b9_combine_title_body",
    with_posts(
        r"""SELECT post_id,
              title || CASE WHEN regexp_matches(coalesce(body, ''), '\S') THEN ' ' || body ELSE '' END AS blank_joined,
              title || CASE WHEN regexp_matches(coalesce(body, ''), '\S') THEN chr(10) || body ELSE '' END AS line_joined,
              title || '. ' || coalesce(body, '') AS dot_joined,
              title || ' ' || coalesce(body, '') AS always_joined
            FROM parts""",
        _PARTS_SQL,
    ),
)
def b9(spark, sf_dir):
    label = F.col("label")
    body = F.when(label == 0, "").when(label == 2, " \t").when(label.isNotNull(), F.col("text"))
    df = labelled_texts(spark, sf_dir).select("post_id", F.col("source").alias("title"), body.alias("selftext"))
    for out, sep, skip in (
        ("blank_joined", " ", "blank"),
        ("line_joined", "\n", "blank"),
        ("dot_joined", ". ", "never"),
        ("always_joined", " ", "never"),
    ):
        df = cleaning.combine_text(df, sep=sep, skip=skip, out=out)
    return df.drop("title", "selftext")


@query("b10_first_line_title", with_posts("SELECT post_id, split_part(text, chr(10), 1) AS title FROM posts"))
def b10(spark, sf_dir):
    return cleaning.first_line(texts(spark, sf_dir)).select("post_id", "title")


@query(
    "b11_extract_tag",
    with_posts(
        r"""SELECT post_id, coalesce(nullif(regexp_extract(text, '\[([A-Za-z]+)\]', 1), ''), 'Unknown') AS post_type,
                   CASE coalesce(nullif(regexp_extract(text, '\[([A-Za-z]+)\]', 1), ''), 'Unknown')
                     WHEN 'P' THEN 'Project' WHEN 'D' THEN 'Discussion' WHEN 'R' THEN 'Research'
                     WHEN 'Q' THEN 'Question' WHEN 'N' THEN 'News' WHEN 'I' THEN 'Issue'
                     ELSE coalesce(nullif(regexp_extract(text, '\[([A-Za-z]+)\]', 1), ''), 'Unknown') END AS long_name
            FROM raw""",
        _RAW_SQL,
    ),
)
def b11(spark, sf_dir):
    tagged = cleaning.extract_tag(raw_posts(texts(spark, sf_dir)), "text")
    return cleaning.extract_tag(tagged, "text", expand=True, out="long_name").select("post_id", "post_type", "long_name")


@query("b12_quality_filter", with_posts(f"SELECT post_id, text FROM raw WHERE {_GOOD_SQL}", _RAW_SQL))
def b12(spark, sf_dir):
    return cleaning.quality_filter(raw_posts(texts(spark, sf_dir))).select("post_id", "text")


@query(
    "b13_epoch_to_timestamp",
    """SELECT event_id, strftime(date_trunc('second', CASE WHEN event_type = 'error' THEN TIMESTAMP '1970-01-01 00:00:00'
              ELSE ts END), '%Y-%m-%d %H:%M:%S') AS "timestamp" FROM events""",
)
def b13(spark, sf_dir):
    micros = F.unix_micros(utc(F.col("ts")))
    epoch = F.when(F.col("event_type") != "error", micros / F.lit(1e6))
    rows = table(spark, sf_dir, "events").select("event_id", epoch.alias("created_utc"))
    return cleaning.epoch_to_ts(rows).select("event_id", "timestamp")


@query(
    "b14_parse_timestamp",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed,
              event_type = 'error' AS failed FROM events""",
)
def b14(spark, sf_dir):
    text = F.when(F.col("event_type") == "error", "not a time").otherwise(F.date_format("ts", TIME_FORMAT))
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("timestamp"))
    parsed = cleaning.parse_ts(rows)
    return parsed.select(
        "event_id",
        F.date_format("timestamp", TIME_FORMAT).alias("parsed"),
        F.col("timestamp").isNull().alias("failed"),
    )


@query(
    "b15_recent_posts",
    f"""SELECT event_id AS post_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at, category,
               {name_sql('category', 'Neutral')} AS category_name
        FROM (SELECT *, CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 WHEN 'view' THEN 2 ELSE 3 END AS category
              FROM events)
        WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""",
)
def b15(spark, sf_dir):
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("post_id"),
        F.col("ts").alias("created_at"),
        F.when(kind == "error", 0).when(kind == "purchase", 1).when(kind == "view", 2).otherwise(3).alias("category"),
    )
    return cleaning.recent_posts(rows).withColumn("created_at", F.date_format("created_at", TIME_FORMAT))


@query("b16_processing_time", with_posts("SELECT post_id, true AS stamped FROM posts"))
def b16(spark, sf_dir):
    stamped = cleaning.stamp_processing(texts(spark, sf_dir))
    return stamped.select("post_id", (F.col("created_at") > F.lit("2024-01-01").cast("timestamp")).alias("stamped"))


@query(
    "b17_preview_projection",
    with_posts(
        f"""SELECT post_id, '[' || {name_sql('coalesce(label, 2)', 'Unknown')} || '] [' || coalesce(source, '') || '] '
                   || substr(coalesce(text, ''), 1, 80) || '...' AS line FROM posts"""
    ),
)
def b17(spark, sf_dir):
    starts = texts(spark, sf_dir).withColumn("text", F.substring("text", 1, 80))
    return cleaning.preview(with_labels(starts, spark, sf_dir), category="label").select("post_id", "line")


@query(
    "b18_permalink",
    with_posts(
        "SELECT post_id, 'https://www.reddit.com/' || subreddit || '/comments/' || post_id AS permalink FROM posts"
    ),
)
def b18(spark, sf_dir):
    return cleaning.with_permalink(texts(spark, sf_dir)).select("post_id", "permalink")


_REPLY_SQL = """replies AS (
  SELECT post_id, CASE post_id % 5 WHEN 0 THEN '1' WHEN 1 THEN 'Answer: 0' WHEN 2 THEN 'Security RISK'
         WHEN 3 THEN 'productivity gain' ELSE 'none: ' || text END AS reply FROM posts
)"""


@query(
    "b20_parse_label_text",
    with_posts(
        """SELECT post_id,
             CASE WHEN regexp_matches(reply, '[012]') THEN CAST(regexp_extract(reply, '[012]') AS INTEGER)
                  WHEN regexp_matches(lower(reply), 'security|risk|安全') THEN 0
                  WHEN regexp_matches(lower(reply), 'productivity|gain|生产力') THEN 1 ELSE 2 END AS label,
             CASE WHEN regexp_matches(reply, '[012]') THEN CAST(regexp_extract(reply, '[012]') AS INTEGER)
                  ELSE -2 END AS strict_label
           FROM replies""",
        _REPLY_SQL,
    ),
)
def b20(spark, sf_dir):
    k = F.col("post_id") % 5
    reply = (
        F.when(k == 0, "1").when(k == 1, "Answer: 0").when(k == 2, "Security RISK")
        .when(k == 3, "productivity gain").otherwise(F.concat(F.lit("none: "), "text"))
    )
    rows = texts(spark, sf_dir).select("post_id", reply.alias("reply"))
    both = rules.parse_label(rules.parse_label(rows), strict=True, out="strict_label")
    return both.select("post_id", "label", "strict_label")


@query(
    "b21_render_prompt",
    with_posts("SELECT post_id, 'Classify: ' || substr(text, 1, 500) || ' Answer with 0, 1 or 2.' AS prompt FROM posts"),
)
def b21(spark, sf_dir):
    template = "Classify: {text} Answer with 0, 1 or 2."
    return rules.render_prompt(texts(spark, sf_dir), template, n=500).select("post_id", "prompt")


@query("c3_keyword_classify_first", with_posts(f"SELECT post_id, {RULE_SQL} AS pred FROM posts"))
def c3(spark, sf_dir):
    return rules.classify_first(texts(spark, sf_dir), "text", KW0, KW1).select("post_id", "pred")


_PAIRS = {
    "weak": (presets.WEAK_LABEL_SECURITY, presets.WEAK_LABEL_PRODUCTIVITY),
    "first": (presets.FIRST_MATCH_SECURITY, presets.FIRST_MATCH_PRODUCTIVITY),
    "bilingual": (presets.BILINGUAL_SECURITY, presets.BILINGUAL_PRODUCTIVITY),
    "leak": (presets.LEAK_SECURITY, presets.LEAK_PRODUCTIVITY),
    "supply_chain": (presets.SUPPLY_CHAIN_SECURITY, presets.SUPPLY_CHAIN_PRODUCTIVITY),
    "short": (presets.SHORT_SECURITY, presets.SHORT_PRODUCTIVITY),
    "majority": (presets.MAJORITY_SECURITY, presets.MAJORITY_PRODUCTIVITY),
}


def _first_match_sql(kw0, kw1):
    has = [" OR ".join(f"contains(lower(coalesce(text, '')), {k!r})" for k in kws) for kws in (kw0, kw1)]
    return f"CASE WHEN {has[0]} THEN 0 WHEN {has[1]} THEN 1 ELSE 2 END"


@query(
    "c3_all_list_pairs",
    with_posts(
        "SELECT post_id, " + ", ".join(f"{_first_match_sql(*pair)} AS {name}" for name, pair in _PAIRS.items()) + " FROM posts"
    ),
)
def c3_pairs(spark, sf_dir):
    """Every pair of keyword lists as a first-match rule, one column for each."""
    rows = texts(spark, sf_dir)
    for name, (kw0, kw1) in _PAIRS.items():
        rows = rules.classify_first(rows, "text", kw0, kw1, out=name)
    return rows.select("post_id", *_PAIRS)


@query(
    "c4_keyword_classify_majority",
    with_posts(f"SELECT post_id, {SCORE0_SQL} AS score0, {SCORE1_SQL} AS score1, {MAJORITY_SQL} AS pred FROM posts"),
)
def c4(spark, sf_dir):
    return rules.classify_majority(texts(spark, sf_dir), "text", KW0, KW1).select("post_id", "score0", "score1", "pred")


def weak_labels(spark, sf_dir, kw0, kw1):
    """The rule goes before the join, which then has no text."""
    ruled = rules.classify_first(texts(spark, sf_dir), "text", kw0, kw1, out="rule").select("post_id", "rule")
    return rules.fill_from_rule(with_labels(ruled, spark, sf_dir), "rule").select("post_id", "label")


@query("c5_weak_label", with_posts(f"SELECT post_id, coalesce(label, {RULE_SQL}) AS label FROM posts"))
def c5(spark, sf_dir):
    return weak_labels(spark, sf_dir, kw0=KW0, kw1=KW1)


_WEAK_RULE_SQL = " ".join(
    f"WHEN {' OR '.join(f'contains(lower(text), {k!r})' for k in kws)} THEN {cls}"
    for cls, kws in ((0, presets.WEAK_LABEL_SECURITY), (1, presets.WEAK_LABEL_PRODUCTIVITY))
)


@query(
    "c5_weak_label_default_lists",
    with_posts(f"SELECT post_id, coalesce(label, CASE {_WEAK_RULE_SQL} ELSE 2 END) AS label FROM posts"),
)
def c5_default(spark, sf_dir):
    return weak_labels(spark, sf_dir, presets.WEAK_LABEL_SECURITY, presets.WEAK_LABEL_PRODUCTIVITY)


@query(
    "d10_clean_attrition",
    with_posts(
        f"""SELECT rows_in, low_quality, ((2000 * low_quality + rows_in) // (2 * rows_in)) / 10.0::DOUBLE AS pct,
                   rows_in - low_quality - rows_out AS duplicates, rows_out
            FROM (SELECT count(*) AS rows_in, count(*) FILTER (NOT good) AS low_quality,
                         count(DISTINCT post_id) FILTER (good) AS rows_out
                  FROM (SELECT post_id, {_GOOD_SQL} AS good FROM
                        (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE label IS NOT NULL)))""",
        _RAW_SQL,
    ),
)
def d10(spark, sf_dir):
    flagged = cleaning.with_quality(raw_posts(texts(spark, sf_dir))).select("post_id", "good")
    raw = with_labels(flagged, spark, sf_dir)
    return cleaning.clean_attrition(raw.unionByName(cleaning.filter_labelled(raw)), good="good")


@query(
    "j1_union_sources",
    with_posts(
        """SELECT post_id, source, text, NULL::BIGINT AS item_id FROM posts
           UNION ALL SELECT NULL, NULL, text, item_id FROM benchmark
           UNION ALL SELECT conv_id, role, text, NULL FROM conversations"""
    ),
)
def j1(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("post_id"), F.col("role").alias("source"), "text"
    )
    frames = [texts(spark, sf_dir).select("post_id", "source", "text"), table(spark, sf_dir, "benchmark"), turns]
    return cleaning.union_sources(frames)


@query("j2_label_dim_join", with_posts(f"SELECT post_id, {name_sql('label')} AS category_name FROM posts"))
def j2(spark, sf_dir):
    return cleaning.join_label_name(labelled_texts(spark, sf_dir)).select("post_id", "category_name")


@query(
    "clean_posts",
    with_posts(
        rf"""SELECT post_id, 'unknown' AS user_id, split_part(text, chr(10), 1) AS title, text AS content,
                    coalesce(nullif(regexp_extract(text, '\[([A-Za-z]+)\]', 1), ''), 'Unknown') AS post_type,
                    source, subreddit AS source_subreddit, 'reddit' AS source_category,
                    strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", upvotes, comments
             FROM raw WHERE {_GOOD_SQL}""",
        _RAW_SQL,
    ),
)
def clean(spark, sf_dir):
    raw = raw_posts(posts_as_text(spark, sf_dir))
    twice = raw.unionByName(cleaning.filter_labelled(raw)).drop("label")
    cleaned = clean_posts(twice, ["timestamp"])
    return cleaned.withColumn("timestamp", F.date_format("timestamp", TIME_FORMAT))
