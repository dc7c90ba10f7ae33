"""Filters, projections and clean-up of raw posts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions import presets, times
from postlens.functions import text as tx
from postlens.functions.labels import label_name
from postlens.functions.numbers import percent
from postlens.operators.ranking import dedup_first
from postlens.schema import LABEL_NAMES, NEUTRAL


def filter_labelled(df: DataFrame, label: str = "label") -> DataFrame:
    return df.filter(F.col(label).isNotNull())


def fill_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def with_label_name(
    df: DataFrame,
    label: str = "label",
    names: Mapping[int, str] = LABEL_NAMES,
    default: str | None = None,
    out: str = "category_name",
) -> DataFrame:
    """Add the class name; `default` is for a class that has none (None = null)."""
    return df.withColumn(out, label_name(F.col(label), names, default))


def join_label_name(
    df: DataFrame, label: str = "label", names: Mapping[int, str] = LABEL_NAMES, out: str = "category_name"
) -> DataFrame:
    """Add the class name by a join; the dimension holds one row per entry of `names`."""
    dimension = df.sparkSession.createDataFrame(list(names.items()), f"_cls int, `{out}` string")
    return df.join(F.broadcast(dimension), F.col(label) == F.col("_cls"), "left").drop("_cls")


def project_classified(
    df: DataFrame, pred: str = "prediction", key: str = "post_id", keep: Sequence[str] = ()
) -> DataFrame:
    """Columns of a classified post; the model's double prediction becomes an int."""
    return df.select(
        F.col(key).alias("post_id"),
        "timestamp",
        "source",
        "text",
        F.col(pred).cast("int").alias("category"),
        *keep,
    )


def project_predictions(df: DataFrame, pred: str = "prediction") -> DataFrame:
    """All post columns with the predicted class and its name (unknown = Neutral)."""
    return df.select(
        "post_id",
        "timestamp",
        "source",
        "subreddit",
        "text",
        "upvotes",
        "comments",
        F.col(pred).cast("int").alias("predicted_label"),
        label_name(F.col(pred).cast("int"), default=LABEL_NAMES[NEUTRAL]).alias("predicted_category"),
    )


def keyword_filter(df: DataFrame, keyword: str, cols: Sequence[str] = ("text",)) -> DataFrame:
    """Posts that hold the keyword in the given columns, read as one blank-joined text."""
    return df.filter(tx.contains_ci(F.concat_ws(" ", *cols), keyword))


def keyword_search(
    df: DataFrame,
    keywords: Sequence[str],
    cols: Sequence[str] = ("text",),
    key: str = "post_id",
    order: Sequence[str | Column] = (),
) -> DataFrame:
    """Each matching post once, with the first keyword (in list order) that it holds.

    `order` ranks the copies of a post before the keyword position does, for
    instance by the group that was searched first.
    """
    text = F.lower(F.concat_ws(" ", *cols))
    hits = [F.when(text.contains(k.lower()), F.lit(i)) for i, k in enumerate(keywords)]
    position = reduce(lambda a, b: F.coalesce(a, b), hits)
    found = df.withColumn("_pos", position).filter(F.col("_pos").isNotNull())
    first = dedup_first(found, key, [*order, "_pos"])
    words = F.array(*[F.lit(k) for k in keywords])
    return first.withColumn("matched_keyword", F.get(words, F.col("_pos"))).drop("_pos")


def select_with_optional(df: DataFrame, required: Sequence[str], optional: Sequence[str]) -> DataFrame:
    """Required columns plus those optional ones the frame has."""
    return df.select(*required, *[c for c in optional if c in df.columns])


def combine_text(
    df: DataFrame, title: str = "title", body: str = "selftext", sep: str = " ", skip: str = "blank",
    out: str = "text",
) -> DataFrame:
    return df.withColumn(out, tx.combined(F.col(title), F.col(body), sep, skip))


def first_line(df: DataFrame, text: str = "text", out: str = "title") -> DataFrame:
    return df.withColumn(out, tx.first_line(F.col(text)))


def extract_tag(df: DataFrame, title: str = "title", expand: bool = False, out: str = "post_type") -> DataFrame:
    return df.withColumn(out, tx.title_tag(F.col(title), expand))


def quality_filter(
    df: DataFrame,
    text: str = "text",
    min_len: int = 30,
    patterns: Sequence[str] = tuple(presets.SPAM_PATTERNS),
    flag: str | None = None,
) -> DataFrame:
    """Keep posts of good quality, or mark each row when `flag` names a column."""
    good = tx.is_quality(F.col(text), min_len, patterns)
    return df.filter(good) if flag is None else df.withColumn(flag, good)


def epoch_to_ts(df: DataFrame, col: str = "created_utc", out: str = "timestamp") -> DataFrame:
    return df.withColumn(out, times.epoch_string(F.col(col)))


def parse_ts(
    df: DataFrame, col: str = "timestamp", fmt: str | None = "yyyy-MM-dd HH:mm:ss", out: str = "timestamp"
) -> DataFrame:
    return df.withColumn(out, times.parse_timestamp(F.col(col), fmt))


def recent_posts(
    df: DataFrame,
    ts: str = "created_at",
    days: int = 7,
    as_of: object | None = None,
    category: str = "category",
    key: str = "post_id",
) -> DataFrame:
    """Posts of the last `days` days before `as_of` (default: the newest post), newest first."""
    until = F.lit(as_of).cast("timestamp") if as_of is not None else df.agg(F.max(ts).alias("m")).scalar()
    named = with_label_name(df, category, default=LABEL_NAMES[NEUTRAL], out="category_name")
    return named.filter(F.col(ts) >= until - F.make_dt_interval(F.lit(days))).orderBy(F.desc(ts), F.asc(key))


def stamp_processing(df: DataFrame, out: str = "created_at") -> DataFrame:
    return df.withColumn(out, F.current_timestamp())


def preview(df: DataFrame, n: int = 80, category: str = "category", out: str = "line") -> DataFrame:
    """`[class name] [source] first n characters...` of each post."""
    name = label_name(F.coalesce(F.col(category).cast("int"), F.lit(NEUTRAL)), default="Unknown")
    start = F.substring(F.coalesce(F.col("text"), F.lit("")), 1, n)
    return df.withColumn(out, F.format_string("[%s] [%s] %s...", name, F.coalesce("source", F.lit("")), start))


def with_permalink(df: DataFrame, group: str = "subreddit", key: str = "post_id") -> DataFrame:
    return df.withColumn("permalink", tx.permalink(F.col(group), F.col(key)))


def union_sources(dfs: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; a column some frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def with_quality(df: DataFrame, text: str = "text", out: str = "good") -> DataFrame:
    """Whether the text passes the quality filter."""
    return df.withColumn(out, tx.is_quality(F.col(text)))


def clean_attrition(df: DataFrame, key: str = "post_id", text: str = "text", good: str | None = None) -> DataFrame:
    """Rows in, rows dropped for quality (and their share), duplicates, rows out; one scan.

    `good` names a column that already says which rows pass.
    """
    passes = tx.is_quality(F.col(text)) if good is None else F.col(good)
    flagged = df.select(F.col(key).alias("k"), passes.alias("good"))
    # Rows without a key are copies of each other too, and count_distinct skips them.
    null_key = F.max((F.col("good") & F.col("k").isNull()).cast("int"))
    counted = flagged.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~F.col("good")).alias("low_quality"),
        (F.count_distinct(F.when(F.col("good"), F.col("k"))) + F.coalesce(null_key, F.lit(0))).alias("rows_out"),
    )
    return counted.select(
        "rows_in",
        "low_quality",
        percent(F.col("low_quality"), F.col("rows_in")).alias("pct"),
        (F.col("rows_in") - F.col("low_quality") - F.col("rows_out")).alias("duplicates"),
        "rows_out",
    )
