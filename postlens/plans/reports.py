"""The batch report and the clean-up run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions import text as tx
from postlens.operators import cleaning, reports, words
from postlens.sources.writers import write_csv


def batch_reports(labelled: DataFrame) -> dict[str, DataFrame]:
    """The four exports over labelled posts, each a lazy plan of its own."""
    return {
        "overall_breakdown": reports.overall_breakdown(labelled),
        "daily_trend": reports.daily_trend(labelled),
        "by_source": reports.by_source(labelled),
        "top_keywords": words.top_keywords(labelled).orderBy("label", "rank", "word"),
    }


def export_reports(labelled: DataFrame, out_dir: str) -> dict[str, str]:
    """Write the four exports as CSV; returns the path of each.

    What the reports read is stored once, the words picked from the texts, so that the
    input's joins and scoring run once and not for each export.
    """
    narrow = labelled.select("label", "timestamp", "source", "text")
    stored = f"{out_dir}/_posts"
    words.real_words(narrow).write.mode("overwrite").parquet(stored)
    labelled = labelled.sparkSession.read.parquet(stored)
    paths = {}
    for name, report in batch_reports(labelled).items():
        paths[name] = f"{out_dir}/{name}"
        write_csv(report, paths[name])
    return paths


def clean_posts(raw: DataFrame, order: list[str]) -> DataFrame:
    """Cleaned posts: tag, title, author, parsed time; low quality and copies dropped.

    `order` says which copy of a post is the first.
    """
    title = F.col("title") if "title" in raw.columns else tx.first_line(F.col("text"))
    tagged = F.col("title") if "title" in raw.columns else F.col("text")
    author = F.coalesce("author", F.lit("unknown")) if "author" in raw.columns else F.lit("unknown")
    first = cleaning.dedup_first(cleaning.quality_filter(raw), "post_id", order)
    shaped = cleaning.parse_ts(
        first.withColumns(
            {
                "post_type": tx.title_tag(tagged),
                "user_id": author,
                "title": title,
                "content": F.col("text"),
                "source_subreddit": F.col("subreddit"),
                "source_category": F.lit("reddit"),
            }
        )
    )
    return cleaning.select_with_optional(
        shaped,
        [
            "post_id", "user_id", "title", "content", "post_type", "source", "source_subreddit",
            "source_category", "timestamp", "upvotes", "comments",
        ],
        ["downs", "score", "link_flair", "permalink"],
    )
