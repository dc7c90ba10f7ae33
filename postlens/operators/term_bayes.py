"""Multinomial naive Bayes as tables: one aggregate to fit, one join and sum to score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.session import written


@dataclass
class TermBayes:
    """`terms` has a row per class and term that occur together; `classes` one per class."""

    terms: DataFrame  # label, term, n, log_prob
    classes: DataFrame  # label, docs, tokens, log_prior, log_unseen
    words: str


def fit_terms(df: DataFrame, words: str = "filtered", label: str = "label", smoothing: float = 1.0) -> TermBayes:
    """Log-probabilities of the terms of each class, from one aggregate over (class, term).

    Rows without a label take no part. A term that a class lacks has the class's `log_unseen`.
    """
    labelled = df.filter(F.col(label).isNotNull()).select(F.col(label).cast("int").alias("label"), F.col(words).alias("w"))
    docs = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("docs"))
    counts = labelled.select("label", F.explode("w").alias("term")).groupBy("label", "term").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts, "class-terms")
    sizes = counts.groupBy("label").agg(F.sum("n").alias("tokens"))
    # A row per class, and one number: the size of the vocabulary and the number of documents.
    vocabulary = counts.select("term").distinct().count()
    of_class = docs.join(sizes, "label", "left").select("label", "docs", F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))
    rows = sorted((r["label"], r["docs"], r["tokens"]) for r in of_class.collect())
    every = sum(r[1] for r in rows) + smoothing * len(rows)
    spark = df.sparkSession
    classes = spark.createDataFrame(rows, "label int, docs long, tokens long")
    mass = F.col("tokens") + F.lit(smoothing * vocabulary)
    classes = classes.select(
        "label", "docs", "tokens",
        F.log((F.col("docs") + F.lit(smoothing)) / F.lit(every)).alias("log_prior"),
        F.log(F.lit(smoothing) / mass).alias("log_unseen"),
    )
    likely = F.log((F.col("n") + F.lit(smoothing)) / mass)
    terms = counts.join(F.broadcast(classes.select("label", "tokens")), "label")  # a row per class
    return TermBayes(terms.select("label", "term", "n", likely.alias("log_prob")), classes, words)


def score_terms(df: DataFrame, model: TermBayes, key: str) -> DataFrame:
    """(key, scores, prediction, confidence, margin) of every row.

    `scores` are log prior plus log likelihood by class, ascending; terms never seen in
    training count for no class. Ties go to the smaller class. `confidence` is the
    posterior of the prediction, `margin` how far its score is above the next one's.
    `key` is unique. What a class lacks is added by the number of known terms, so the join
    has a row per term of a text and not one per class. Terms go to the join as they stand:
    counting them by text first would shuffle and hold them once more.
    """
    classes = model.classes.orderBy("label").collect()  # a row per class
    if not classes:
        raise ValueError("nothing was learned: no labelled rows")
    over = [F.sum(F.when(F.col("label") == c["label"], F.col("log_prob") - F.lit(c["log_unseen"]))) for c in classes]
    wide = model.terms.groupBy("term").agg(F.array(*[F.coalesce(x, F.lit(0.0)) for x in over]).alias("over"))
    found = df.select(F.col(key).alias("_key"), F.explode(model.words).alias("term")).join(wide, "term")
    sums = found.groupBy("_key").agg(
        F.count(F.lit(1)).alias("known"), *[F.sum(F.col("over")[i]).alias(f"s{i}") for i in range(len(classes))]
    )
    rows = df.select(key).join(sums, F.col(key) == F.col("_key"), "left")

    def total(i: int) -> Column:
        known = F.coalesce("known", F.lit(0))
        return F.lit(classes[i]["log_prior"]) + known * F.lit(classes[i]["log_unseen"]) + F.coalesce(f"s{i}", F.lit(0.0))

    scored = rows.select(key, F.array(*[total(i) for i in range(len(classes))]).alias("scores"))
    best = F.array_max("scores")
    labels = F.array(*[F.lit(c["label"]) for c in classes])
    place = F.array_position("scores", best).cast("int")
    posterior = F.lit(1.0) / F.aggregate("scores", F.lit(0.0), lambda a, s: a + F.exp(s - best))
    # The second best score; one class alone has nothing to be above of.
    ordered = F.sort_array("scores", asc=False)
    margin = ordered[0] - F.get(ordered, F.lit(1))
    return scored.select(key, "scores", F.element_at(labels, place).alias("prediction"), posterior.alias("confidence"), margin.alias("margin"))
