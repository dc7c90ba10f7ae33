"""A fitted text classifier as plain tables, and its predictions by joins and sums.

The weights of hashed TF-IDF features with a logistic regression are one table with a row per
bucket; an engine without the model's library can score with it, and predictions made
elsewhere can be checked against it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import HashingTF, IDFModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.operators.classifier import hashing_tf
from postlens.session import written


@dataclass
class LinearTables:
    weights: DataFrame  # bucket, w: IDF weight times coefficient, by class
    intercepts: list[float]
    buckets: int
    words: str


def linear_tables(spark: SparkSession, model: PipelineModel) -> LinearTables:
    """The tables of a pipeline of hashed term frequencies, IDF and logistic regression.

    Buckets without a weight in any class have no row. Two classes are written as a
    first one without weights and a second one with the model's.
    """
    hashed, idf, linear = (
        next((s for s in model.stages if isinstance(s, kind)), None) for kind in (HashingTF, IDFModel, LogisticRegressionModel)
    )
    if hashed is None or idf is None or linear is None:
        raise ValueError("needs hashed term frequencies, IDF and a logistic regression")
    if hashed.getBinary() or any(linear.isSet(p) for p in (linear.threshold, linear.thresholds)):
        raise ValueError("binary frequencies and thresholds are not supported")
    scale = idf.idf.toArray()[:, None]
    weights = scale * linear.coefficientMatrix.toArray().T
    intercepts = linear.interceptVector.toArray().tolist()
    if weights.shape[1] == 1:
        weights, intercepts = [[0.0, w] for w in weights[:, 0].tolist()], [0.0, *intercepts]
    else:
        weights = weights.tolist()
    rows = [(i, w) for i, w in enumerate(weights) if any(w)]  # as many as buckets at most
    table = written(spark.createDataFrame(rows, "bucket int, w array<double>"), "linear-weights")
    return LinearTables(table, intercepts, hashed.getNumFeatures(), hashed.getInputCol())


def score_linear(df: DataFrame, tables: LinearTables, key: str) -> DataFrame:
    """(key, scores, prediction, confidence) of every row; `key` is unique.

    Terms are counted by bucket within their row, so that what is joined to the weights, a row
    per bucket, needs no shuffle, and a task passes on a sum for each of its rows. Buckets
    without a weight count for no class. Ties go to the smaller class.
    """
    terms = F.array_compact(F.coalesce(F.col(tables.words), F.array().cast("array<string>")))
    counted = hashing_tf("_words", "_counts", tables.buckets).transform(df.select(F.col(key).alias("_key"), terms.alias("_words")))
    counts = F.unwrap_udt("_counts")
    bags = counted.select("_key", F.explode(F.arrays_zip(counts["indices"].alias("bucket"), counts["values"].alias("n"))).alias("e"))
    classes = range(len(tables.intercepts))
    sums = bags.select("_key", "e.bucket", "e.n").join(tables.weights, "bucket").groupBy("_key").agg(*[F.sum(F.col("n") * F.col("w")[c]).alias(f"s{c}") for c in classes])
    rows = df.select(key).join(sums, F.col(key) == F.col("_key"), "left")
    totals = F.array(*[F.coalesce(f"s{c}", F.lit(0.0)) + F.lit(float(tables.intercepts[c])) for c in classes])
    best = F.array_max("scores")
    confidence = F.lit(1.0) / F.aggregate("scores", F.lit(0.0), lambda a, s: a + F.exp(s - best))
    place = F.array_position("scores", best).cast("int") - 1
    return rows.select(key, totals.alias("scores")).select(key, "scores", place.alias("prediction"), confidence.alias("confidence"))
