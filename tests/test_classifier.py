"""Features, splits, training and scoring."""

import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from postlens.catalog.tables import labelled_texts
from postlens.operators import classifier

DATA = [
    (i, label, f"{word} report number{i} {word} again and the rest")
    for i, (label, word) in enumerate([(0, "breach"), (1, "faster"), (2, "question")] * 20)
]


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.createDataFrame(DATA, "post_id int, label int, text string")


@pytest.fixture(scope="module")
def model(labelled):
    return classifier.fit_classifier(labelled)


def test_model_learns_and_beats_the_majority(labelled, model):
    scored = classifier.score(labelled, model)
    row = classifier.model_metrics(scored).first()
    assert row["accuracy"] > 0.9


def test_metrics_are_those_of_the_evaluator(spark):
    pairs = [(0, 0.0)] * 5 + [(0, 1.0)] * 2 + [(1, 1.0)] * 3 + [(1, 2.0)] + [(2, 2.0)] * 4 + [(2, 0.0)] * 3
    scored = spark.createDataFrame(pairs, "label int, prediction double")
    row = classifier.model_metrics(scored).first()
    as_double = scored.withColumn("label", F.col("label").cast("double"))
    for metric, name in (
        ("accuracy", "accuracy"), ("weightedPrecision", "w_precision"), ("weightedRecall", "w_recall"), ("f1", "w_f1"),
    ):
        evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName=metric)
        assert row[name] == pytest.approx(evaluator.evaluate(as_double))


def test_null_text_is_scored(spark, model):
    rows = classifier.score(spark.createDataFrame([(1, None), (2, "")], "post_id int, text string"), model).collect()
    assert [r["text"] for r in rows] == ["", ""] and all(r["predicted_category"] for r in rows)


def test_save_and_load(spark, labelled, model, tmp_path):
    path = str(tmp_path / "model")
    classifier.save_model(model, path)
    classifier.save_model(model, path)
    again = classifier.score(labelled, classifier.load_model(path)).select("post_id", "prediction").collect()
    first = classifier.score(labelled, model).select("post_id", "prediction").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, first))


def test_ensure_label_modes(spark, model):
    df = spark.createDataFrame([(1, 2, "breach"), (2, None, "breach breach report")], "post_id int, label int, text string")
    kept = {r["post_id"]: r["label"] for r in classifier.ensure_label(df, model).collect()}
    assert kept == {1: 2, 2: 0}
    every = {r["post_id"]: r["label"] for r in classifier.ensure_label(df, model, "all").collect()}
    assert every == {1: 0, 2: 0}
    bare = classifier.ensure_label(df.drop("label"), model)
    assert bare.columns == ["post_id", "text", "label"] and bare.filter("label IS NULL").count() == 0
    with pytest.raises(ValueError):
        classifier.ensure_label(df, model, "some")


def test_confidence_and_uncertain(spark):
    df = spark.createDataFrame(
        [(1, Vectors.dense(0.4, 0.6, 0.0)), (2, Vectors.dense(0.41, 0.5, 0.09)), (3, Vectors.dense(0.6, 0.2, 0.2)),
         (4, Vectors.dense(0.5, 0.5, 0.0))],
        ["post_id", "probability"],
    )
    assert [r["confidence"] for r in classifier.with_confidence(df).collect()] == [0.6, 0.5, 0.6, 0.5]
    assert sorted(r["post_id"] for r in classifier.uncertain(df).collect()) == [2, 4]


def test_idf_weights(spark, labelled):
    from pyspark.ml import Pipeline

    stages = classifier.feature_stages()
    hashed = Pipeline(stages=stages[:3]).fit(labelled).transform(labelled)
    fitted = classifier.idf().fit(hashed)
    m = labelled.count()
    for n, weight in zip(fitted.docFreq, fitted.idf.toArray()):
        assert weight == pytest.approx(math.log((m + 1) / (n + 1)) if n >= 2 else 0.0)
    # Each of the words unique to one text has weight 0, each class word ln(61 / 21).
    assert max(fitted.idf.toArray()) == pytest.approx(math.log(61 / 21))


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(5000).withColumnRenamed("id", "post_id")
    train, test = classifier.split(df, "post_id")
    again, _ = classifier.split(df.repartition(13).orderBy(F.rand()), "post_id")
    assert {r[0] for r in train.collect()} == {r[0] for r in again.collect()}
    assert train.count() + test.count() == 5000
    assert 0.77 < train.count() / 5000 < 0.83
    assert classifier.split(df, "post_id", 1.0)[1].count() == 0
    other, _ = classifier.split(df, "post_id", seed=7)
    assert {r[0] for r in other.collect()} != {r[0] for r in train.collect()}


def test_random_split_covers_all_rows(spark):
    train, test = classifier.random_split(spark.range(1000))
    assert train.count() + test.count() == 1000


def test_stratified_split_takes_the_share_of_every_class(spark):
    data = [(i, 0) for i in range(1000)] + [(i, 1) for i in range(1000, 1007)] + [(2000, 2), (2001, None), (2002, 9)]
    df = spark.createDataFrame(data, "post_id int, label int").repartition(6)
    marked = classifier.stratified_split(df)
    assert marked.columns == ["post_id", "label", "is_train"]
    got = {r["label"]: (r["n"], r["t"]) for r in marked.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_train").alias("t")).collect()}
    assert got[0] == (1000, 800) and got[1] == (7, 6) and got[2] == (1, 1)
    assert got[None][0] == got[9][0] == 1 and got[None][1] + got[9][1] == 2
    assert classifier.stratified_split(df.limit(0)).count() == 0


def test_ngram_vocabulary(spark, labelled):
    from pyspark.ml import Pipeline

    fitted = Pipeline(stages=classifier.ngram_stages(n=2, vocab=10)).fit(labelled)
    out = fitted.transform(labelled).select("grams", "features").first()
    assert "breach report" in out["grams"] and "breach rest" in out["grams"]
    assert len(fitted.stages[4].vocabulary) == 10
    assert float(out["features"].norm(2)) == pytest.approx(1.0) or not out["features"].numNonzeros()
    three = Pipeline(stages=classifier.ngram_stages(n=3)).fit(labelled).transform(labelled).first()["grams"]
    assert any(g.count(" ") == 2 for g in three)


@pytest.mark.parametrize("kind, params", [("logistic", {"maxIter": 5}), ("bayes", {}), ("forest", {"numTrees": 5, "maxDepth": 4})])
def test_other_models(labelled, kind, params):
    stages = [*classifier.feature_stages(buckets=500), classifier.model_stage(kind, **params)]
    scored = classifier.score(labelled, classifier.fit_classifier(labelled, stages))
    assert classifier.model_metrics(scored).first()["accuracy"] > 0.6
    with pytest.raises(ValueError):
        classifier.model_stage("network")


def test_tune_reports_each_strength(labelled):
    best, grid = classifier.tune(labelled, classifier.feature_stages(buckets=500), reg=(0.01, 10.0), folds=2, max_iter=5)
    assert [r for r, _ in grid] == [0.01, 10.0] and best.stages


def test_retrain_leaves_error_codes_out(spark, labelled):
    coded = labelled.withColumn("rule", F.when(F.col("post_id") < 3, -2).otherwise(F.col("label")))
    _, differ = classifier.retrain(coded, "rule")
    assert differ.filter("rule < 0").count() == 0 and "prediction" in differ.columns


def test_model_on_the_given_texts_beats_a_constant(spark):
    labelled = labelled_texts(spark, "/root/testdata/sf0.01").filter("label IS NOT NULL")
    train, test = classifier.split(labelled, "post_id")
    stages = [*classifier.feature_stages(), classifier.logistic(max_iter=10)]
    scored = classifier.score(test, classifier.fit_classifier(train, stages))
    counts = {r["label"]: r["n"] for r in test.groupBy("label").agg(F.count("*").alias("n")).collect()}
    metrics = classifier.model_metrics(scored).first()
    # Recall of the smaller classes is what always naming the largest class cannot give.
    assert metrics["w_precision"] > (max(counts.values()) / sum(counts.values())) ** 2


def test_ngram_vocabulary_takes_ties_in_byte_order(spark):
    df = spark.createDataFrame([(1, "zeta beta"), (2, "zeta alpha"), (3, ""), (4, "zeta")], "post_id int, text string")
    model = classifier.fit_ngram_features(df, vocab=2)
    assert model.stages[-3].vocabulary == ["zeta", "alpha"]
    rows = model.transform(df).orderBy("post_id").collect()
    assert [round(float(r.features.norm(2)), 9) for r in rows] == [1.0, 1.0, 0.0, 1.0]
