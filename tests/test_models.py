"""Tables behind the models against brute force and against Spark ML."""

import math
import random
from collections import Counter

import duckdb
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from postlens.operators import calibration, certificate, classifier, linear_tables, term_bayes, word_vectors

WORDS = [f"w{i}" for i in range(30)]


def bags(seed=1, n=90):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        label = rng.choice([0, 1, 2])
        rows.append((i, label if i % 10 else None, [rng.choice(WORDS[label * 6 : label * 6 + 14]) for _ in range(rng.randrange(0, 25))]))
    return [*rows, (900, 1, []), (901, None, ["never", "seen"])]


@pytest.fixture(scope="module")
def tokens(spark):
    return spark.createDataFrame(bags(), "post_id long, label int, filtered array<string>")


def test_pair_counts_and_weights_equal_brute_force(tokens):
    counts, often = Counter(), Counter()
    for _, _, t in bags():
        often.update(t)
        for i, a in enumerate(t):
            counts.update((a, t[j]) for j in range(max(0, i - 2), min(len(t), i + 3)) if j != i)
    counts = {k: n for k, n in counts.items() if often[k[0]] >= 20 and often[k[1]] >= 20}
    assert 0 < len(counts) < 900 and any(n < 20 for n in often.values())
    margin = Counter()
    for (a, _), n in counts.items():
        margin[a] += n
    total = sum(margin.values())
    found = word_vectors.positive_pmi(word_vectors.pair_counts(tokens, window=2, min_count=20)).collect()
    assert {(r.word, r.context): r.n for r in found} == counts
    for r in found:
        assert r.ppmi == pytest.approx(max(0.0, math.log(r.n * total / (margin[r.word] * margin[r.context]))), abs=1e-12)


def test_vectors_do_not_depend_on_the_partitioning_and_keep_neighbours_close(tokens):
    one, two = (
        {r.word: r.vector for r in word_vectors.fit_word_vectors(df, min_count=1, size=256).collect()} for df in (tokens, tokens.repartition(7))
    )
    assert one.keys() == two.keys() and {len(v) for v in one.values()} == {256}
    for word, vector in one.items():
        assert vector == pytest.approx(two[word], abs=1e-9)

    def cosine(a, b):
        return sum(x * y for x, y in zip(one[a], one[b])) / math.sqrt(sum(x * x for x in one[a]) * sum(x * x for x in one[b]))

    # w0-w5 occur in class 0 only, w20-w25 in class 2 only.
    assert cosine("w0", "w1") > cosine("w0", "w22") + 0.2


def test_mean_vectors_count_repeats_and_give_zeros(spark, tokens):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 3.0])], "word string, vector array<double>")
    df = spark.createDataFrame([(1, ["a", "a", "b", "zz"]), (2, ["zz"]), (3, [])], "post_id int, filtered array<string>")
    means = word_vectors.mean_vectors(df, vectors, "post_id", size=2)
    got = {r.post_id: list(r.features) for r in means.collect()}
    assert got[1] == pytest.approx([2 / 3, 1.0]) and got[2] == got[3] == [0.0, 0.0]


def test_bayes_tables_equal_the_model_of_spark(tokens):
    model = term_bayes.fit_terms(tokens)
    scored = {r.post_id: r for r in term_bayes.score_terms(tokens, model, "post_id").collect()}
    labelled = tokens.filter("label IS NOT NULL")
    counted = CountVectorizer(inputCol="filtered", outputCol="features").fit(labelled)
    spark_model = NaiveBayes(smoothing=1.0).fit(counted.transform(labelled))
    expected = spark_model.transform(counted.transform(tokens)).select(
        "post_id", "prediction", vector_to_array("rawPrediction").alias("raw"), vector_to_array("probability").alias("p")
    )
    rows = expected.collect()
    assert len(scored) == len(rows) == len(bags())
    for r in rows:
        mine = scored[r.post_id]
        assert mine.scores == pytest.approx(r.raw, abs=1e-9)
        assert mine.prediction == r.prediction and mine.confidence == pytest.approx(max(r.p))
        best, second, _ = sorted(r.raw, reverse=True)
        assert mine.margin == pytest.approx(best - second, abs=1e-9)


def test_bayes_without_rows(spark):
    none = spark.createDataFrame([], "post_id long, label int, filtered array<string>")
    model = term_bayes.fit_terms(none)
    assert model.terms.collect() == []
    with pytest.raises(ValueError):
        term_bayes.score_terms(none, model, "post_id")


def texts(spark, seed=2, n=150):
    rng = random.Random(seed)
    rows = [(i, i % 3, " ".join(rng.choice(WORDS[(i % 3) * 4 : (i % 3) * 4 + 18]) for _ in range(12))) for i in range(n)]
    return spark.createDataFrame(rows, "post_id long, label int, text string")


def test_certificate_tells_a_converged_model_from_one_stopped_early(spark, tmp_path):
    df = texts(spark)
    stages = classifier.feature_stages(buckets=200)
    rows = df
    for stage in stages:
        rows = (stage.fit(rows) if hasattr(stage, "fit") else stage).transform(rows)
    rows = rows.select("label", "features").cache()
    early = classifier.logistic(max_iter=2, reg=0.05).fit(rows)
    done = classifier.logistic(max_iter=500, reg=0.05).setTol(1e-10).fit(rows)
    failed, passed = (certificate.certificate(rows, m, reg=0.05, tolerance=1e-4).collect() for m in (early, done))
    assert not any(r.optimal for r in failed) and all(r.optimal for r in passed)
    assert {r["class"] for r in passed} == {0, 1, 2} and {r.rows for r in passed} == {150}
    # The loss is the one that training reports, and its likelihood is that of the stored probabilities.
    assert passed[0].loss == pytest.approx(done.summary.objectiveHistory[-1], abs=1e-6)
    path = str(tmp_path / "scored")
    done.transform(rows).select("label", vector_to_array("probability").alias("p")).write.parquet(path)
    likelihood = duckdb.sql(f"SELECT -avg(ln(p[label + 1])) FROM '{path}/*.parquet'").fetchall()[0][0]
    assert 0 < likelihood < passed[0].loss
    # Another strength than the trained one has its optimum elsewhere.
    assert not any(r.optimal for r in certificate.certificate(rows, done, reg=0.5, tolerance=1e-4).collect())


def test_certificate_of_two_classes(spark):
    rows = classifier.feature_stages(buckets=100)
    df = texts(spark).filter("label < 2")
    for stage in rows:
        df = (stage.fit(df) if hasattr(stage, "fit") else stage).transform(df)
    model = classifier.logistic(max_iter=500, reg=0.05).setTol(1e-10).fit(df)
    found = certificate.certificate(df.select("label", "features"), model, reg=0.05, tolerance=1e-4).collect()
    assert [(r["class"], r.optimal) for r in found] == [(1, True)]


def test_out_of_fold_has_every_row_once_whatever_the_partitioning(spark, tmp_path):
    df = texts(spark, n=90).unionByName(spark.createDataFrame([(500, None, "w1 w2")], "post_id long, label int, text string"))
    tables = []
    for i, frame in enumerate((df, df.repartition(5, "text"))):
        scored = classifier.out_of_fold(frame, classifier.feature_stages(buckets=200), "post_id", reg=(0.01, 5.0), folds=3, max_iter=30)
        tables.append({(r.post_id, r.reg): (r.label, r.fold, r.prediction) for r in scored.collect()})
        assert scored.count() == 180
    assert tables[0] == tables[1] and {k[0] for k in tables[0]} == set(range(90))
    assert len({f for _, f, _ in tables[0].values()}) == 3
    scored.write.parquet(str(tmp_path / "oof"))
    sql = f"SELECT reg, count(*), count(*) FILTER (label = prediction) / count(*) FROM '{tmp_path}/oof/*.parquet' GROUP BY reg ORDER BY reg"
    own = classifier.strength_accuracy(scored).orderBy("reg").select("reg", "rows", "accuracy").collect()
    assert [tuple(r) for r in own] == duckdb.sql(sql).fetchall()


def isotonic(rows, right):
    """Greatest of the least means around each bin in use."""
    used = [i for i, n in enumerate(rows) if n]
    mean = lambda a, b: sum(right[a : b + 1]) / sum(rows[a : b + 1])
    return {i: max(min(mean(j, k) for k in used if k >= i) for j in used if j <= i) for i in used}


def test_pooling_equals_the_closed_form():
    rng = random.Random(6)
    for _ in range(200):
        rows = [rng.choice([0, 0, 1, 3, 10]) for _ in range(rng.randrange(1, 9))]
        right = [rng.randrange(n + 1) for n in rows]
        shares = calibration.pooled(rows, right)
        assert len(shares) == len(rows) and shares == sorted(shares)
        for i, share in isotonic(rows, right).items():
            assert shares[i] == pytest.approx(share)
    assert calibration.pooled([0, 0], [0, 0]) == [0.0, 0.0]


def test_calibration_of_scores_at_the_edges(spark):
    rows = [(-1.0, True), (0.0, False), (0.5, True), (1.0, False), (1.5, False), (9.0, True), (None, True), (3.0, None)]
    df = spark.createDataFrame(rows, "s double, ok boolean")
    table = calibration.reliability(df, "s", F.col("ok"), 1.0, 4)
    assert sorted(tuple(r)[:3] for r in table.collect()) == [(0, 3, 2), (1, 2, 0), (3, 1, 1)]
    fitted = calibration.fit_isotonic(df, "s", F.col("ok"), 1.0, 4)
    assert fitted.shares == pytest.approx([0.4, 0.4, 0.4, 1.0])
    kept = calibration.to_relabel(df, fitted, "s").collect()
    assert sorted(r.s for r in kept) == [-1.0, 0.0, 0.5, 1.0, 1.5] and all(r.confidence == pytest.approx(0.4) for r in kept)


def test_terms_behind_buckets(spark, tokens):
    found = classifier.term_dictionary(tokens, buckets=16).collect()
    docs = Counter(w for _, _, t in bags() for w in set(t))
    assert {r.term: r.doc_freq for r in found} == docs
    per_bucket = Counter(r.bucket for r in found)
    assert all(r.collides == (per_bucket[r.bucket] > 1) for r in found) and any(r.collides for r in found)
    one = classifier.hashing_tf(buckets=16).transform(tokens.filter("post_id = 901")).first().raw_features
    assert set(one.indices) == {r.bucket for r in found if r.term in ("never", "seen")}


def linear_rows(spark, classes):
    rng = random.Random(classes)
    rows = [(i, i % classes, " ".join(rng.choice(WORDS[i % classes * 6 : i % classes * 6 + 14]) for _ in range(rng.randrange(25)))) for i in range(120)]
    return spark.createDataFrame([*rows, (200, None, ""), (201, None, "never seen w1 W1 w1"), (202, None, None)], "post_id long, label int, text string")


@pytest.mark.parametrize("classes", [2, 3])
@pytest.mark.parametrize("buckets", [16, 20_000])
def test_scores_from_tables_equal_the_models(spark, classes, buckets):
    df = linear_rows(spark, classes)
    model = classifier.fit_classifier(df, [*classifier.feature_stages(buckets=buckets), classifier.logistic()])
    scored = classifier.with_confidence(classifier.score(df, model))
    want = {r.post_id: (int(r.prediction), r.confidence, vector) for r, vector in ((r, r.probability.toArray()) for r in scored.collect())}
    got = linear_tables.score_linear(scored.select("post_id", "filtered"), linear_tables.linear_tables(spark, model), "post_id").collect()
    assert len(got) == len(want) == 123
    for r in got:
        label, confidence, vector = want[r.post_id]
        assert r.prediction == label and abs(r.confidence - confidence) < 1e-9
        e = [math.exp(s - max(r.scores)) for s in r.scores]
        assert max(abs(a / sum(e) - b) for a, b in zip(e, vector)) < 1e-9


def test_tables_show_a_changed_prediction(spark):
    df = linear_rows(spark, 3)
    one, other = (classifier.fit_classifier(df, [*classifier.feature_stages(), classifier.logistic(max_iter=n, reg=g)]) for n, g in ((100, 0.01), (1, 5.0)))
    scored = classifier.score(df, one).select("post_id", "filtered", F.col("prediction").alias("given"))
    mine = linear_tables.score_linear(scored, linear_tables.linear_tables(spark, other), "post_id")
    assert scored.join(mine, "post_id").filter("given <> prediction").count() > 0
    assert linear_tables.score_linear(scored.limit(0), linear_tables.linear_tables(spark, one), "post_id").collect() == []


def test_tables_of_another_model_are_refused(spark):
    df = linear_rows(spark, 3)
    model = classifier.fit_classifier(df, [*classifier.feature_stages(), classifier.model_stage("bayes")])
    with pytest.raises(ValueError):
        linear_tables.linear_tables(spark, model)
