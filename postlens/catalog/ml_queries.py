"""Text features and the trained model."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from postlens.catalog.hash_sql import bucket_sql
from postlens.catalog.registry import query
from postlens.catalog.stream_queries import message_files, run_job, source
from postlens.catalog.tables import KW0, KW1, labelled_texts, posts, texts, with_labels, with_posts
from postlens.functions.stop_words import ENGLISH
from postlens.operators import classifier, cleaning, evaluation, reports, rules, word_vectors, words
from postlens.plans.reports import export_reports
from postlens.schema import LABEL_NAMES
from postlens.session import new_path, written
from postlens.sources import codec, readers
from postlens.streaming import state_store


_STOP_SQL = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH) + ")"
# A split in the JVM leaves out empty tokens at the end.
_TOKENS_SQL = r"""tokens AS (
  SELECT post_id, label, unnest(string_split_regex(regexp_replace(lower(text), '[\s\x0b]+$', ''), '[\s\x0b]')) AS word
  FROM posts
)"""


@query(
    "c6_tokenize",
    with_posts(
        "SELECT post_id, count(*) AS n_words, count(*) FILTER (word = '') AS n_empty FROM tokens GROUP BY post_id",
        _TOKENS_SQL,
    ),
)
def c6(spark, sf_dir):
    tokens = classifier.tokenizer().transform(texts(spark, sf_dir))
    return tokens.select(
        "post_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.size(F.array_compact(F.transform("words", lambda w: F.when(w == "", w)))).cast("bigint").alias("n_empty"),
    )


@query(
    "c7_remove_stop_words",
    with_posts(
        f"SELECT word, count(*) AS n FROM tokens WHERE word NOT IN {_STOP_SQL} GROUP BY word", _TOKENS_SQL
    ),
)
def c7(spark, sf_dir):
    kept = classifier.stop_word_remover().transform(classifier.tokenizer().transform(texts(spark, sf_dir)))
    return words.explode_tokens(kept, "filtered").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def term_frequencies(df):
    return Pipeline(stages=classifier.feature_stages()[:3]).fit(df).transform(df)


@query(
    "c8_hashing_tf",
    with_posts(
        f"""SELECT label, count(DISTINCT post_id) AS posts, count(*) FILTER (word NOT IN {_STOP_SQL}) AS terms
            FROM tokens GROUP BY label""",
        _TOKENS_SQL,
    ),
)
def c8(spark, sf_dir):
    """Terms in all buckets together, per class: hashing moves terms but loses none."""
    hashed = term_frequencies(texts(spark, sf_dir))
    counted = hashed.select("post_id", F.aggregate(vector_to_array("raw_features"), F.lit(0.0), lambda a, x: a + x).alias("n"))
    by_label = with_labels(counted, spark, sf_dir).groupBy("label")
    return by_label.agg(F.count(F.lit(1)).alias("posts"), F.sum("n").cast("bigint").alias("terms"))


_HASHED_SQL = f"""kept AS (SELECT DISTINCT post_id, word FROM tokens WHERE word NOT IN {_STOP_SQL}),
terms AS (SELECT word AS term, count(*) AS doc_freq FROM kept GROUP BY word),
placed AS (SELECT term, doc_freq, CAST({bucket_sql('term')} AS INTEGER) AS bucket FROM terms)"""


@query(
    "c9_idf",
    with_posts(
        """SELECT bucket, count(DISTINCT post_id) AS doc_freq,
                  round(ln(((SELECT count(*) FROM posts) + 1.0) / (count(DISTINCT post_id) + 1.0)), 9) AS weight
           FROM placed JOIN kept ON kept.word = placed.term GROUP BY bucket HAVING count(DISTINCT post_id) >= 2""",
        _TOKENS_SQL,
        _HASHED_SQL,
    ),
)
def c9(spark, sf_dir):
    """Document frequency and weight of each bucket that two documents or more use; all others weigh 0."""
    df = texts(spark, sf_dir)
    model = classifier.idf().fit(term_frequencies(df))
    # One entry per bucket, whatever the data.
    rows = [(i, int(n), round(float(w), 9)) for i, (n, w) in enumerate(zip(model.docFreq, model.idf.toArray())) if n]
    return spark.createDataFrame(rows, "bucket int, doc_freq bigint, weight double")


_MODELS: dict = {}


def trained(spark, sf_dir):
    """Model fitted on the train part of the labelled texts, once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        _MODELS[key] = classifier.fit_classifier(train_and_test(spark, sf_dir)[0])
    return _MODELS[key]


def train_and_test(spark, sf_dir):
    labelled = with_labels(texts(spark, sf_dir), spark, sf_dir)
    return classifier.split(cleaning.filter_labelled(labelled), "post_id")


def held_out(spark, sf_dir):
    return train_and_test(spark, sf_dir)[1]


@query("c10_logreg")
def c10(spark, sf_dir):
    """What the model predicts on the held-out part, per class."""
    scored = classifier.score(held_out(spark, sf_dir), trained(spark, sf_dir))
    return evaluation.confusion_matrix(scored, "label", "prediction")


@query("c11_fit_classifier")
def c11(spark, sf_dir):
    """Held-out metrics of the fitted stages."""
    return classifier.model_metrics(classifier.score(held_out(spark, sf_dir), trained(spark, sf_dir)))


@query(
    "c12_random_split",
    with_posts(
        "SELECT post_id, CAST('0x' || substr(md5('42:' || post_id), 1, 8) AS BIGINT) % 10000 < 8000 AS is_train FROM posts"
    ),
)
def c12(spark, sf_dir):
    train, test = classifier.split(texts(spark, sf_dir).select("post_id"), "post_id", 0.8, 42)
    return train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))


@query(
    "c13_stratified_split",
    with_posts(
        """SELECT post_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || post_id))
                  <= ceil(count(*) OVER (PARTITION BY label) * 0.8::DOUBLE) AS is_train FROM posts"""
    ),
)
def c13(spark, sf_dir):
    return classifier.stratified_split(labelled_texts(spark, sf_dir).select("post_id", "label"))


@query("c14_score_batch")
def c14(spark, sf_dir):
    scored = classifier.score(texts(spark, sf_dir), trained(spark, sf_dir))
    return reports.value_counts(scored, "predicted_category")


def filled_labels(spark, sf_dir):
    """(post_id, known, label): scored before the join, so that no text is shuffled."""
    scored = classifier.score(texts(spark, sf_dir), trained(spark, sf_dir)).select("post_id", "prediction")
    known = with_labels(scored, spark, sf_dir).withColumnRenamed("label", "known")
    return classifier.fill_label(known, "known").select("post_id", "known", "label")


@query("c15_score_unlabelled")
def c15(spark, sf_dir):
    return reports.overall_breakdown(filled_labels(spark, sf_dir))


@query(
    "c15_known_labels_kept",
    with_posts("SELECT label AS known, label, count(*) AS rows FROM posts WHERE label IS NOT NULL GROUP BY label"),
)
def c15_kept(spark, sf_dir):
    """Filling in labels leaves the known ones alone."""
    kept = filled_labels(spark, sf_dir).filter(F.col("known").isNotNull())
    return kept.groupBy("known", "label").agg(F.count(F.lit(1)).alias("rows"))


@query("c16_score_stream", "SELECT true AS same, count(*) AS rows FROM documents")
def c16(spark, sf_dir):
    """The model gives every post of a stream of messages the class it gives in a batch."""
    messages = codec.decode_posts(source(spark, message_files(spark, sf_dir)))
    scored = classifier.score(messages, trained(spark, sf_dir)).select("post_id", "prediction")
    out = new_path(spark, "scored")
    scored.writeStream.format("parquet").option("checkpointLocation", new_path(spark, "checkpoint")).trigger(
        availableNow=True
    ).start(out).awaitTermination()
    streamed = spark.read.schema("post_id bigint, prediction double").parquet(out)
    batch = classifier.score(texts(spark, sf_dir), trained(spark, sf_dir))
    both = streamed.join(batch.select("post_id", F.col("prediction").alias("batch")), "post_id", "full_outer")
    return both.groupBy(F.col("prediction").eqNullSafe(F.col("batch")).alias("same")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def model_job(spark, sf_dir):
    """The job with the trained model as its scorer; returns the folder of its state."""
    model = trained(spark, sf_dir)
    path = message_files(spark, sf_dir)
    return run_job(spark, path, scorer=lambda df: classifier.score(df, model), pred="prediction")


@query(
    "i1_model_stream_job",
    with_posts("""SELECT CAST("timestamp" AS DATE) AS stat_date, source, count(*) AS post_count FROM posts GROUP BY 1, 2"""),
)
def i1_model(spark, sf_dir):
    """Posts a day and source over all predicted classes."""
    daily = state_store.read_state(spark, model_job(spark, sf_dir), "daily_stats")
    return daily.groupBy("stat_date", "source").agg(F.sum("post_count").alias("post_count"))


@query(
    "i1_model_stream_words",
    with_posts(
        r"""SELECT word AS keyword, count(*) AS frequency
            FROM (SELECT unnest(regexp_split_to_array(lower(trim(text)), '\s+')) AS word FROM posts)
            WHERE regexp_matches(word, '^[a-z]{4,}$') GROUP BY word"""
    ),
)
def i1_words(spark, sf_dir):
    """Words over all predicted classes."""
    words_state = state_store.read_state(spark, model_job(spark, sf_dir), "top_keywords")
    return words_state.groupBy("keyword").agg(F.sum("frequency").alias("frequency"))


@query(
    "c15_export_reports",
    with_posts(
        """SELECT name, count(*) AS total FROM posts, (VALUES ('overall_breakdown'), ('daily_trend'), ('by_source')) t(name)
           GROUP BY name"""
    ),
)
def c15_export(spark, sf_dir):
    """Labels filled in by the model, then every report exported and read back; posts in each."""
    filled = classifier.ensure_label(posts(spark, sf_dir), trained(spark, sf_dir))
    paths = export_reports(filled, new_path(spark, "exports"))
    totals = [
        readers.read_posts_csv(spark, paths[name], "count bigint").agg(F.lit(name).alias("name"), F.sum("count").alias("total"))
        for name in ("overall_breakdown", "daily_trend", "by_source")
    ]
    return cleaning.union_sources(totals)


@query(
    "c10_held_out_sizes",
    with_posts(
        """SELECT label, count(*) AS rows FROM posts
           WHERE label IS NOT NULL AND CAST('0x' || substr(md5('42:' || post_id), 1, 8) AS BIGINT) % 10000 >= 8000 GROUP BY label"""
    ),
)
def c10_sizes(spark, sf_dir):
    """How many rows of each class the model is judged on: the actual side of its confusion matrix."""
    scored = classifier.score(held_out(spark, sf_dir), trained(spark, sf_dir))
    return scored.filter(F.col("prediction").isNotNull()).groupBy("label").agg(F.count(F.lit(1)).alias("rows"))


@query("c14_scored_rows", "SELECT count(*) AS rows, true AS known FROM documents")
def c14_rows(spark, sf_dir):
    """The model gives every post one of the known classes."""
    counts = reports.value_counts(classifier.score(texts(spark, sf_dir), trained(spark, sf_dir)), "predicted_category")
    known = F.col("predicted_category").isin(*LABEL_NAMES.values())
    return counts.agg(F.sum("count").alias("rows"), F.every(known).alias("known"))


@query("c20_confidence_bounds", "SELECT count(*) AS rows, true AS bounded FROM documents")
def c20_bounds(spark, sf_dir):
    """The confidence of the likeliest of three classes lies between a third and one."""
    scored = classifier.with_confidence(classifier.score(texts(spark, sf_dir), trained(spark, sf_dir)))
    bounded = (F.col("confidence") >= 1 / 3) & (F.col("confidence") <= 1)
    return scored.agg(F.count("post_id").alias("rows"), F.every(bounded).alias("bounded"))


_GRAMS_SQL = f"""filtered AS (
  SELECT post_id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}\\p{{N}}_]{{2,}}'),
                              lambda w: w NOT IN {_STOP_SQL}) AS t FROM posts
), grams AS (
  SELECT unnest(t) AS gram FROM filtered
  UNION ALL
  SELECT unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM filtered
)"""


@query("c19_tfidf_ngram_features", with_posts("SELECT gram, count(*) AS n FROM grams GROUP BY gram", _GRAMS_SQL))
def c19(spark, sf_dir):
    """How often each 1- and 2-gram occurs: what the vocabulary of the features is chosen from."""
    df = texts(spark, sf_dir)
    return classifier.ngram_counts(df)


_VECTORS_SQL = f"""filtered AS (
  SELECT post_id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}\\p{{N}}_]{{2,}}'),
                              lambda w: w NOT IN {_STOP_SQL}) AS t FROM posts
), grams AS (
  SELECT post_id, unnest(t) AS gram FROM filtered
  UNION ALL
  SELECT post_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM filtered
), vocabulary AS (
  SELECT gram, count(DISTINCT post_id) AS df FROM grams GROUP BY gram ORDER BY count(*) DESC, gram LIMIT 5000
), weighted AS (
  SELECT post_id, gram, count(*) * ln(((SELECT count(*) FROM posts) + 1.0) / (df + 1.0)) AS w
  FROM grams JOIN vocabulary USING (gram) GROUP BY post_id, gram, df
), lengths AS (SELECT post_id, sqrt(sum(w * w)) AS length FROM weighted GROUP BY post_id
), units AS (
  SELECT post_id, gram, CASE WHEN length > 0 THEN w / length ELSE 0 END AS x FROM weighted JOIN lengths USING (post_id)
)"""


@query(
    "c19_ngram_vectors",
    with_posts(
        """SELECT 'gram' AS kind, gram AS name, df AS n, round(coalesce(sum(x), 0.0), 4) AS value
           FROM vocabulary LEFT JOIN units USING (gram) GROUP BY gram, df
           UNION ALL
           SELECT 'post', CAST(post_id AS VARCHAR), count(*) FILTER (x > 0), round(sqrt(coalesce(sum(x * x), 0.0)), 6)
           FROM posts LEFT JOIN units USING (post_id) GROUP BY post_id""",
        _VECTORS_SQL,
    ),
)
def c19_vectors(spark, sf_dir):
    """The finished features: posts and weight of each gram of the vocabulary, grams and length of each post's vector."""
    df = texts(spark, sf_dir)
    model = classifier.fit_ngram_features(df)
    vectors = model.transform(df).select("post_id", F.unwrap_udt("features").alias("v"))
    entries = vectors.select("post_id", F.explode_outer(F.arrays_zip("v.indices", "v.values")).alias("e"))
    # Written once for both sums.
    entries = written(entries.select("post_id", F.col("e.indices").alias("i"), F.col("e.values").alias("x")), "entries")
    counted, idf = model.stages[-3], model.stages[-2]
    known = spark.createDataFrame(
        [(i, g, int(n)) for i, (g, n) in enumerate(zip(counted.vocabulary, idf.docFreq))], "i int, gram string, df bigint"
    )
    weights = entries.filter("i IS NOT NULL").groupBy("i").agg(F.sum("x").alias("x"))
    by_gram = known.join(weights, "i", "left").select(
        F.lit("gram").alias("kind"), F.col("gram").alias("name"), F.col("df").alias("n"), F.round(F.coalesce("x", F.lit(0.0)), 4).alias("value")
    )
    by_post = entries.groupBy("post_id").agg(
        F.count_if(F.col("x") > 0).alias("n"), F.round(F.sqrt(F.coalesce(F.sum(F.col("x") * F.col("x")), F.lit(0.0))), 6).alias("value")
    )
    return by_gram.unionByName(by_post.select(F.lit("post").alias("kind"), F.col("post_id").cast("string").alias("name"), "n", "value"))


@query("c19_ngram_classifier")
def c19_model(spark, sf_dir):
    """Held-out metrics of the n-gram features with their logistic regression."""
    train, test = train_and_test(spark, sf_dir)
    stages = [*classifier.ngram_stages(), classifier.logistic(max_iter=1000, reg=0.01)]
    return classifier.model_metrics(classifier.score(test, classifier.fit_classifier(train, stages)))


@query("c20_prediction_confidence")
def c20(spark, sf_dir):
    scored = classifier.with_confidence(classifier.score(texts(spark, sf_dir), trained(spark, sf_dir)))
    return scored.select("post_id", "predicted_category", F.round("confidence", 6).alias("confidence"))


@query("b19_uncertain_filter")
def b19(spark, sf_dir):
    scored = classifier.score(texts(spark, sf_dir), trained(spark, sf_dir))
    return classifier.uncertain(scored).select("post_id", "predicted_category")


@query("a11_model_save_load", "SELECT true AS same, count(*) AS rows FROM documents")
def a11(spark, sf_dir):
    """The saved and reloaded model predicts what the fitted one does, on every post."""
    path = new_path(spark, "model")
    model = trained(spark, sf_dir)
    classifier.save_model(model, path)
    rows = texts(spark, sf_dir)
    before = classifier.score(rows, model).select("post_id", F.col("prediction").alias("before"))
    both = classifier.score(before.join(rows, "post_id"), classifier.load_model(path))
    return both.groupBy((F.col("prediction") == F.col("before")).alias("same")).agg(F.count(F.lit(1)).alias("rows"))


@query("c21_alt_models")
def c21(spark, sf_dir):
    """Held-out accuracy of naive Bayes, of 3-gram features and of a random forest on word vectors from counts."""
    train, test = train_and_test(spark, sf_dir)
    variants = {
        "bayes": [*classifier.feature_stages(), classifier.model_stage("bayes")],
        "three_grams": [*classifier.ngram_stages(n=3), classifier.logistic(max_iter=100, reg=0.01)],
    }
    scored = {kind: classifier.score(test, classifier.fit_classifier(train, stages)) for kind, stages in variants.items()}
    split = Pipeline(stages=[classifier.tokenizer(), classifier.stop_word_remover()]).fit(train)
    train, test = (split.transform(cleaning.fill_nulls(df, {"text": ""})).select("post_id", "label", "filtered") for df in (train, test))
    vectors = word_vectors.fit_word_vectors(train)
    known = written(word_vectors.mean_vectors(train, vectors, "post_id").select("label", "features"), "text-vectors")
    forest = classifier.model_stage("forest").fit(known)
    scored["forest"] = forest.transform(word_vectors.mean_vectors(test, vectors, "post_id"))
    return cleaning.union_sources(
        [classifier.model_metrics(rows).select(F.lit(kind).alias("model"), "accuracy") for kind, rows in scored.items()]
    )


@query("c22_grid_search")
def c22(spark, sf_dir):
    train, _ = train_and_test(spark, sf_dir)
    _, grid = classifier.tune(train, classifier.feature_stages())
    return spark.createDataFrame(grid, "reg double, accuracy double")


@query("c23_train_on_rule_labels")
def c23(spark, sf_dir):
    """Train on the rule's labels; how often the model then differs from them, per class."""
    ruled = rules.classify_first(texts(spark, sf_dir), "text", KW0, KW1, out="rule")
    _, differ = classifier.retrain(ruled, "rule")
    return reports.distribution_filled(differ, "rule")


