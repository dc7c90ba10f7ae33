"""What checks the models: tables behind features, word vectors, Bayes, optimality, folds and calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens.catalog.ml_queries import _HASHED_SQL, _STOP_SQL, _TOKENS_SQL, filled_labels, held_out, train_and_test, trained
from postlens.catalog.registry import query
from postlens.catalog.tables import KW0, KW1, RULE_SQL, texts, with_labels, with_posts
from postlens.operators import calibration, certificate, classifier, cleaning, linear_tables, rules, term_bayes, word_vectors

BINS, WIDTH = 20, 4.0


def tokens(df):
    """The words of each text as the classifier takes them; null counts as empty."""
    split = classifier.tokenizer().transform(cleaning.fill_nulls(df, {"text": ""}))
    return classifier.stop_word_remover().transform(split).drop("words", "text")


# --- hashed features ------------------------------------------------------


@query(
    "c9_terms",
    with_posts("SELECT term, doc_freq, bucket, count(*) OVER (PARTITION BY bucket) > 1 AS collides FROM placed", _TOKENS_SQL, _HASHED_SQL),
)
def c9_terms(spark, sf_dir):
    """The terms behind the hashed features, with those that share a bucket."""
    return classifier.term_dictionary(tokens(texts(spark, sf_dir)))


# --- word vectors ---------------------------------------------------------

_PAIRS_SQL = f"""filtered AS (
  SELECT post_id, list_filter(string_split_regex(regexp_replace(lower(text), '[\\s\\x0b]+$', ''), '[\\s\\x0b]'), lambda w: w NOT IN {_STOP_SQL}) AS t FROM posts
), placed AS (SELECT post_id, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM filtered),
often AS (SELECT w FROM placed GROUP BY w HAVING count(*) >= {word_vectors.MIN_COUNT}),
forward AS (
  SELECT a.w AS word, b.w AS context, count(*) AS n
  FROM (SELECT post_id, w, i, unnest(range(1, {word_vectors.WINDOW} + 1)) AS k FROM placed) a JOIN placed b ON b.post_id = a.post_id AND b.i = a.i + a.k
  GROUP BY a.w, b.w
), counts AS (
  SELECT word, context, CAST(sum(n) AS BIGINT) AS n FROM (SELECT word, context, n FROM forward UNION ALL SELECT context, word, n FROM forward)
  WHERE word IN (FROM often) AND context IN (FROM often) GROUP BY word, context
), margin AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM counts GROUP BY word),
pmi AS (
  SELECT c.word, c.context, c.n, a.n AS word_n,
         greatest(ln(c.n / (CAST(a.n AS DOUBLE) * b.n / (SELECT CAST(sum(n) AS DOUBLE) FROM margin))), 0.0) AS ppmi
  FROM counts c JOIN margin a ON a.word = c.word JOIN margin b ON b.word = c.context
), drawn AS (
  SELECT context, CAST('0x' || substr(d, 1, 8) AS BIGINT) % {word_vectors.SIZE} AS place, CASE WHEN substr(d, 9, 1) < '8' THEN 1.0 ELSE -1.0 END::DOUBLE AS sign
  FROM (SELECT word AS context, md5('42:' || j || ':' || word) AS d FROM margin, range(1, {word_vectors.NONZEROS} + 1) r(j))
), entries AS (SELECT word, place, sum(ppmi * sign) AS x FROM pmi JOIN drawn USING (context) WHERE ppmi > 0 GROUP BY word, place),
lengths AS (SELECT word, sum(x * x) / {word_vectors.NONZEROS} AS l FROM entries GROUP BY word)"""


@query(
    "c21_word_vectors",
    with_posts(
        """SELECT word, max(word_n) AS n, count(*) AS contexts, count(*) FILTER (ppmi > 0) AS positive,
                  round(sum(ppmi), 4) AS weight, round(max(ppmi), 6) AS largest, round(coalesce(max(l), 0.0), 3) AS length
           FROM pmi LEFT JOIN lengths USING (word) GROUP BY word""",
        _PAIRS_SQL,
    ),
)
def c21_vectors(spark, sf_dir):
    """Counts, weights and squared vector length of every word with a vector, over all posts."""
    weighted = word_vectors.positive_pmi(word_vectors.pair_counts(tokens(texts(spark, sf_dir)), packed=True))
    vectors = word_vectors.projected(weighted)
    length = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    sums = word_vectors.weight_sums(weighted).withColumns({"weight": F.round("weight", 4), "largest": F.round("largest", 6)})
    return sums.join(vectors.select("word", length.alias("l")), "word", "left").select(
        "word", "n", "contexts", "positive", "weight", "largest", F.round(F.coalesce("l", F.lit(0.0)), 3).alias("length")
    )


# --- naive Bayes ----------------------------------------------------------

_BAYES_SQL = f"""kept AS (SELECT post_id, label, word FROM tokens WHERE word NOT IN {_STOP_SQL}),
parts AS (SELECT post_id, label, CAST('0x' || substr(md5('42:' || post_id), 1, 8) AS BIGINT) % 10000 < 8000 AS is_train FROM posts),
docs AS (SELECT label, count(*) AS docs FROM parts WHERE is_train AND label IS NOT NULL GROUP BY label),
class_terms AS (
  SELECT kept.label, word AS term, count(*) AS n FROM kept JOIN parts USING (post_id) WHERE is_train AND kept.label IS NOT NULL GROUP BY kept.label, word
), classes AS (
  SELECT label, ln((docs + 1.0) / ((SELECT sum(docs) FROM docs) + (SELECT count(*) FROM docs))) AS log_prior,
         coalesce((SELECT sum(n) FROM class_terms t WHERE t.label = docs.label), 0) + (SELECT count(DISTINCT term) FROM class_terms) AS mass FROM docs
), bags AS (
  SELECT post_id, word AS term, count(*) AS n FROM kept WHERE word IN (SELECT term FROM class_terms) GROUP BY post_id, word
), likelihoods AS (
  SELECT post_id, c.label, sum(b.n * ln((coalesce(t.n, 0) + 1.0) / mass)) AS s
  FROM bags b CROSS JOIN classes c LEFT JOIN class_terms t ON t.term = b.term AND t.label = c.label GROUP BY post_id, c.label
), scores AS (
  SELECT posts.post_id, posts.label AS known, c.label, log_prior + coalesce(s, 0.0) AS score
  FROM posts CROSS JOIN classes c LEFT JOIN likelihoods l ON l.post_id = posts.post_id AND l.label = c.label
), ranked AS (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY score DESC, label) AS r FROM scores),
predicted AS (
  SELECT a.post_id, a.known, a.label AS prediction, a.score - b.score AS margin
  FROM ranked a LEFT JOIN ranked b ON b.post_id = a.post_id AND b.r = 2 WHERE a.r = 1
), binned AS (
  SELECT least(CAST(floor(margin / {WIDTH}) AS BIGINT), {BINS - 1}) AS bin, count(*) AS rows, count(*) FILTER (known = prediction) AS correct, avg(margin) AS mean_score
  FROM predicted JOIN parts USING (post_id) WHERE known IS NOT NULL AND NOT is_train GROUP BY 1
), pooled AS (
  SELECT i.bin, max(low) AS share FROM binned i JOIN (
    SELECT j.bin AS j, i.bin AS i, min((SELECT sum(b.correct) / sum(b.rows) FROM binned b WHERE b.bin BETWEEN j.bin AND k.bin)) AS low
    FROM binned j JOIN binned i ON j.bin <= i.bin JOIN binned k ON k.bin >= i.bin GROUP BY j.bin, i.bin
  ) ON i = i.bin GROUP BY i.bin
)"""
_BAYES = (_TOKENS_SQL, _BAYES_SQL)


def bayes(spark, sf_dir):
    return term_bayes.fit_terms(tokens(train_and_test(spark, sf_dir)[0]))


@query(
    "c21_bayes_terms",
    with_posts("SELECT label, term, n, round(ln((n + 1.0) / mass), 9) AS log_prob FROM class_terms JOIN classes USING (label)", *_BAYES),
)
def c21_terms(spark, sf_dir):
    """Log-probability of every term of every class, from the train part."""
    return bayes(spark, sf_dir).terms.select("label", "term", "n", F.round("log_prob", 9).alias("log_prob"))


@query(
    "c21_bayes_scores",
    with_posts(
        """SELECT post_id, max(label) FILTER (r = 1) AS prediction, round(max(score) FILTER (label = 0), 3) AS score0,
                  round(max(score) FILTER (label = 1), 3) AS score1, round(max(score) FILTER (label = 2), 3) AS score2 FROM ranked GROUP BY post_id""",
        *_BAYES,
    ),
)
def c21_scores(spark, sf_dir):
    """Every post's score for every class."""
    scored = term_bayes.score_terms(tokens(texts(spark, sf_dir)), bayes(spark, sf_dir), "post_id")
    return scored.select("post_id", "prediction", *[F.round(F.col("scores")[i], 3).alias(f"score{i}") for i in range(3)])


# --- calibration ----------------------------------------------------------


def judged(spark, sf_dir):
    """Bayes margins of the held-out rows, with the known class."""
    model = bayes(spark, sf_dir)
    rows = held_out(spark, sf_dir)
    scored = term_bayes.score_terms(tokens(rows), model, "post_id")
    return model, scored.join(rows.select("post_id", "label"), "post_id")


@query(
    "c20_reliability",
    with_posts("SELECT bin, rows, correct, round(mean_score, 5) AS mean_score, round(correct / rows, 9) AS accuracy FROM binned", *_BAYES),
)
def c20_reliability(spark, sf_dir):
    """How often the prediction is right, by how far it is above the next class."""
    scored = judged(spark, sf_dir)[1]
    table = calibration.reliability(scored, "margin", F.col("label") == F.col("prediction"), WIDTH, BINS)
    return table.select("bin", "rows", "correct", F.round("mean_score", 5).alias("mean_score"), F.round("accuracy", 9).alias("accuracy"))


def calibrated(spark, sf_dir):
    model, scored = judged(spark, sf_dir)
    return model, scored, calibration.fit_isotonic(scored, "margin", F.col("label") == F.col("prediction"), WIDTH, BINS)


@query("c20_isotonic", with_posts("SELECT bin, rows, round(share, 9) AS share FROM pooled JOIN binned USING (bin)", *_BAYES))
def c20_isotonic(spark, sf_dir):
    """The calibrated confidence of each bin in use."""
    _, scored, fitted = calibrated(spark, sf_dir)
    rows = scored.select(calibration.bin_of(F.col("margin"), WIDTH, BINS).alias("bin"), F.round(fitted.apply(F.col("margin")), 9).alias("share"))
    return rows.groupBy("bin", "share").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "b19_calibrated",
    with_posts(
        f"""SELECT post_id, prediction, round(share, 9) AS confidence
            FROM predicted JOIN (SELECT n.n AS bin, coalesce((SELECT share FROM pooled WHERE pooled.bin <= n.n ORDER BY pooled.bin DESC LIMIT 1),
                                                             (SELECT share FROM pooled ORDER BY pooled.bin LIMIT 1)) AS share FROM range(0, {BINS}) n(n)) b
              ON b.bin = least(CAST(floor(margin / {WIDTH}) AS BIGINT), {BINS - 1})
            WHERE known IS NULL AND share BETWEEN 0.0 AND 0.85""",
        *_BAYES,
    ),
)
def b19_calibrated(spark, sf_dir):
    """Posts without a label whose prediction is right in 85 % of such cases at most: the ones worth a person's label."""
    model, _, fitted = calibrated(spark, sf_dir)
    unknown = with_labels(texts(spark, sf_dir), spark, sf_dir).filter("label IS NULL")
    scored = term_bayes.score_terms(tokens(unknown), model, "post_id")
    return calibration.to_relabel(scored, fitted, "margin", lo=0.0, hi=0.85).select("post_id", "prediction", F.round("confidence", 9).alias("confidence"))


# --- training -------------------------------------------------------------


@query(
    "c10_certificate",
    with_posts(
        """SELECT CAST(label AS INTEGER) AS class, (SELECT count(*) FROM posts WHERE label IS NOT NULL AND CAST('0x' || substr(md5('42:' || post_id), 1, 8) AS BIGINT) % 10000 < 8000) AS rows,
                  true AS optimal
           FROM posts WHERE label IS NOT NULL GROUP BY label"""
    ),
)
def c10_certificate(spark, sf_dir):
    """The trained model is at its optimum: no entry of the regularised gradient, recomputed from its training rows, is over 0.001."""
    model = trained(spark, sf_dir)
    train = train_and_test(spark, sf_dir)[0]
    rows = train
    for stage in model.stages[:-1]:
        rows = stage.transform(rows)
    return certificate.certificate(rows.select("label", "features"), model.stages[-1], reg=0.01).select("class", "rows", "optimal")


@query(
    "c22_out_of_fold",
    with_posts(
        """SELECT post_id, label, CAST(CAST('0x' || substr(md5('42:' || post_id), 9, 8) AS BIGINT) % 3 AS INTEGER) AS fold, CAST(reg AS DOUBLE) AS reg, true AS predicted
           FROM posts, (VALUES (0.001), (0.01), (0.1)) t(reg)
           WHERE label IS NOT NULL AND CAST('0x' || substr(md5('42:' || post_id), 1, 8) AS BIGINT) % 10000 < 8000"""
    ),
)
def c22_out_of_fold(spark, sf_dir):
    """Every training row once for each strength, predicted by a model that never saw its fold."""
    train, _ = train_and_test(spark, sf_dir)
    scored = classifier.out_of_fold(train, classifier.feature_stages(), "post_id", max_iter=20)
    return scored.select("post_id", "label", "fold", "reg", F.col("prediction").isin(0, 1, 2).alias("predicted"))


# --- predictions by joins and sums ----------------------------------------


def scored_by_tables(spark, rows, model):
    return linear_tables.score_linear(tokens(rows), linear_tables.linear_tables(spark, model), "post_id")


@query("c14_scored_by_tables", with_posts("SELECT post_id, true AS same, true AS close FROM posts"))
def c14_by_tables(spark, sf_dir):
    """The model's class and confidence of every post are those that its weights give by joins and sums."""
    model = trained(spark, sf_dir)
    rows = texts(spark, sf_dir)
    scored = classifier.with_confidence(classifier.score(rows, model)).select(
        "post_id", F.col("prediction").cast("int").alias("given"), F.col("confidence").alias("sure")
    )
    both = scored.join(scored_by_tables(spark, rows, model), "post_id", "full_outer")
    near = F.coalesce(F.abs(F.col("sure") - F.col("confidence")) < 1e-9, F.lit(False))
    return both.select("post_id", F.col("given").eqNullSafe(F.col("prediction")).alias("same"), near.alias("close"))


@query(
    "c15_filled_by_tables",
    with_posts("SELECT label AS known, true AS same, count(*) AS rows FROM posts GROUP BY label"),
)
def c15_by_tables(spark, sf_dir):
    """Labels that are filled in are those that the weights give by joins and sums; known ones stay."""
    mine = scored_by_tables(spark, texts(spark, sf_dir), trained(spark, sf_dir)).select("post_id", "prediction")
    both = filled_labels(spark, sf_dir).join(mine, "post_id", "left")
    same = F.col("label").eqNullSafe(F.coalesce("known", "prediction"))
    return both.groupBy("known", same.alias("same")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "c23_differ_by_tables",
    with_posts(f"SELECT {RULE_SQL} AS rule, true AS same, count(*) AS rows FROM posts GROUP BY 1"),
)
def c23_by_tables(spark, sf_dir):
    """The rows in which the model retrained on the rule's labels differs from them are those that its weights give."""
    ruled = rules.classify_first(texts(spark, sf_dir), "text", KW0, KW1, out="rule")
    model, differ = classifier.retrain(ruled, "rule")
    mine = scored_by_tables(spark, ruled, model).select("post_id", "prediction")
    listed = differ.select("post_id", F.col("prediction").alias("given"))
    both = ruled.select("post_id", "rule").join(mine, "post_id", "left").join(listed, "post_id", "left")
    same = F.coalesce("given", "rule").eqNullSafe(F.col("prediction"))
    return both.groupBy("rule", same.alias("same")).agg(F.count(F.lit(1)).alias("rows"))
