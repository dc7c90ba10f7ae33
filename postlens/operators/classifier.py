"""Text features, training, scoring and tuning on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    CountVectorizerModel,
    HashingTF,
    NGram,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
    StopWordsRemover,
    Tokenizer,
    Word2Vec,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions.labels import label_name
from postlens.functions.numbers import ratio
from postlens.operators.cleaning import fill_nulls
from postlens.operators.evaluation import class_metrics, valid_pairs
from postlens.operators.words import gram_counts
from postlens.schema import LABEL_NAMES, LABELS, NEUTRAL
from postlens.session import written

# Stages come from pyspark.ml, which has no public common type for them.
Stages = list


# --- features -------------------------------------------------------------


def tokenizer(text: str = "text", out: str = "words") -> Tokenizer:
    return Tokenizer(inputCol=text, outputCol=out)


def stop_word_remover(words: str = "words", out: str = "filtered") -> StopWordsRemover:
    """English default list; the locale is fixed so that the machine's does not matter."""
    return StopWordsRemover(inputCol=words, outputCol=out, locale="en_US")


def hashing_tf(words: str = "filtered", out: str = "raw_features", buckets: int = 20_000) -> HashingTF:
    return HashingTF(inputCol=words, outputCol=out, numFeatures=buckets)


def idf(features: str = "raw_features", out: str = "features", min_doc_freq: int = 2) -> IDF:
    return IDF(inputCol=features, outputCol=out, minDocFreq=min_doc_freq)


def feature_stages(text: str = "text", buckets: int = 20_000, min_doc_freq: int = 2) -> Stages:
    return [tokenizer(text), stop_word_remover(), hashing_tf(buckets=buckets), idf(min_doc_freq=min_doc_freq)]


def ngram_stages(text: str = "text", n: int = 2, vocab: int = 5_000) -> Stages:
    """TF-IDF over all 1- to n-grams of words of two characters or more, unit length."""
    stages: Stages = [
        RegexTokenizer(inputCol=text, outputCol="words", pattern=r"(?U)\b\w\w+\b", gaps=False),
        stop_word_remover(),
    ]
    grams = ["filtered"]
    for size in range(2, n + 1):
        grams.append(f"grams{size}")
        stages.append(NGram(n=size, inputCol="filtered", outputCol=grams[-1]))
    joined = f"concat({', '.join(grams)})"
    stages += [
        SQLTransformer(statement=f"SELECT *, {joined} AS grams FROM __THIS__"),
        CountVectorizer(inputCol="grams", outputCol="raw_features", vocabSize=vocab),
        IDF(inputCol="raw_features", outputCol="weighted"),
        Normalizer(inputCol="weighted", outputCol="features", p=2.0),
    ]
    return stages


def ngram_counts(df: DataFrame, text: str = "text", n: int = 2) -> DataFrame:
    """(gram, n): occurrences of each of the `grams` that `ngram_stages` make, counted without a string for every one of them."""
    split, stop, *_ = ngram_stages(text, n)
    return gram_counts(stop.transform(split.transform(df)), stop.getOutputCol(), n)


def fit_ngram_features(df: DataFrame, text: str = "text", n: int = 2, vocab: int = 5_000) -> PipelineModel:
    """The stages of `ngram_stages`, fitted with a fixed vocabulary: the grams that occur most often, ties in byte order.

    `CountVectorizer` leaves open which of the grams that tie for the last places it takes.
    """
    *first, count, idf_stage, unit = ngram_stages(text, n, vocab)
    split = Pipeline(stages=first).fit(df)
    top = ngram_counts(df, text, n).orderBy(F.desc("n"), "gram").limit(vocab)
    words = [r["gram"] for r in top.collect()]  # a row per entry of the vocabulary
    known = CountVectorizerModel.from_vocabulary(words, inputCol=count.getInputCol(), outputCol=count.getOutputCol())
    return Pipeline(stages=[*split.stages, known, idf_stage, unit]).fit(df)


def word_vector_stages(text: str = "text", size: int = 100, min_count: int = 5, seed: int = 42, partitions: int = 8) -> Stages:
    """Mean learned word vector of each text; `word_vectors` has vectors from counts, without a model on the driver."""
    return [
        tokenizer(text),
        stop_word_remover(),
        Word2Vec(inputCol="filtered", outputCol="features", vectorSize=size, minCount=min_count, seed=seed, numPartitions=partitions),
    ]


# --- models ---------------------------------------------------------------


def logistic(label: str = "label", features: str = "features", max_iter: int = 100, reg: float = 0.01):
    return LogisticRegression(labelCol=label, featuresCol=features, maxIter=max_iter, regParam=reg)


def model_stage(kind: str, label: str = "label", features: str = "features", **params):
    """`logistic`, `forest` (50 trees of depth 10) or `bayes`; `params` override."""
    common = {"labelCol": label, "featuresCol": features}
    if kind == "logistic":
        return LogisticRegression(**{**common, "maxIter": 100, "regParam": 0.01, **params})
    if kind == "forest":
        return RandomForestClassifier(**{**common, "numTrees": 50, "maxDepth": 10, "seed": 42, **params})
    if kind == "bayes":
        return NaiveBayes(**{**common, **params})
    raise ValueError(f"unknown model {kind!r}")


def fit_classifier(df: DataFrame, stages: Stages | None = None, label: str = "label", text: str = "text") -> PipelineModel:
    """Fit features and model on the labelled rows (null text counts as empty)."""
    stages = stages or [*feature_stages(text), logistic(label)]
    labelled = fill_nulls(df.filter(F.col(label).isNotNull()), {text: ""})
    return fit_stages(labelled, stages)


def fit_stages(df: DataFrame, stages: Stages) -> PipelineModel:
    """`Pipeline.fit`, with the rows written once where the first stage is about to learn from vectors.

    Learners pass over their rows several times; without this, each pass splits and counts all texts again.
    """
    fitted, rows, kept = [], df, False
    for i, stage in enumerate(stages):
        if isinstance(stage, Estimator):
            if not kept and any(isinstance(rows.schema[c].dataType, VectorUDT) for c in _inputs(stage) or () if c in rows.columns):
                rows, kept = written(rows.select(*_wanted(rows, stages[i:])), "stage-rows"), True
            stage = stage.fit(rows)
        fitted.append(stage)
        if i + 1 < len(stages):
            rows = stage.transform(rows)
    return PipelineModel(fitted)


def _inputs(stage) -> set[str] | None:
    """The columns that a stage says it reads; none if it does not say."""
    names = ("inputCol", "inputCols", "featuresCol", "labelCol", "weightCol")
    read = [stage.getOrDefault(n) for n in names if stage.hasParam(n) and stage.isDefined(stage.getParam(n))]
    return {c for r in read for c in ([r] if isinstance(r, str) else r)} or None


def _wanted(rows: DataFrame, stages: Stages) -> list[str]:
    """The columns that any of the stages reads, or all of them."""
    read = [_inputs(s) for s in stages]
    return rows.columns if None in read else [c for c in rows.columns if any(c in r for r in read)]


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def term_buckets(terms: DataFrame, buckets: int = 20_000) -> DataFrame:
    """(term, bucket) of distinct terms: where the hashed features count each of them."""
    hashed = hashing_tf(words="_words", out="_v", buckets=buckets).transform(terms.select("term", F.array("term").alias("_words")))
    return hashed.select("term", F.unwrap_udt("_v")["indices"][0].alias("bucket"))


def term_dictionary(df: DataFrame, words: str = "filtered", buckets: int = 20_000) -> DataFrame:
    """(term, doc_freq, bucket, collides): the terms behind each hashed feature, and whether another has the same.

    A bucket's document frequency can be traced to its terms; what hashing mixes up is seen.
    """
    counts = df.select(F.explode(F.array_distinct(words)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"))
    placed = written(term_buckets(counts, buckets).join(counts, "term"), "terms")
    shared = placed.groupBy("bucket").agg((F.count(F.lit(1)) > 1).alias("collides"))  # at most `buckets` rows
    return placed.join(shared, "bucket").select("term", "doc_freq", "bucket", "collides")


# --- splits ---------------------------------------------------------------


def key_hash(key: str, seed: int = 42) -> Column:
    """32 hex digits that depend on the key and the seed only, never on the partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def split(df: DataFrame, key: str, frac: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the key, in steps of 1/10000. Needs no shuffle, and a
    re-run task or a changed partitioning draws the same rows."""
    drawn = F.pmod(F.conv(F.substring(key_hash(key, seed), 1, 8), 16, 10).cast("long"), F.lit(10_000))
    is_train = F.coalesce(drawn < int(round(frac * 10_000)), F.lit(True))
    return df.filter(is_train), df.filter(~is_train)


def random_split(df: DataFrame, frac: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """`randomSplit`; its draw depends on how the rows are partitioned."""
    train, test = df.randomSplit([frac, 1 - frac], seed=seed)
    return train, test


def stratified_split(
    df: DataFrame, label: str = "label", key: str = "post_id", frac: float = 0.8, seed: int = 42,
    labels: Sequence[int] = LABELS,
) -> DataFrame:
    """Mark `ceil(frac * count)` rows of every label as train, in hash order of a unique key.

    Rows with any other label, or none, are one more class. No class is sorted as a
    whole: a count per 4-digit hash prefix finds the prefix that holds the cut, and
    only the keys below that prefix are ordered. What is broadcast has one row per
    class.
    """
    stratum = F.when(F.col(label).isin(*labels), F.col(label).cast("int")).otherwise(-1)
    prefixed = df.select(stratum.alias("_s"), key_hash(key, seed).alias("_hash")).withColumn(
        "_prefix", F.substring("_hash", 1, 4)
    )
    whole = Window.partitionBy("_s")
    placed = (
        prefixed.groupBy("_s", "_prefix")
        .agg(F.count(F.lit(1)).alias("c"))
        .withColumns(
            {
                "before": F.sum("c").over(whole.orderBy("_prefix")) - F.col("c"),
                "wanted": F.ceil(F.sum("c").over(whole) * F.lit(frac)),
            }
        )
    )
    holds_cut = (F.col("before") < F.col("wanted")) & (F.col("wanted") <= F.col("before") + F.col("c"))
    edge = placed.filter(holds_cut).select("_s", "_prefix", (F.col("wanted") - F.col("before")).alias("rest"))
    near = (
        prefixed.join(F.broadcast(edge), ["_s", "_prefix"])
        .groupBy("_s", "_hash", "rest")
        .agg(F.count(F.lit(1)).alias("c"))
        .withColumn("upto", F.sum("c").over(whole.orderBy("_hash")))
    )
    cut = near.filter(F.col("upto") >= F.col("rest")).groupBy("_s").agg(F.min("_hash").alias("_cut"))
    is_train = F.coalesce(key_hash(key, seed) <= F.col("_cut"), F.lit(False))
    marked = df.withColumn("_s", stratum).join(F.broadcast(cut), "_s", "left").withColumn("is_train", is_train)
    return marked.select(*df.columns, "is_train")


# --- scoring --------------------------------------------------------------


def score(df: DataFrame, model: PipelineModel, text: str = "text") -> DataFrame:
    """Model over a static or streaming frame, with the predicted class name."""
    scored = model.transform(fill_nulls(df, {text: ""}))
    name = label_name(F.col("prediction").cast("int"), default=LABEL_NAMES[NEUTRAL])
    return scored.withColumn("predicted_category", name)


def ensure_label(df: DataFrame, model: PipelineModel, mode: str = "missing", label: str = "label") -> DataFrame:
    """A label on every row: the model's where it is missing, or everywhere (`all`).

    The old label is set aside before scoring, so the frame never has two of that name.
    """
    known = F.lit(None).cast("int")
    if mode == "missing" and label in df.columns:
        known = F.col(label).cast("int")
    elif mode not in ("missing", "all"):
        raise ValueError(f"unknown mode {mode!r}")
    columns = [c for c in df.columns if c != label]
    scored = score(df.withColumn("_known", known).drop(label), model)
    return fill_label(scored, "_known", label).select(*columns, label)


def fill_label(scored: DataFrame, known: str, label: str = "label") -> DataFrame:
    """The known label of a scored row, or its prediction where there is none."""
    return scored.withColumn(label, F.coalesce(F.col(known), F.col("prediction").cast("int")))


def with_confidence(df: DataFrame, prob: str = "probability", out: str = "confidence") -> DataFrame:
    """Probability of the predicted class."""
    return df.withColumn(out, F.array_max(vector_to_array(F.col(prob))))


def uncertain(df: DataFrame, prob: str = "probability", cls: int = 0, lo: float = 0.4, hi: float = 0.6) -> DataFrame:
    """Rows whose probability of one class is strictly between the bounds, for relabelling."""
    p = vector_to_array(F.col(prob))[cls]
    return df.filter((p > lo) & (p < hi))


# --- evaluation and tuning ------------------------------------------------


def model_metrics(
    scored: DataFrame, label: str = "label", pred: str = "prediction", labels: Sequence[int] = LABELS
) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1, from one pass over scored rows.

    The figures of `MulticlassClassificationEvaluator`, which takes a pass for each.
    """
    per_class = class_metrics(scored, label, pred, labels)
    weight = F.sum("support")
    return per_class.agg(
        ratio(F.sum(F.col("recall") * F.col("support")), weight).alias("accuracy"),
        *[
            ratio(F.sum(F.col(m) * F.col("support")), weight).alias(f"w_{m}")
            for m in ("precision", "recall", "f1")
        ],
    )


def fold_of(key: str, folds: int, seed: int = 42) -> Column:
    """The fold of a row, from 0 on, by a hash of its key: the same on any cluster and in any rerun."""
    drawn = F.conv(F.substring(key_hash(key, seed), 9, 8), 16, 10).cast("long")
    return F.pmod(drawn, F.lit(folds)).cast("int")


def out_of_fold(
    df: DataFrame, features: Stages, key: str, reg: Sequence[float] = (0.001, 0.01, 0.1), folds: int = 3,
    label: str = "label", text: str = "text", max_iter: int = 100, seed: int = 42,
) -> DataFrame:
    """(key, label, fold, reg, prediction, confidence): every labelled row once for each strength, by a model that never saw its fold.

    What needs no fitting is done and written once for all folds, features once a fold for
    all strengths. The table is written to the shared folder.
    """
    labelled = fill_nulls(df.filter(F.col(label).isNotNull()), {text: ""})
    labelled = labelled.select(key, label, text, fold_of(key, folds, seed).alias("fold"))
    features = list(features)
    while features and not isinstance(features[0], Estimator):
        labelled = features.pop(0).transform(labelled)
    wanted = _wanted(labelled, features) if features else ["features"]
    labelled = written(labelled.select(*dict.fromkeys([key, label, "fold", *wanted])), "folds")
    parts = []
    for fold in range(folds):
        seen, unseen = labelled.filter(F.col("fold") != fold), labelled.filter(F.col("fold") == fold)
        if seen.isEmpty() or unseen.isEmpty():
            if not unseen.isEmpty():
                raise ValueError("all labelled rows are in one fold")
            continue
        fitted = fit_stages(seen, features)
        kept = written(fitted.transform(labelled).select(key, label, "fold", "features"), "fold-features")
        for strength in reg:
            model = logistic(label, max_iter=max_iter, reg=strength).fit(kept.filter(F.col("fold") != fold))
            scored = with_confidence(model.transform(kept.filter(F.col("fold") == fold)))
            row = scored.select(key, label, "fold", F.lit(float(strength)).alias("reg"), F.col("prediction").cast("int").alias("prediction"), "confidence")
            parts.append(written(row, "out-of-fold"))
    if not parts:
        raise ValueError("no labelled rows")
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def strength_accuracy(scored: DataFrame, label: str = "label") -> DataFrame:
    """(reg, rows, correct, accuracy) of an out-of-fold table."""
    right = F.count_if(F.col(label) == F.col("prediction"))
    by_reg = scored.groupBy("reg").agg(F.count(F.lit(1)).alias("rows"), right.alias("correct"))
    return by_reg.withColumn("accuracy", F.col("correct") / F.col("rows"))


def tune(
    df: DataFrame, features: Stages, key: str = "post_id", reg: Sequence[float] = (0.001, 0.01, 0.1), folds: int = 3,
    label: str = "label", text: str = "text", max_iter: int = 100, seed: int = 42,
) -> tuple[PipelineModel, list[tuple[float, float]]]:
    """Model of the strength that is right most often out of fold (ties: the smaller), and (strength, accuracy) of each."""
    scored = out_of_fold(df, features, key, reg, folds, label, text, max_iter, seed)
    grid = sorted((r["reg"], r["accuracy"]) for r in strength_accuracy(scored, label).collect())
    best = max(grid, key=lambda g: (g[1], -g[0]))[0]
    return fit_classifier(df, [*features, logistic(label, max_iter=max_iter, reg=best)], label, text), grid


def retrain(
    df: DataFrame, rule_label: str, stages: Stages | None = None, text: str = "text"
) -> tuple[PipelineModel, DataFrame]:
    """Model fitted on an outside labeller's column, and the rows where the two differ.

    Negative labels are error codes and take no part. The rows that differ are the
    ones to look at before the next round.
    """
    usable = df.filter(F.col(rule_label) >= 0)
    model = fit_classifier(usable, stages or [*feature_stages(text), logistic(rule_label)], rule_label, text)
    scored = score(usable, model, text).withColumn("prediction", F.col("prediction").cast("int"))
    differ = valid_pairs(scored, rule_label, "prediction").filter(F.col(rule_label) != F.col("prediction"))
    return model, differ.select(*df.columns, "prediction")
