"""Comparison of two label columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.numbers import ratio
from postlens.schema import LABELS


def _match(a: str, b: str):
    return F.col(a).cast("int") == F.col(b).cast("int")


def valid_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows both labellers gave a class; a negative second label is an error code."""
    return df.filter(F.col(a).isNotNull() & (F.col(b) >= 0))


def accuracy(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Share of rows whose prediction is the label; null without rows."""
    return df.agg(F.avg(_match(label, pred).cast("double")).alias("accuracy"))


def agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    valid = F.col(a).isNotNull() & F.coalesce(F.col(b) >= 0, F.lit(False))
    return (
        df.agg(
            F.count_if(valid).alias("valid"),
            F.count_if(valid & _match(a, b)).alias("agreements"),
            F.count_if(valid & ~_match(a, b)).alias("disagreements"),
        )
        .withColumn("rate", ratio(F.col("agreements"), F.col("valid")) * 100)
    )


def agreement_status(df: DataFrame, a: str, b: str, out: str = "status") -> DataFrame:
    """MATCH, DIFF, or ERROR when the second label is missing or an error code."""
    status = F.when(F.col(b).isNull() | (F.col(b) < 0), "ERROR").when(_match(a, b), "MATCH").otherwise("DIFF")
    return df.withColumn(out, status)


def confusion_matrix(
    df: DataFrame, actual: str = "label", pred: str = "pred", labels: Sequence[int] = LABELS, wide: bool = False
) -> DataFrame:
    """Rows of each (actual, predicted) pair, zero for absent pairs.

    Long form: actual, pred, n. Wide form: actual and one `pred_<k>` per class.
    All counts come from one global aggregate; there is no group to shuffle.
    """
    a, p = F.col(actual).cast("int"), F.col(pred).cast("int")
    counted = df.agg(
        *[F.count_if((a == i) & (p == j)).alias(f"_{i}_{j}") for i in labels for j in labels]
    )
    if wide:
        rows = [
            F.struct(F.lit(i).alias("actual"), *[F.col(f"_{i}_{j}").alias(f"pred_{j}") for j in labels])
            for i in labels
        ]
    else:
        rows = [
            F.struct(F.lit(i).alias("actual"), F.lit(j).alias("pred"), F.col(f"_{i}_{j}").alias("n"))
            for i in labels
            for j in labels
        ]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def class_metrics(
    df: DataFrame, actual: str = "label", pred: str = "pred", labels: Sequence[int] = LABELS
) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where a denominator is 0."""
    a, p = F.col(actual).cast("int"), F.col(pred).cast("int")
    sums = []
    for k in labels:
        sums += [
            F.count_if((a == k) & (p == k)).alias(f"_tp{k}"),
            F.count_if((p == k) & a.isNotNull()).alias(f"_pp{k}"),
            F.count_if((a == k) & p.isNotNull()).alias(f"_ap{k}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(k).alias("label"),
                F.col(f"_tp{k}").alias("tp"),
                F.col(f"_pp{k}").alias("predicted"),
                F.col(f"_ap{k}").alias("support"),
            )
            for k in labels
        ]
    )
    per_class = df.agg(*sums).select(F.explode(rows).alias("r")).select("r.*")
    tp = F.col("tp")
    return per_class.select(
        "label",
        ratio(tp, F.col("predicted")).alias("precision"),
        ratio(tp, F.col("support")).alias("recall"),
        # 2PR / (P + R) in counts.
        ratio(2 * tp, F.col("predicted") + F.col("support")).alias("f1"),
        "support",
    )


def weighted_metrics(
    df: DataFrame, label: str = "label", pred: str = "pred", labels: Sequence[int] = LABELS
) -> DataFrame:
    """Precision, recall and F1 averaged over the classes by their support."""
    per_class = class_metrics(df, label, pred, labels)
    weight = F.sum("support")
    return per_class.agg(
        *[
            ratio(F.sum(F.col(m) * F.col("support")), weight).alias(f"w_{m}")
            for m in ("precision", "recall", "f1")
        ]
    )


def class_accuracy(
    df: DataFrame, actual: str = "label", pred: str = "pred", labels: Sequence[int] = LABELS
) -> DataFrame:
    """Share of each actual class that was predicted right; 0 for an empty class."""
    return class_metrics(df, actual, pred, labels).select("label", F.col("recall").alias("accuracy"))


def paired_distribution(df: DataFrame, a: str, b: str, labels: Sequence[int] = LABELS) -> DataFrame:
    """Rows per class as counted by each labeller, over the valid pairs."""
    first, second = F.col(a).cast("int"), F.col(b).cast("int")
    counted = valid_pairs(df, a, b).agg(
        *[F.count_if(first == k).alias(f"_a{k}") for k in labels],
        *[F.count_if(second == k).alias(f"_b{k}") for k in labels],
    )
    rows = F.array(
        *[
            F.struct(F.lit(k).alias("label"), F.col(f"_a{k}").alias("count_a"), F.col(f"_b{k}").alias("count_b"))
            for k in labels
        ]
    )
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def disagreements(
    df: DataFrame, a: str, b: str, key: str = "post_id", n: int | None = 5, text: str = "text", chars: int = 80
) -> DataFrame:
    """The first `n` valid rows (None = all) on which the labellers differ."""
    differ = valid_pairs(df, a, b).filter(~_match(a, b))
    rows = differ.select(
        key, F.substring(F.col(text), 1, chars).alias("text_preview"), F.col(a).alias("a"), F.col(b).alias("b")
    ).orderBy(key)
    return rows if n is None else rows.limit(n)


def threshold_flags(metrics: DataFrame, targets: Mapping[str, tuple[float, str]], near: float = 0.9) -> DataFrame:
    """Status of each metric of a one-row frame against its target.

    A target is `(value, "min")`, PASS from the value on and ACCEPTABLE from `near`
    of it, or `(value, "max")`, PASS below the value; anything else is BELOW
    (respectively ABOVE) TARGET.
    """
    rows = []
    for name, (target, kind) in targets.items():
        value = F.col(name).cast("double")
        if kind == "min":
            status = F.when(value >= target, "PASS").when(value >= target * near, "ACCEPTABLE").otherwise("BELOW TARGET")
        else:
            status = F.when(value < target, "PASS").otherwise("ABOVE TARGET")
        rows.append(
            F.struct(
                F.lit(name).alias("metric"), value.alias("value"),
                F.lit(float(target)).alias("target"), status.alias("status"),
            )
        )
    return metrics.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
