"""Whether a fitted logistic regression is at its optimum: the regularised gradient, feature by feature."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.session import written


def feature_gradients(
    rows: DataFrame, model: LogisticRegressionModel, reg: float, label: str = "label", standardization: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(class, feature, gradient) of the regularised loss on its training rows, and (class, rows, intercept_gradient, loss).

    One aggregate over the entries of the sparse feature vectors gives the sums for all
    classes at once. As in training, a feature is measured in its standard deviations,
    the penalty is half of `reg` times the squared weights in that measure, and
    intercepts bear none. A feature that never varies has no weight and no gradient.
    """
    k = model.numClasses
    binary = model.coefficientMatrix.numRows == 1
    classes = [1] if binary else list(range(k))
    p = vector_to_array("probability")
    residuals = F.array(*[p[c] - (F.col(label) == c).cast("double") for c in classes])
    vector = F.unwrap_udt(model.getFeaturesCol())
    places = F.coalesce(vector["indices"], F.sequence(F.lit(0), F.size(vector["values"]) - 1))
    scored = model.transform(rows).select(
        residuals.alias("r"), F.log(F.element_at(p, F.col(label).cast("int") + 1)).alias("ll"), F.arrays_zip(places.alias("i"), vector["values"].alias("x")).alias("e")
    )
    scored = written(scored, "residuals")
    of_rows = scored.agg(F.count(F.lit(1)).alias("n"), F.sum("ll").alias("ll"), *[F.sum(F.col("r")[c]).alias(f"r{c}") for c in range(len(classes))]).first()
    n = of_rows["n"]
    entries = scored.select("r", F.explode("e").alias("e")).select(F.col("e.i").alias("feature"), F.col("e.x").alias("x"), "r")
    sums = entries.groupBy("feature").agg(
        F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("ss"),
        F.array(*[F.sum(F.col("x") * F.col("r")[c]) for c in range(len(classes))]).alias("xr"),
    )
    variance = F.greatest((F.col("ss") - F.col("s") * F.col("s") / F.lit(float(n))) / F.lit(float(max(n - 1, 1))), F.lit(0.0))
    measured = sums.withColumn("sd", F.sqrt(variance)).filter("sd > 0")
    # The weights are the model's own, as many as classes times features.
    weights = [(j, [float(x) for x in column]) for j, column in enumerate(model.coefficientMatrix.toArray().T)]
    weights = rows.sparkSession.createDataFrame(weights, "feature int, w array<double>")
    measured = written(measured.join(weights, "feature"), "gradients")
    scale = F.col("sd") if standardization else F.lit(1.0)
    each = measured.select("feature", "sd", F.posexplode(F.arrays_zip("xr", "w")).alias("at", "e"))
    gradients = each.select(
        F.element_at(F.array(*[F.lit(c) for c in classes]), F.col("at") + 1).alias("class"), "feature",
        (F.col("e.xr") / F.lit(float(n)) / scale + F.lit(reg) * F.col("e.w") * scale).alias("gradient"),
        (F.col("e.w") * scale).alias("weight"),
    )
    penalty = gradients.agg(F.coalesce(F.sum(F.col("weight") * F.col("weight")), F.lit(0.0)).alias("p")).first()["p"] * reg / 2
    loss = -(of_rows["ll"] or 0.0) / max(n, 1) + penalty
    summary = [(c, n, (of_rows[f"r{i}"] or 0.0) / max(n, 1), float(loss)) for i, c in enumerate(classes)]
    summary = rows.sparkSession.createDataFrame(summary, "class int, rows long, intercept_gradient double, loss double")
    return gradients.drop("weight"), summary


def certificate(
    rows: DataFrame, model: LogisticRegressionModel, reg: float, tolerance: float = 1e-3, label: str = "label", standardization: bool = True
) -> DataFrame:
    """(class, rows, max_gradient, intercept_gradient, loss, optimal): optimal if no entry of the gradient exceeds the tolerance."""
    gradients, summary = feature_gradients(rows, model, reg, label, standardization)
    largest = gradients.groupBy("class").agg(F.max(F.abs("gradient")).alias("g"))
    joined = summary.join(largest, "class", "left").withColumn("max_gradient", F.coalesce("g", F.lit(0.0)))
    optimal = F.greatest("max_gradient", F.abs("intercept_gradient")) <= tolerance
    return joined.select("class", "rows", "max_gradient", "intercept_gradient", "loss", optimal.alias("optimal"))
