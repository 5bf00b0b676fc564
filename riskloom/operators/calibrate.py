"""Probability calibration: sigmoid, isotonic and the choice between them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from riskloom.operators import isotonic
from riskloom.operators.evaluate import probability_metrics

MIN_GAIN = 0.01


@dataclass
class Calibrator:
    """``none``, ``sigmoid`` with slope and intercept, or ``isotonic`` with its fit."""

    kind: str = "none"
    slope: float = 1.0
    intercept: float = 0.0
    model: isotonic.IsotonicFit | None = None

    def apply(self, df: DataFrame, score: str, name: str = "calibrated") -> DataFrame:
        if self.kind == "sigmoid":
            margin = F.lit(self.slope) * F.col(score) + F.lit(self.intercept)
            return df.withColumn(name, 1.0 / (1.0 + F.exp(-margin)))
        if self.kind == "isotonic":
            return self.model.apply(df, score, name)
        return df.withColumn(name, F.col(score))


def _counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Distinct scores with class counts: ties cost one row however many there are."""
    return (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("_score"))
        .agg(F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"))
    )


def fit_sigmoid(df: DataFrame, label: str, score: str, max_iter: int = 200) -> Calibrator:
    """Platt scaling with smoothed targets.

    A soft target t is a pair of weighted rows: class 1 with weight t and class
    0 with weight 1 - t, summed over the rows that share a score.
    """
    counts = _counts(df, label, score)
    totals = counts.agg(F.sum("_pos").alias("p"), F.sum("_neg").alias("n")).first()
    high = (totals["p"] + 1.0) / (totals["p"] + 2.0)
    low = 1.0 / (totals["n"] + 2.0)
    pos, neg = F.col("_pos"), F.col("_neg")
    weighted = counts.select(
        "_score",
        F.inline(
            F.array(
                F.struct(F.lit(1.0).alias("_y"), (pos * high + neg * low).alias("_w")),
                F.struct(F.lit(0.0).alias("_y"), (pos * (1 - high) + neg * (1 - low)).alias("_w")),
            )
        ),
    )
    data = VectorAssembler(inputCols=["_score"], outputCol="_x").transform(weighted)
    fit = LogisticRegression(
        labelCol="_y", weightCol="_w", featuresCol="_x", regParam=0.0, maxIter=max_iter, tol=1e-10
    ).fit(data)
    return Calibrator("sigmoid", float(fit.coefficients[0]), float(fit.intercept))


def fit_isotonic(df: DataFrame, label: str, score: str) -> Calibrator:
    """Monotone step-wise fit, interpolated between and constant outside the ends of the blocks."""
    return Calibrator("isotonic", model=isotonic.fit(_counts(df, label, score), "_score", "_pos", "_neg"))


def brier(df: DataFrame, label: str, score: str) -> float:
    return probability_metrics(df, label, score).first()["brier_score"]


def choose_calibrator(
    fit_rows: DataFrame, judge_rows: DataFrame, label: str, score: str
) -> tuple[Calibrator, dict[str, float]]:
    """The calibrator with the lowest Brier score on rows it was not fitted on.

    It is only used if it gains more than one percent over the raw scores.
    """
    options = [Calibrator(), fit_sigmoid(fit_rows, label, score), fit_isotonic(fit_rows, label, score)]
    briers = {o.kind: brier(o.apply(judge_rows, score), label, "calibrated") for o in options}
    best = min(options, key=lambda o: briers[o.kind])
    gain = briers["none"] - briers[best.kind]
    return (best if gain > MIN_GAIN * briers["none"] else options[0]), briers
