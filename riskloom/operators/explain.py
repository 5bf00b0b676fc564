"""Additive attributions per row, ranked factors and their summaries."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.sources.contracts import REPORT_LABELS, SHORT_LABELS

# --------------------------------------------------------------------------
# labels


def feature_label(name: str, labels: Mapping[str, str] = SHORT_LABELS) -> str:
    """Readable label: the text after the last ``__``, looked up or title-cased."""
    base = name.rsplit("__", 1)[-1]
    return labels[base] if base in labels else base.replace("_", " ").title()


# --------------------------------------------------------------------------
# linear models


def linear_attributions(coefficients: Mapping[str, float], means: Mapping[str, float]) -> dict[str, Column]:
    """``coefficient * (x - mean)`` per feature; with the base they add up to the margin."""
    return {f: F.lit(float(b)) * (F.col(f) - F.lit(float(means[f]))) for f, b in coefficients.items()}


def linear_base(coefficients: Mapping[str, float], means: Mapping[str, float], intercept: float) -> float:
    return intercept + sum(b * means[f] for f, b in coefficients.items())


# --------------------------------------------------------------------------
# boosted trees


def _leaves(node, path: list) -> Iterator[tuple[float, list]]:
    """Leaf values with their path of ``(feature, low, high, share of rows)`` steps."""
    if node.getClass().getSimpleName() == "LeafNode":
        yield node.prediction(), path
        return
    split = node.split()
    rows = float(node.impurityStats().rawCount())
    f, at = split.featureIndex(), split.threshold()
    for child, low, high in ((node.leftChild(), -np.inf, at), (node.rightChild(), at, np.inf)):
        share = float(child.impurityStats().rawCount()) / rows
        yield from _leaves(child, [*path, (f, low, high, share)])


def _boxes(path: list) -> list[tuple[int, float, float, float]]:
    """``feature, low, high, share`` once for each feature on the path of a leaf."""
    merged: dict[int, list[float]] = {}
    for f, low, high, share in path:
        box = merged.setdefault(f, [-np.inf, np.inf, 1.0])
        merged[f] = [max(box[0], low), min(box[1], high), box[2] * share]
    return [(f, *box) for f, box in merged.items()]


def _leaf_shares(value: float, shares: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Shapley shares of the features on a leaf's path for each row of ``hits``.

    A row either follows the path on a feature or not. With ``m`` features the sums
    over subsets are polynomials of degree ``m - 1``, so this takes time in the cube of ``m``.
    """
    n, m = hits.shape
    weights = np.array([factorial(k) * factorial(m - 1 - k) / factorial(m) for k in range(m)])
    out = np.zeros((n, m))
    for i in range(m):
        # by_size[:, k]: summed products over the subsets of k other features that are known
        by_size = np.zeros((n, m))
        by_size[:, 0] = 1.0
        for j in range(m):
            if j != i:
                grown = np.roll(by_size, 1, axis=1) * hits[:, [j]]
                grown[:, 0] = 0.0
                by_size = by_size * shares[j] + grown
        out[:, i] = (by_size @ weights) * (hits[:, i] - shares[i]) * value
    return out


#: Features on a leaf's path up to which the patterns of followed splits are counted rather than sorted.
_COUNTED = 12


def _patterns(x: np.ndarray, boxes: list) -> tuple[np.ndarray, np.ndarray]:
    """Distinct patterns of followed features among the columns of ``x`` (a row a feature), in order, and each column's place."""
    codes = np.zeros(x.shape[1], np.int64)  # a path has at most 30 splits
    for f, low, high, _ in boxes:
        codes <<= 1
        codes |= (x[f] > low) & (x[f] <= high)
    if len(boxes) <= _COUNTED:
        met = np.flatnonzero(np.bincount(codes, minlength=1 << len(boxes)))
        of = np.zeros(1 << len(boxes), np.int64)
        of[met] = np.arange(len(met))
        place = of[codes]
    else:
        met, place = np.unique(codes, return_inverse=True)
    return ((met[:, None] >> np.arange(len(boxes))[::-1]) & 1).astype(float), place


def tree_leaves(model: Model) -> tuple[list, float]:
    """Weighted leaf values with their boxes, and the base value, on the margin scale. As large as the model."""
    leaves, base = [], 0.0
    for tree, weight in zip(model._java_obj.trees(), model.treeWeights):
        for value, path in _leaves(tree.rootNode(), []):
            base += weight * value * float(np.prod([p[3] for p in path]))
            if path:
                leaves.append((weight * value, _boxes(path)))
    return leaves, base


def tree_attributions(model: Model, df: DataFrame, keep: str | Sequence[str], features: Sequence[str]) -> DataFrame:
    """The ``keep`` columns, ``attributions array, base``: path-dependent Shapley values per row.

    Rows stream through in Arrow batches. Of each leaf only the patterns of
    followed splits that a batch really has are worked out, so memory stays
    bounded by the batch however deep the trees are.
    """
    leaves, base = tree_leaves(model)
    shared = df.sparkSession.sparkContext.broadcast(leaves)
    names = list(features)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.ascontiguousarray(batch[names].to_numpy(dtype=float).T)
            phi = np.zeros_like(x)
            for value, boxes in shared.value:
                hits, place = _patterns(x, boxes)
                found = _leaf_shares(value, np.array([share for *_, share in boxes]), hits)
                for j, (f, *_) in enumerate(boxes):
                    phi[f] += found[:, j][place]
            yield pd.DataFrame({**{k: batch[k] for k in kept}, "attributions": list(phi.T.copy()), "base": base})

    kept = [keep] if isinstance(keep, str) else list(keep)
    types = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in kept)
    narrow = df.select(*kept, *[F.col(c).cast("double").alias(c) for c in names])
    return narrow.mapInPandas(explain, f"{types}, attributions array<double>, base double")


def attribution_columns(features: Sequence[str], array: str = "attributions") -> dict[str, Column]:
    return {f: F.get(F.col(array), F.lit(i)) for i, f in enumerate(features)}


# --------------------------------------------------------------------------
# factors and text


def _by_strength(values: Mapping[str, Column]) -> Column:
    """All attributions of a row but zeros, the strongest first, by name on ties; sorted in place without a shuffle."""
    return F.sort_array(F.array_compact(F.array(*[
        F.when(values[n] != 0, F.struct((-F.abs(values[n])).alias("o"), F.lit(i).alias("i"), F.signum(values[n]).cast("int").alias("s")))
        for i, n in enumerate(sorted(values))
    ])))


def _factors(ranked: Column, values: Mapping[str, Column], labels: Mapping[str, str], sign: int, top: int) -> Column:
    """Strongest attributions of one sign; names only join the few that are kept."""
    names = sorted(values)
    kept = F.slice(F.filter(ranked, lambda e: e["s"] == sign), 1, top)
    features = F.array(*[F.lit(n) for n in names])
    readable = F.array(*[F.lit(feature_label(n, labels)) for n in names])
    return F.transform(
        kept,
        lambda e: F.struct(
            F.get(features, e["i"]).alias("feature"),
            F.get(readable, e["i"]).alias("label"),
            F.round(e["o"] * -sign, 4).alias("shap_value"),
        ),
    )


def top_factors(
    df: DataFrame,
    keep: Sequence[str],
    values: Mapping[str, Column],
    top: int = 5,
    labels: Mapping[str, str] = SHORT_LABELS,
) -> DataFrame:
    """Kept columns, ``top_risk_factors``, ``top_protective_factors``, ``text_summary``."""
    # attributions first become plain columns, so both lists read them once
    flat = df.select(*keep, *[v.alias(f"_a_{i}") for i, v in enumerate(values.values())])
    stored = {name: F.col(f"_a_{i}") for i, name in enumerate(values)}
    ranked = flat.select(*keep, _by_strength(stored).alias("_ranked")).select(
        *keep,
        _factors(F.col("_ranked"), stored, labels, 1, top).alias("top_risk_factors"),
        _factors(F.col("_ranked"), stored, labels, -1, top).alias("top_protective_factors"),
    )
    return ranked.withColumn("text_summary", text_summary("top_risk_factors", "top_protective_factors"))


def _bullets(factors: str) -> Column:
    lines = F.array_join(F.transform(F.col(factors)["label"], lambda x: F.concat(F.lit("  • "), x)), "\n")
    return F.when(F.size(factors) > 0, lines).otherwise(F.lit("  None"))


def text_summary(risk: str, protective: str) -> Column:
    return F.concat(
        F.lit("MODEL EXPLANATION (not causal reasoning):\nTop factors increasing default risk:\n"),
        _bullets(risk),
        F.lit("\nTop factors reducing default risk:\n"),
        _bullets(protective),
    )


def report_text(score: Column, risk: str, protective: str) -> Column:
    """Longer report of one row: score in percent and the impact of each factor."""

    def lines(factors: str, arrow: str, sign: str) -> Column:
        def line(e: Column) -> Column:
            impact = F.format_string("%.4f", e["shap_value"])
            return F.concat(F.lit(f"  {arrow}  "), e["label"], F.lit(f" (impact: {sign}"), impact, F.lit(")"))

        return F.array_join(F.transform(F.col(factors), line), "\n")

    return F.concat(
        F.lit("Risk score: "),
        F.format_string("%.1f", score * 100),
        F.lit("%\n\nMain factors INCREASING default risk:\n"),
        lines(risk, "↑", "+"),
        F.lit("\n\nMain factors REDUCING default risk:\n"),
        lines(protective, "↓", ""),
        F.lit("\n\n[Note: This is a model explanation, not a causal or legal determination.]"),
    )


def global_importance(df: DataFrame, values: Mapping[str, Column], top: int = 20, labels: Mapping[str, str] = REPORT_LABELS) -> DataFrame:
    """``feature, label, mean_abs_attribution``: the largest first."""
    names = {f"a{i}": name for i, name in enumerate(values)}
    row = df.agg(*[F.avg(F.abs(v)).alias(a) for a, v in zip(names, values.values())])
    long = row.unpivot([], list(names), "_a", "mean_abs_attribution")
    lookup = df.sparkSession.createDataFrame(
        [(a, name, feature_label(name, labels)) for a, name in names.items()], "_a string, feature string, label string"
    )
    return (
        long.join(F.broadcast(lookup), "_a")
        .select("feature", "label", "mean_abs_attribution")
        .orderBy(F.desc("mean_abs_attribution"), "feature")
        .limit(top)
    )
