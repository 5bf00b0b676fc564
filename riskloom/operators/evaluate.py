"""Classifier evaluation on ``label`` in {0, 1} and a probability ``score``.

Everything that depends on the order of scores works on the table of distinct
scores with their class counts, ranked by :mod:`ordered`; one aggregate over it
yields every metric. ``keys`` evaluates many groups (say weeks) in one plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskloom.functions.binning import grid_position
from riskloom.operators.ordered import running, with_buckets

EPS = float(np.finfo(np.float64).eps)

# ---- fixed values: the threshold grid and the cost of each error
THRESHOLD_GRID = [float(t) for t in np.linspace(0.01, 0.99, 200)]
FALSE_POSITIVE_COST = 1.0
FALSE_NEGATIVE_COST = 5.0
MIN_RECALL = 0.60


def score_counts(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, score, pos, neg``: rows per distinct score."""
    y = F.col(label)
    return (
        df.where(F.col(score).isNotNull() & y.isNotNull())
        .groupBy(*keys, F.col(score).cast("double").alias("score"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    )


def ranked_scores(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct scores from high to low with ``cum_pos`` and ``cum_neg`` up to each."""
    counts = score_counts(df, label, score, keys)
    narrow = df.select(*keys, F.col(score).cast("double").alias("score"))
    bucketed = with_buckets(counts, "score", keys, descending=True, sketch_from=narrow)
    return running(bucketed, ["score"], {"cum_pos": F.col("pos"), "cum_neg": F.col("neg")}, keys, descending=True)


# --------------------------------------------------------------------------
# metrics


def _ratio(top: Column, bottom: Column) -> Column:
    """Quotient, 0 on an empty denominator."""
    return F.when(bottom != 0, top / bottom).otherwise(F.lit(0.0))


def confusion_metrics(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    precision, recall, specificity = _ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(tn, tn + fp)
    return {
        "precision": precision,
        "recall": recall,
        "specificity": specificity,
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        "balanced_accuracy": (recall + specificity) / 2,
        "npv": _ratio(tn, tn + fn),
        "true_positives": tp,
        "false_positives": fp,
        "false_negatives": fn,
        "true_negatives": tn,
    }


def _ranking(pos: Column, neg: Column) -> dict[str, Column]:
    """Aggregates for ROC-AUC (ties count half) and average precision (step sum)."""
    pos_d, neg_d = pos.cast("double"), neg.cast("double")
    beaten = neg_d * (F.col("cum_pos") - pos + pos_d / 2)
    step = pos_d * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return {
        "roc_auc": F.sum(beaten) / F.nullif(F.sum(pos_d) * F.sum(neg_d), F.lit(0.0)),
        "pr_auc": F.sum(step) / F.nullif(F.sum(pos_d), F.lit(0.0)),
    }


def _probability(pos: Column, neg: Column, p: Column) -> dict[str, Column]:
    clipped = F.greatest(F.least(p, F.lit(1 - EPS)), F.lit(EPS))
    n = F.sum(pos + neg)
    return {
        "brier_score": F.sum(pos * F.pow(p - 1, F.lit(2.0)) + neg * F.pow(p, F.lit(2.0))) / n,
        "log_loss": -F.sum(pos * F.log(clipped) + neg * F.log1p(-clipped)) / n,
    }


def ranking_metrics(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, roc_auc, pr_auc``."""
    ranked = ranked_scores(df, label, score, keys)
    return ranked.groupBy(*keys).agg(*[a.alias(n) for n, a in _ranking(F.col("pos"), F.col("neg")).items()])


def probability_metrics(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, brier_score, log_loss``: no order needed, so no shuffle of rows."""
    y = F.col(label).cast("double")
    rows = df.where(F.col(score).isNotNull() & y.isNotNull())
    parts = _probability(y, 1 - y, F.col(score))
    return rows.groupBy(*keys).agg(*[a.alias(n) for n, a in parts.items()])


def full_metrics(
    df: DataFrame, label: str, score: str, threshold: float = 0.5, keys: Sequence[str] = ()
) -> DataFrame:
    """Ranking, probability and threshold metrics plus supports, one row per key."""
    pos, neg, p = F.col("pos"), F.col("neg"), F.col("score")
    hit = p >= F.lit(threshold)
    grouped = ranked_scores(df, label, score, keys).groupBy(*keys).agg(
        *[a.alias(n) for n, a in {**_ranking(pos, neg), **_probability(pos, neg, p)}.items()],
        F.sum(F.when(hit, pos).otherwise(0)).alias("_tp"),
        F.sum(F.when(hit, neg).otherwise(0)).alias("_fp"),
        F.sum(F.when(hit, 0).otherwise(pos)).alias("_fn"),
        F.sum(F.when(hit, 0).otherwise(neg)).alias("_tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("_tp", "_fp", "_fn", "_tn"))
    return grouped.select(
        *keys,
        "roc_auc",
        "pr_auc",
        "brier_score",
        "log_loss",
        *[v.alias(n) for n, v in confusion_metrics(tp, fp, fn, tn).items()],
        F.lit(float(threshold)).alias("threshold_used"),
        (tp + fn).alias("support_positive"),
        (tp + fp + fn + tn).alias("support_total"),
    )


COMPACT = ["roc_auc", "pr_auc", "brier_score", "log_loss", "precision", "recall", "f1", "threshold_used"]


def compact_metrics(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    return full_metrics(df, label, score, threshold).select(*COMPACT)


def as_metric_rows(metrics: DataFrame) -> DataFrame:
    """One-row metrics as ``metric, value`` rows for the JSON sink."""
    doubles = metrics.select(*[F.col(c).cast("double").alias(c) for c in metrics.columns])
    return doubles.unpivot([], metrics.columns, "metric", "value")


# --------------------------------------------------------------------------
# curves


def _evenly(index: Column, count: Column, points: int) -> Column:
    """True for the rows an even index grid ``int(i * (count - 1) / (m - 1))`` would pick."""
    m = F.least(F.lit(points), count)
    last = (m - 1).cast("double")
    spacing = (count - 1) / F.when(last > 0, last)
    nearest = F.floor(index / F.when(spacing > 0, spacing)).cast("long")
    picked = F.lit(False)
    # the grid step that lands on this index is one of three neighbours of index / spacing
    for shift in (0, 1, 2):
        i = nearest + shift
        at = F.when(i >= m - 1, (count - 1).cast("double")).otherwise(i * spacing)
        picked = picked | ((i <= m - 1) & (F.floor(at) == index))
    return (count <= 1) | picked


def roc_points(df: DataFrame, label: str, score: str, points: int = 200) -> DataFrame:
    """``idx, fpr, tpr, threshold``: at most ``points`` evenly picked curve points.

    Points inside a straight stretch (same class counts as the next score) are
    dropped before picking; the curve starts at (0, 0).
    """
    counts = score_counts(df, label, score)
    narrow = df.select(F.col(score).cast("double").alias("score"))
    bucketed = with_buckets(counts, "score", descending=True, sketch_from=narrow)
    ranked = running(
        bucketed,
        ["score"],
        {"cum_pos": F.col("pos"), "cum_neg": F.col("neg")},
        descending=True,
        following=["pos", "neg"],
    )
    corner = F.col("next_pos").isNull() | (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    kept = running(ranked.where(corner), ["score"], {"idx": F.lit(1)}, descending=True)
    totals = kept.agg(F.max("idx").alias("_last"), F.max("cum_pos").alias("_p"), F.max("cum_neg").alias("_n")).first()
    if totals["_last"] is None:
        raise ValueError("no scored rows")
    start = df.sparkSession.createDataFrame([(0, 0, 0, None)], "idx long, cum_neg long, cum_pos long, score double")
    curve = kept.select("idx", "cum_neg", "cum_pos", "score").unionByName(start)
    return curve.where(_evenly(F.col("idx"), F.lit(totals["_last"] + 1), points)).select(
        "idx",
        _ratio(F.col("cum_neg"), F.lit(totals["_n"])).alias("fpr"),
        _ratio(F.col("cum_pos"), F.lit(totals["_p"])).alias("tpr"),
        F.col("score").alias("threshold"),
    )


def pr_points(df: DataFrame, label: str, score: str, points: int = 200) -> DataFrame:
    """``idx, precision, recall, threshold, baseline`` from the lowest threshold up.

    The last point is (precision 1, recall 0); ``baseline`` is the positive share.
    """
    ranked = ranked_scores(df, label, score)
    totals = ranked.agg(
        F.count(F.lit(1)).alias("n"), F.sum("pos").alias("p"), F.sum(F.col("pos") + F.col("neg")).alias("all")
    ).first()
    if not totals["n"]:
        raise ValueError("no scored rows")
    numbered = running(ranked, ["score"], {"_down": F.lit(1)}, descending=True)
    curve = numbered.select(
        (F.lit(totals["n"]) - F.col("_down")).alias("idx"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        _ratio(F.col("cum_pos"), F.lit(totals["p"])).alias("recall"),
        F.col("score").alias("threshold"),
    )
    end = df.sparkSession.createDataFrame(
        [(totals["n"], 1.0, 0.0, None)], "idx long, precision double, recall double, threshold double"
    )
    picked = curve.unionByName(end).where(_evenly(F.col("idx"), F.lit(totals["n"] + 1), points))
    return picked.withColumn("baseline", F.lit(totals["p"] / totals["all"]))


# --------------------------------------------------------------------------
# thresholds


def threshold_sweep(df: DataFrame, label: str, score: str, grid: Sequence[float] = THRESHOLD_GRID) -> DataFrame:
    """``threshold, tp, fp, fn, tn, precision, recall, f1, cost`` at every grid point.

    Each row only finds its own place in the grid; the counts per place (one
    more than grid points) are then accumulated from the top.
    """
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    place = grid_position(F.col(score).cast("double"), grid)
    counts = rows.groupBy(place.alias("place")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    spark = df.sparkSession
    steps = spark.createDataFrame([(0, None)] + [(i + 1, t) for i, t in enumerate(grid)], "place int, threshold double")
    table = steps.join(F.broadcast(counts), "place", "left").na.fill(0, ["pos", "neg"])
    # 201 rows, so the frames over all of them are cheap
    above = W.orderBy(F.desc("place")).rowsBetween(W.unboundedPreceding, W.currentRow)
    below = W.orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    swept = table.select(
        "place",
        "threshold",
        F.sum("pos").over(above).alias("tp"),
        F.sum("neg").over(above).alias("fp"),
        F.coalesce(F.sum("pos").over(below), F.lit(0)).alias("fn"),
        F.coalesce(F.sum("neg").over(below), F.lit(0)).alias("tn"),
    ).where(F.col("threshold").isNotNull())
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return swept.select(
        "threshold",
        "tp",
        "fp",
        "fn",
        "tn",
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(2 * precision * recall, precision + recall).alias("f1"),
        (FALSE_POSITIVE_COST * fp + FALSE_NEGATIVE_COST * fn).alias("cost"),
    )


def threshold_candidates(df: DataFrame, label: str, score: str, min_recall: float = MIN_RECALL) -> dict[str, float]:
    """Default, F1-optimal, cost-optimal and recall-constrained thresholds.

    Ties go to the lowest threshold; the recall rule takes the highest threshold
    that still reaches the recall, 0.5 if none does.
    """
    sweep = threshold_sweep(df, label, score)
    t = F.col("threshold")
    best = sweep.agg(
        F.min_by(t, F.struct(-F.col("f1"), t)).alias("f1_optimal"),
        F.min_by(t, F.struct("cost", t)).alias("cost_optimal"),
        F.max(F.when(F.col("recall") >= min_recall, t)).alias("recall"),
    ).first()
    return {
        "default": 0.5,
        "f1_optimal": best["f1_optimal"],
        "cost_optimal": best["cost_optimal"],
        f"recall_geq_{int(min_recall * 100)}pct": 0.5 if best["recall"] is None else best["recall"],
    }


def threshold_table(df: DataFrame, label: str, score: str, candidates: Mapping[str, float]) -> DataFrame:
    """One row per strategy, all counted in a single pass over the scores."""
    y, p = F.col(label), F.col(score)
    rows = df.where(p.isNotNull() & y.isNotNull())
    names = list(candidates)
    aggs = [F.avg(F.pow(p - y, F.lit(2.0))).alias("_brier"), F.count(F.lit(1)).alias("_n")]
    for i, name in enumerate(names):
        hit = p >= F.lit(float(candidates[name]))
        aggs += [
            F.count_if(hit & (y == 1)).alias(f"_tp{i}"),
            F.count_if(hit & (y == 0)).alias(f"_fp{i}"),
            F.count_if(~hit & (y == 1)).alias(f"_fn{i}"),
            F.count_if(~hit & (y == 0)).alias(f"_tn{i}"),
        ]
    entries = [
        F.struct(
            F.lit(name).alias("strategy"),
            F.lit(float(candidates[name])).alias("threshold"),
            *[F.col(f"_{k}{i}").alias(k) for k in ("tp", "fp", "fn", "tn")],
        )
        for i, name in enumerate(names)
    ]
    long = rows.agg(*aggs).select("_brier", "_n", F.explode(F.array(*entries)).alias("e")).select("_brier", "_n", "e.*")
    m = confusion_metrics(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return long.select(
        "strategy",
        F.round("threshold", 4).alias("threshold"),
        *[F.round(m[c], 4).alias(c) for c in ("precision", "recall", "specificity", "f1")],
        F.col("fp").alias("false_positives"),
        F.col("fn").alias("false_negatives"),
        F.round("_brier", 4).alias("brier_score"),
        F.round((F.col("tp") + F.col("fp")) / F.col("_n"), 4).alias("predicted_positive_rate"),
        (F.col("strategy") == "f1_optimal").alias("selected"),
    )


# --------------------------------------------------------------------------
# calibration


def calibration_curve(
    df: DataFrame, label: str, score: str, bins: int = 10, keys: Sequence[str] = ()
) -> DataFrame:
    """``bin, mean_predicted, fraction_positive, n`` over uniform right-closed bins.

    The first bin includes 0; empty bins do not appear.
    """
    y, p = F.col(label).cast("double"), F.col(score).cast("double")
    inner = [float(e) for e in np.linspace(0.0, 1.0, bins + 1)[1:-1]]
    # bins (a, b]: an edge belongs to the bin below it
    place = sum((p > F.lit(e)).cast("int") for e in inner) if inner else F.lit(0)
    return (
        df.where(p.isNotNull() & y.isNotNull())
        .groupBy(*keys, place.alias("bin"))
        .agg(F.avg(p).alias("mean_predicted"), F.avg(y).alias("fraction_positive"), F.count(F.lit(1)).alias("n"))
    )


def calibration_error(df: DataFrame, label: str, score: str, bins: int = 10, keys: Sequence[str] = ()) -> DataFrame:
    """``ece``: gap between confidence and outcome, weighted by the bins' own counts."""
    gap = F.abs(F.col("fraction_positive") - F.col("mean_predicted"))
    curve = calibration_curve(df, label, score, bins, keys)
    return curve.groupBy(*keys).agg((F.sum(F.col("n") * gap) / F.sum("n")).alias("ece"))
