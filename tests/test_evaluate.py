import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from riskloom.operators import calibrate, evaluate


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(11)
    score = np.concatenate([rng.random(700).round(2), np.full(300, 0.37)])
    return (rng.random(1000) < score).astype(int), score


@pytest.fixture(scope="module")
def scored(spark, sample):
    return spark.createDataFrame([(int(y), float(s)) for y, s in zip(*sample)], "y int, s double").repartition(6).cache()


def pairwise_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def step_precision(y, s):
    total, last = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        hit = s >= t
        recall = y[hit].sum() / y.sum()
        total += (recall - last) * y[hit].mean()
        last = recall
    return total


def test_metrics_match_definitions(scored, sample):
    y, s = sample
    m = evaluate.full_metrics(scored, "y", "s", 0.4).first()
    assert m["roc_auc"] == pytest.approx(pairwise_auc(y, s))
    assert m["pr_auc"] == pytest.approx(step_precision(y, s))
    assert m["brier_score"] == pytest.approx(((s - y) ** 2).mean())
    clipped = np.clip(s, np.finfo(float).eps, 1 - np.finfo(float).eps)
    assert m["log_loss"] == pytest.approx(-(y * np.log(clipped) + (1 - y) * np.log(1 - clipped)).mean())
    hit = s >= 0.4
    assert m["true_positives"] == (hit & (y == 1)).sum() and m["false_negatives"] == (~hit & (y == 1)).sum()
    assert m["precision"] == pytest.approx(y[hit].mean())
    assert (m["support_positive"], m["support_total"]) == (y.sum(), len(y))


def test_auc_agrees_with_the_built_in_and_mirrors(scored):
    auc = evaluate.ranking_metrics(scored, "y", "s").first()["roc_auc"]
    built_in = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="s", numBins=0).evaluate(scored)
    assert auc == pytest.approx(built_in)
    mirrored = scored.withColumn("s", 1 - F.col("s"))
    assert evaluate.ranking_metrics(mirrored, "y", "s").first()["roc_auc"] == pytest.approx(1 - auc)


def test_one_class_only(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.8)], "y int, s double")
    m = evaluate.full_metrics(df, "y", "s", 0.9).first()
    assert m["roc_auc"] is None and (m["precision"], m["recall"], m["specificity"], m["npv"]) == (0, 0, 0, 0)


def test_groups_equal_single_runs(scored):
    keyed = scored.withColumn("g", (F.col("s") * 100).cast("int") % 3)
    together = {r["g"]: r for r in evaluate.full_metrics(keyed, "y", "s", keys=["g"]).collect()}
    for g, row in together.items():
        alone = evaluate.full_metrics(keyed.where(F.col("g") == g), "y", "s").first()
        assert row["roc_auc"] == pytest.approx(alone["roc_auc"]) and row["pr_auc"] == pytest.approx(alone["pr_auc"])


def roc_by_hand(y, s):
    points = [(0, 0)]
    for t in sorted(set(s), reverse=True):
        points.append((int((y[s >= t] == 0).sum()), int((y[s >= t] == 1).sum())))
    p = np.array(points, dtype=float)
    keep = np.r_[True, np.any(np.diff(p, 2, axis=0) != 0, axis=1), True]
    return p[keep] / p[-1]


def test_roc_points(scored, sample):
    curve = roc_by_hand(*sample)
    for limit in (7, 10_000):
        want = curve[np.linspace(0, len(curve) - 1, min(limit, len(curve))).astype(int)]
        got = np.array([(r["fpr"], r["tpr"]) for r in evaluate.roc_points(scored, "y", "s", limit).orderBy("idx").collect()])
        np.testing.assert_allclose(got, want)


def test_pr_points(scored, sample):
    y, s = sample
    levels = sorted(set(s))
    want = [(y[s >= t].mean(), y[s >= t].sum() / y.sum()) for t in levels] + [(1.0, 0.0)]
    for limit in (9, 10_000):
        picked = np.linspace(0, len(want) - 1, min(limit, len(want))).astype(int)
        rows = evaluate.pr_points(scored, "y", "s", limit).orderBy("idx").collect()
        np.testing.assert_allclose([(r["precision"], r["recall"]) for r in rows], np.array(want)[picked])
        assert rows[0]["baseline"] == pytest.approx(y.mean())


def test_even_picks_match_the_index_grid(spark):
    for count in (1, 2, 199, 200, 201, 537, 4001):
        got = [r[0] for r in spark.range(count).where(evaluate._evenly(F.col("id"), F.lit(count), 200)).orderBy("id").collect()]
        assert got == sorted(set(np.linspace(0, count - 1, min(200, count)).astype(int).tolist()))


def test_thresholds_by_brute_force(scored, sample):
    y, s = sample
    best = {"f1": (-1, 0.5), "cost": (np.inf, 0.5)}
    recall_at = 0.5
    for t in evaluate.THRESHOLD_GRID:
        hit = s >= t
        tp, fp, fn = (hit & (y == 1)).sum(), (hit & (y == 0)).sum(), (~hit & (y == 1)).sum()
        p, r = tp / max(tp + fp, 1), tp / max(tp + fn, 1)
        f1 = 2 * p * r / (p + r) if p + r else 0
        best["f1"] = (f1, t) if f1 > best["f1"][0] else best["f1"]
        best["cost"] = (fp + 5 * fn, t) if fp + 5 * fn < best["cost"][0] else best["cost"]
        recall_at = t if r >= 0.6 else recall_at
    got = evaluate.threshold_candidates(scored, "y", "s")
    assert got == {"default": 0.5, "f1_optimal": best["f1"][1], "cost_optimal": best["cost"][1], "recall_geq_60pct": recall_at}


def test_recall_rule_without_a_candidate(spark):
    df = spark.createDataFrame([(1, 0.001), (0, 0.9)], "y int, s double")
    assert evaluate.threshold_candidates(df, "y", "s")["recall_geq_60pct"] == 0.5


def test_calibration_bins_and_error(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.1), (1, 0.1000001), (0, 0.95), (1, 1.0)], "y int, s double")
    rows = {r["bin"]: r for r in evaluate.calibration_curve(df, "y", "s").collect()}
    assert {b: r["n"] for b, r in rows.items()} == {0: 2, 1: 1, 9: 2}
    want = (2 * abs(0.5 - 0.05) + abs(1 - 0.1000001) + 2 * abs(0.5 - 0.975)) / 5
    assert evaluate.calibration_error(df, "y", "s").first()["ece"] == pytest.approx(want)


def test_calibrators(scored, sample):
    y, s = sample
    skewed = scored.withColumn("s", F.col("s") * F.col("s"))
    sigmoid = calibrate.fit_sigmoid(skewed, "y", "s")
    assert sigmoid.slope > 0
    applied = sigmoid.apply(skewed, "s")
    assert applied.where(~F.col("calibrated").between(0, 1)).count() == 0
    isotonic = calibrate.fit_isotonic(skewed, "y", "s").apply(skewed, "s")
    pairs = sorted({(r["s"], r["calibrated"]) for r in isotonic.collect()})
    assert all(a[1] <= b[1] + 1e-12 for a, b in zip(pairs, pairs[1:]))
    chosen, briers = calibrate.choose_calibrator(skewed, skewed, "y", "s")
    assert chosen.kind != "none" and briers[chosen.kind] < briers["none"]
    kept, briers = calibrate.choose_calibrator(scored, scored.limit(0).unionByName(scored), "y", "s")
    assert kept.kind == "none" or briers[kept.kind] < 0.99 * briers["none"]


def test_sigmoid_matches_newton(spark, sample):
    y, s = sample
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    fit = calibrate.fit_sigmoid(df, "y", "s")
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    beta, x = np.zeros(2), np.c_[s, np.ones_like(s)]
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        beta += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x, x.T @ (t - p))
    assert (fit.slope, fit.intercept) == pytest.approx(tuple(beta), abs=1e-4)
