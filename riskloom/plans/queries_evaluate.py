"""Evaluation of a score against a label: purchases among events."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import evaluate
from riskloom.plans.catalog import query, rounded, table

SCORED = """
SELECT event_id, ts, user_id, CAST(event_type = 'purchase' AS INT) AS label, value / (value + 50.0) AS score FROM events"""


def scored(spark, d):
    return table(spark, d, "events").select(
        "event_id",
        "ts",
        "user_id",
        (F.col("event_type") == "purchase").cast("int").alias("label"),
        (F.col("value") / (F.col("value") + 50.0)).alias("score"),
    )


_CONFUSION = """
c AS (SELECT CAST(sum(CASE WHEN score >= {t} AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
             CAST(sum(CASE WHEN score >= {t} AND label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
             CAST(sum(CASE WHEN score < {t} AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
             CAST(sum(CASE WHEN score < {t} AND label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn FROM s)"""
_RATES = """
round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
round(CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END, 6) AS specificity,
round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1,
round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS balanced_accuracy,
round(CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END, 6) AS npv,
tp AS true_positives, fp AS false_positives, fn AS false_negatives, tn AS true_negatives"""
# distinct scores from high to low with running class counts
RANKED = """
g AS (SELECT score, CAST(sum(label) AS BIGINT) AS pos, count(*) - CAST(sum(label) AS BIGINT) AS neg FROM s GROUP BY score),
r AS (SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, row_number() OVER w AS i,
             lead(pos) OVER (ORDER BY score DESC) AS np, lead(neg) OVER (ORDER BY score DESC) AS nn
      FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
a AS (SELECT round(sum(neg * (cp - pos + pos / 2)) / (sum(pos)::DOUBLE * sum(neg)), 6) AS roc_auc,
             round(sum(pos * cp / (cp + cn)) / sum(pos), 6) AS pr_auc FROM r),
b AS (SELECT round(avg(pow(score - label, 2)), 6) AS brier_score,
             round(-avg(CASE WHEN label = 1 THEN ln(greatest(score, 2.220446049250313e-16))
                             ELSE ln(1 - least(score, 1 - 2.220446049250313e-16)) END), 6) AS log_loss FROM s)"""
_RATE_PLACES = {c: 6 for c in (
    "roc_auc", "pr_auc", "brier_score", "log_loss", "precision", "recall", "specificity", "f1", "balanced_accuracy", "npv"
)}


@query("full_metrics", f"""
WITH s AS ({SCORED}), {_CONFUSION.format(t=0.5)}, {RANKED}
SELECT a.*, b.*, {_RATES}, CAST(0.5 AS DOUBLE) AS threshold_used, tp + fn AS support_positive, tp + fp + fn + tn AS support_total
FROM a, b, c""")
def full_metrics(spark, d):
    return rounded(evaluate.full_metrics(scored(spark, d), "label", "score", 0.5), _RATE_PLACES)


@query("confusion_metrics", f"""
WITH s AS ({SCORED}), {_CONFUSION.format(t=0.25)} SELECT {_RATES} FROM c""")
def confusion_metrics(spark, d):
    y, hit = F.col("label"), F.col("score") >= 0.25
    counts = scored(spark, d).agg(
        F.count_if(hit & (y == 1)).alias("tp"),
        F.count_if(hit & (y == 0)).alias("fp"),
        F.count_if(~hit & (y == 1)).alias("fn"),
        F.count_if(~hit & (y == 0)).alias("tn"),
    )
    parts = evaluate.confusion_metrics(*[F.col(c) for c in ("tp", "fp", "fn", "tn")])
    named = counts.select(*[v.alias(n) for n, v in parts.items()])
    return rounded(named, {c: p for c, p in _RATE_PLACES.items() if c in parts})


@query("roc_auc", f"WITH s AS ({SCORED}), {RANKED} SELECT roc_auc FROM a")
def roc_auc(spark, d):
    return rounded(evaluate.ranking_metrics(scored(spark, d), "label", "score").select("roc_auc"), {"roc_auc": 6})


@query("average_precision", f"WITH s AS ({SCORED}), {RANKED} SELECT pr_auc FROM a")
def average_precision(spark, d):
    return rounded(evaluate.ranking_metrics(scored(spark, d), "label", "score").select("pr_auc"), {"pr_auc": 6})


@query("brier_logloss", f"WITH s AS ({SCORED}), {RANKED} SELECT * FROM b")
def brier_logloss(spark, d):
    return rounded(evaluate.probability_metrics(scored(spark, d), "label", "score"), {"brier_score": 6, "log_loss": 6})


@query("metrics_compact", f"""
WITH s AS ({SCORED}), {_CONFUSION.format(t=0.25)}, {RANKED},
m AS (SELECT a.*, b.*, {_RATES}, CAST(0.25 AS DOUBLE) AS threshold_used FROM a, b, c)
SELECT * FROM (SELECT roc_auc, pr_auc, brier_score, log_loss, precision, recall, f1, threshold_used FROM m)
UNPIVOT (value FOR metric IN (roc_auc, pr_auc, brier_score, log_loss, precision, recall, f1, threshold_used))""")
def metrics_compact(spark, d):
    compact = evaluate.compact_metrics(scored(spark, d), "label", "score", 0.25)
    return rounded(evaluate.as_metric_rows(compact), {"value": 6})


# positions int(i * (count - 1) / (m - 1)) of an even grid over the curve
_PICK = """
p AS (SELECT DISTINCT CAST(floor(CASE WHEN i = least(200, n) - 1 THEN n - 1
                                      ELSE i * ((n - 1) / (least(200, n) - 1)::DOUBLE) END) AS BIGINT) AS idx
      FROM (SELECT count(*) AS n FROM curve), range(0, 200) t(i) WHERE i < least(200, n))"""


@query("roc_curve", f"""
WITH s AS ({SCORED}), {RANKED},
t AS (SELECT max(cp) AS p, max(cn) AS n FROM r),
kept AS (SELECT score, cp, cn, row_number() OVER (ORDER BY score DESC) AS idx FROM r
         WHERE np IS NULL OR np <> pos OR nn <> neg),
curve AS (SELECT idx, cn / t.n AS fpr, cp / t.p AS tpr, score AS threshold FROM kept, t
          UNION ALL SELECT 0, 0, 0, NULL), {_PICK}
SELECT curve.idx, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr, round(threshold, 6) AS threshold
FROM curve JOIN p ON curve.idx = p.idx""")
def roc_curve(spark, d):
    return rounded(evaluate.roc_points(scored(spark, d), "label", "score"), {"fpr": 6, "tpr": 6, "threshold": 6})


@query("pr_curve", f"""
WITH s AS ({SCORED}), {RANKED},
t AS (SELECT max(cp) AS p, max(cp) + max(cn) AS n, count(*) AS k FROM r),
curve AS (SELECT k - i AS idx, cp / (cp + cn) AS precision, cp / t.p AS recall, score AS threshold FROM r, t
          UNION ALL SELECT k, 1, 0, NULL FROM t), {_PICK}
SELECT curve.idx, round(precision, 6) AS precision, round(recall, 6) AS recall, round(threshold, 6) AS threshold,
       round(t.p / t.n, 6) AS baseline
FROM curve JOIN p ON curve.idx = p.idx, t""")
def pr_curve(spark, d):
    points = evaluate.pr_points(scored(spark, d), "label", "score")
    return rounded(points, {c: 6 for c in ("precision", "recall", "threshold", "baseline")})


_SWEEP = f"""
WITH s AS ({SCORED}),
grid AS (SELECT CASE WHEN i = 199 THEN 0.99::DOUBLE ELSE i * ((0.99::DOUBLE - 0.01::DOUBLE) / 199) + 0.01::DOUBLE END AS t
         FROM range(0, 200) x(i)),
n AS (SELECT t, sum(CASE WHEN score >= t AND label = 1 THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN score >= t AND label = 0 THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN score < t AND label = 1 THEN 1 ELSE 0 END) AS fn,
             sum(CASE WHEN score < t AND label = 0 THEN 1 ELSE 0 END) AS tn FROM s, grid GROUP BY t),
q AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS pr, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS re
      FROM n),
f AS (SELECT *, CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END AS f1, fp + 5 * fn AS cost FROM q)"""


@query("threshold_sweep", _SWEEP + """
SELECT round(t, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
       CAST(tn AS BIGINT) AS tn, round(pr, 6) AS precision, round(re, 6) AS recall, round(f1, 6) AS f1,
       CAST(cost AS DOUBLE) AS cost FROM f""")
def threshold_sweep(spark, d):
    sweep = evaluate.threshold_sweep(scored(spark, d), "label", "score")
    return rounded(sweep, {"threshold": 6, "precision": 6, "recall": 6, "f1": 6})


@query("threshold_candidates", _SWEEP + """
SELECT 'default' AS strategy, CAST(0.5 AS DOUBLE) AS threshold
UNION ALL SELECT 'f1_optimal', round((SELECT t FROM f ORDER BY f1 DESC, t LIMIT 1), 6)
UNION ALL SELECT 'cost_optimal', round((SELECT t FROM f ORDER BY cost, t LIMIT 1), 6)
UNION ALL SELECT 'recall_geq_60pct', round(coalesce((SELECT max(t) FROM f WHERE re >= 0.6), 0.5), 6)""")
def threshold_candidates(spark, d):
    found = evaluate.threshold_candidates(scored(spark, d), "label", "score")
    return spark.createDataFrame([(n, round(t, 6)) for n, t in found.items()], "strategy string, threshold double")


_CHOSEN = {"default": 0.5, "f1_optimal": 0.14789, "cost_optimal": 0.15774, "recall_geq_60pct": 0.09864}


def _strategy_sql(name: str, t: float) -> str:
    return f"""SELECT '{name}' AS strategy, CAST({t} AS DOUBLE) AS threshold,
    sum(CASE WHEN score >= {t} AND label = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN score >= {t} AND label = 0 THEN 1 ELSE 0 END) AS fp,
    sum(CASE WHEN score < {t} AND label = 1 THEN 1 ELSE 0 END) AS fn, sum(CASE WHEN score < {t} AND label = 0 THEN 1 ELSE 0 END) AS tn,
    avg(pow(score - label, 2)) AS brier FROM s"""


@query("threshold_table", f"""
WITH s AS ({SCORED}), n AS ({" UNION ALL ".join(_strategy_sql(n, t) for n, t in _CHOSEN.items())})
SELECT strategy, round(threshold, 4) AS threshold, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 4) AS precision,
       round(tp / (tp + fn), 4) AS recall, round(tn / (tn + fp), 4) AS specificity, round(2 * tp / (2 * tp + fp + fn), 4) AS f1,
       CAST(fp AS BIGINT) AS false_positives, CAST(fn AS BIGINT) AS false_negatives, round(brier, 4) AS brier_score,
       round((tp + fp) / (tp + fp + fn + tn), 4) AS predicted_positive_rate, strategy = 'f1_optimal' AS selected
FROM n""")
def threshold_table(spark, d):
    return evaluate.threshold_table(scored(spark, d), "label", "score", _CHOSEN)


_CALIBRATION = f"""
WITH s AS ({SCORED}),
c AS (SELECT {" + ".join(f"CAST(score > {i} / 10.0::DOUBLE AS INT)" for i in range(1, 10))} AS bin,
             avg(score) AS mean_predicted, avg(label) AS fraction_positive, count(*) AS n FROM s GROUP BY 1)"""


@query("calibration_curve", _CALIBRATION + """
SELECT bin, round(mean_predicted, 6) AS mean_predicted, round(fraction_positive, 6) AS fraction_positive, n FROM c""")
def calibration_curve(spark, d):
    curve = evaluate.calibration_curve(scored(spark, d), "label", "score")
    return rounded(curve, {"mean_predicted": 6, "fraction_positive": 6})


@query("ece", _CALIBRATION + "SELECT round(sum(n * abs(fraction_positive - mean_predicted)) / sum(n), 6) AS ece FROM c")
def ece(spark, d):
    return rounded(evaluate.calibration_error(scored(spark, d), "label", "score"), {"ece": 6})
