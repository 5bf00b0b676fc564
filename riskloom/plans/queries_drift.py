"""Drift between periods: lineitems before and after 1999, events per week."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import drift
from riskloom.plans.catalog import query, rounded, table
from riskloom.plans.queries_evaluate import SCORED, scored

_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "late_tax"]

# The late period drifts by rule: its tax is three hundredths higher.
_SIDES = """
SELECT l_shipdate < TIMESTAMP '1999-01-01' AS is_ref, l_quantity, l_extendedprice, l_discount + 0.0 AS l_discount,
       CASE WHEN l_shipdate < TIMESTAMP '1999-01-01' THEN l_tax + 0.0 ELSE l_tax + 0.03 END AS late_tax
FROM lineitem"""


def _sides(spark, d):
    is_ref = F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    rows = table(spark, d, "lineitem").select(
        is_ref.alias("is_ref"),
        "l_quantity",
        "l_extendedprice",
        (F.col("l_discount") + 0.0).alias("l_discount"),
        F.when(is_ref, F.col("l_tax") + 0.0).otherwise(F.col("l_tax") + 0.03).alias("late_tax"),
        "l_returnflag",
    )
    return rows.where("is_ref"), rows.where(~F.col("is_ref"))


def _long_sql(rows: str, features) -> str:
    return " UNION ALL ".join(f"SELECT '{f}' AS feature, is_ref, CAST({f} AS DOUBLE) AS v FROM ({rows})" for f in features)


_INNER = ", ".join(f"CASE WHEN v >= lo + {i} * ((hi - lo) / 10) THEN 1 ELSE 0 END AS e{i}" for i in range(1, 10))
_PSI = f"""
w AS (SELECT feature, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
             CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM x WHERE is_ref GROUP BY feature),
e AS (SELECT feature, is_ref, {" + ".join(f"e{i}" for i in range(1, 10))} AS bin
      FROM (SELECT x.feature, is_ref, {_INNER} FROM x JOIN w ON x.feature = w.feature)),
t AS (SELECT feature, count(*) FILTER (WHERE is_ref) AS rn, count(*) FILTER (WHERE NOT is_ref) AS cn FROM x GROUP BY feature),
k AS (SELECT t.feature, rn, cn, b.bin, count(e.bin) FILTER (WHERE is_ref) AS r, count(e.bin) FILTER (WHERE NOT is_ref) AS c
      FROM t CROSS JOIN range(0, 10) b(bin) LEFT JOIN e ON e.feature = t.feature AND e.bin = b.bin GROUP BY 1, 2, 3, 4),
psi AS (SELECT feature, rn, cn,
               sum(((c + 1e-6) / (cn + 1e-5) - (r + 1e-6) / (rn + 1e-5)) * ln(((c + 1e-6) / (cn + 1e-5)) / ((r + 1e-6) / (rn + 1e-5)))) AS psi
        FROM k GROUP BY 1, 2, 3)"""
_STATUS = "CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'moderate_shift' ELSE 'significant_shift' END"
_CDF = """
vals AS (SELECT feature, v, count(*) FILTER (WHERE is_ref) AS r, count(*) FILTER (WHERE NOT is_ref) AS c FROM x GROUP BY 1, 2),
cdf AS (SELECT feature, v, lead(v) OVER (PARTITION BY feature ORDER BY v) AS nv,
               abs(sum(r) OVER (PARTITION BY feature ORDER BY v) / sum(r) OVER (PARTITION BY feature)
                 - sum(c) OVER (PARTITION BY feature ORDER BY v) / sum(c) OVER (PARTITION BY feature)) AS gap,
               sum(r) OVER (PARTITION BY feature) AS rn, sum(c) OVER (PARTITION BY feature) AS cn
        FROM vals),
dist AS (SELECT feature, rn, cn, max(gap) AS d, sum(gap * (nv - v)) AS w1 FROM cdf GROUP BY 1, 2, 3),
tail AS (SELECT feature, d, w1, d * sqrt(rn * cn / (rn + cn)) AS z FROM dist),
ks AS (SELECT tail.feature, d, w1,
              CASE WHEN max(z) <= 0.05 THEN 1
                   WHEN max(z) < 1 THEN 1 - sqrt(2 * pi()) / max(z) * sum(exp(-pow(2 * i - 1, 2) * pi() * pi() / 8 / (z * z)))
                   ELSE greatest(least(sum((CASE WHEN i % 2 = 1 THEN 2 ELSE -2 END) * exp(-2 * i * i * z * z)), 1), 0) END AS p
       FROM tail, range(1, 21) t(i) GROUP BY 1, 2, 3)"""


@query("psi", f"""
WITH x AS ({_long_sql(_SIDES, _FEATURES)}), {_PSI}
SELECT feature, round(psi, 6) AS psi, {_STATUS} AS psi_status, rn AS reference_n, cn AS current_n FROM psi""")
def psi(spark, d):
    return rounded(drift.population_stability(*_sides(spark, d), _FEATURES), {"psi": 6})


_FAR = ["spiked", "gappy"]
_FAR_SIDES = """
SELECT l_shipdate < TIMESTAMP '1999-01-01' AS is_ref,
       CASE WHEN l_linenumber = 7 AND l_shipdate >= TIMESTAMP '1999-01-01' THEN l_extendedprice * 1e15 ELSE l_extendedprice END AS spiked,
       CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END AS gappy
FROM lineitem"""


@query("psi_far_values", f"""
WITH x AS (SELECT * FROM ({_long_sql(_FAR_SIDES, _FAR)}) WHERE v IS NOT NULL), {_PSI}
SELECT feature, round(psi, 6) AS psi, {_STATUS} AS psi_status, rn AS reference_n, cn AS current_n FROM psi""")
def psi_far_values(spark, d):
    """Current values that lie any distance outside the reference, and NaN on both sides."""
    is_ref = F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    rows = table(spark, d, "lineitem").select(
        is_ref.alias("is_ref"),
        F.when((F.col("l_linenumber") == 7) & ~is_ref, F.col("l_extendedprice") * 1e15).otherwise(F.col("l_extendedprice")).alias("spiked"),
        F.when(F.col("l_linenumber") == 1, float("nan")).otherwise(F.col("l_quantity").cast("double")).alias("gappy"),
    )
    return rounded(drift.population_stability(rows.where("is_ref"), rows.where(~F.col("is_ref")), _FAR), {"psi": 6})


@query("ks", f"""
WITH x AS ({_long_sql(_SIDES, _FEATURES)}), {_CDF}
SELECT feature, round(d, 6) AS ks_statistic, round(p, 6) AS ks_p_value_asymptotic, p < 0.05 AS ks_significant FROM ks""")
def ks(spark, d):
    out = drift.two_sample_distances(*_sides(spark, d), _FEATURES)
    return rounded(out.drop("wasserstein_distance"), {"ks_statistic": 6, "ks_p_value_asymptotic": 6})


@query("ks_exact", """
WITH RECURSIVE x AS (SELECT s_acctbal AS v, s_suppkey % 2 = 0 AS is_ref FROM supplier WHERE s_acctbal IS NOT NULL),
n AS (SELECT count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c FROM x),
g AS (SELECT v, sum(count(*) FILTER (is_ref)) OVER (ORDER BY v) AS a, sum(count(*) FILTER (NOT is_ref)) OVER (ORDER BY v) AS b
      FROM x GROUP BY v),
s AS (SELECT r, c, CAST(max(abs(a * c - b * r)) AS BIGINT) AS h FROM g, n GROUP BY r, c),
walk(k, i, p) AS (
  SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS DOUBLE)
  UNION ALL
  SELECT k, i, CASE WHEN abs(i * c - (k - i) * r) >= h THEN 1.0 ELSE sum(share) END
  FROM (SELECT k + 1 AS k, i + up AS i, p * CASE WHEN up = 1 THEN i + 1 ELSE k + 1 - i END / (k + 1) AS share, r, c, h
        FROM walk, s, (VALUES (0), (1)) step(up) WHERE i + up <= r AND k + 1 - i - up <= c)
  GROUP BY k, i, r, c, h)
SELECT 's_acctbal' AS feature, round(h / (r * c), 6) AS ks_statistic, r AS reference_n, c AS current_n, round(p, 6) AS ks_p_value,
       true AS ks_p_exact, p < 0.05 AS ks_significant
FROM walk, s WHERE k = r + c""")
def ks_exact(spark, d):
    """Small samples: the balances of two halves of the suppliers, with the exact p-value."""
    rows = table(spark, d, "supplier").select((F.col("s_suppkey") % 2 == 0).alias("is_ref"), F.col("s_acctbal").cast("double").alias("s_acctbal"))
    ref, cur = rows.where("is_ref"), rows.where(~F.col("is_ref"))
    told = drift.exact_significance(
        drift.two_sample_distances(ref, cur, ["s_acctbal"]), drift.population_stability(ref, cur, ["s_acctbal"]))
    out = told.select("feature", "ks_statistic", "reference_n", "current_n", "ks_p_value", "ks_p_exact", "ks_significant")
    return rounded(out, {"ks_statistic": 6, "ks_p_value": 6})


@query("wasserstein", f"""
WITH x AS ({_long_sql(_SIDES, _FEATURES)}), {_CDF} SELECT feature, round(w1, 6) AS wasserstein_distance FROM ks""")
def wasserstein(spark, d):
    out = drift.two_sample_distances(*_sides(spark, d), _FEATURES)
    return rounded(out.select("feature", "wasserstein_distance"), {"wasserstein_distance": 6})


_REPORT_PLACES = {"psi": 6, "ks_statistic": 6, "ks_p_value_asymptotic": 6, "wasserstein_distance": 6}


@query("feature_drift_report", f"""
WITH x AS ({_long_sql(_SIDES, _FEATURES)}), {_PSI}, {_CDF}
SELECT psi.feature, round(psi, 6) AS psi, {_STATUS} AS psi_status, rn AS reference_n, cn AS current_n,
       round(d, 6) AS ks_statistic, round(p, 6) AS ks_p_value_asymptotic, p < 0.05 AS ks_significant,
       round(w1, 6) AS wasserstein_distance
FROM psi JOIN ks ON psi.feature = ks.feature
UNION ALL SELECT 'l_returnflag', NULL, 'skipped_non_numeric', NULL, NULL, NULL, NULL, NULL, NULL""")
def feature_drift_report(spark, d):
    return rounded(drift.drift_report(*_sides(spark, d), [*_FEATURES, "l_returnflag", "not_there"]), _REPORT_PLACES)


@query("drift_alerts", f"""
WITH x AS ({_long_sql(_SIDES, _FEATURES)}), {_PSI}
SELECT {_STATUS} AS psi_status, count(*) AS n_features, string_agg(feature, ', ' ORDER BY psi DESC, feature) AS features
FROM psi GROUP BY 1""")
def drift_alerts(spark, d):
    alerts = drift.drift_alerts(drift.population_stability(*_sides(spark, d), _FEATURES))
    return alerts.withColumn("features", F.array_join("features", ", "))


_SCORE_SIDES = f"SELECT ts < TIMESTAMP '2024-01-16' AS is_ref, score FROM ({SCORED})"


def _stats_sql(side: str, condition: str) -> str:
    p = f"FILTER (WHERE {condition})"
    return f"""round(avg(score) {p}, 6) AS {side}_mean, round(stddev_pop(score) {p}, 6) AS {side}_std,
    round(quantile_cont(score, 0.1) {p}, 6) AS {side}_p10, round(quantile_cont(score, 0.5) {p}, 6) AS {side}_p50,
    round(quantile_cont(score, 0.9) {p}, 6) AS {side}_p90,
    round(avg(CAST(score >= 0.5 AS INT)) {p}, 6) AS {side}_predicted_positive_rate, count(score) {p} AS {side}_n"""


@query("prediction_drift", f"""
WITH x AS ({_long_sql(_SCORE_SIDES, ["score"])}), {_PSI}, {_CDF},
st AS (SELECT {_stats_sql("reference", "is_ref")}, {_stats_sql("current", "NOT is_ref")} FROM ({_SCORE_SIDES}))
SELECT 'score' AS score, round(psi, 6) AS psi, {_STATUS} AS psi_status, round(d, 6) AS ks_statistic,
       round(p, 6) AS ks_p_value_asymptotic, p < 0.05 AS ks_significant, round(w1, 6) AS wasserstein_distance, st.*
FROM psi, ks, st""")
def prediction_drift(spark, d):
    rows = scored(spark, d)
    split = F.lit("2024-01-16").cast("timestamp_ntz")
    out = drift.prediction_drift(rows.where(F.col("ts") < split), rows.where(F.col("ts") >= split), "score")
    stats = [c for c in out.columns if c.startswith(("reference_", "current_")) and not c.endswith("_n")]
    return rounded(out, {**_REPORT_PLACES, **{c: 6 for c in stats}})


@query("weekly_monitor", f"""
WITH s AS (SELECT CAST(date_trunc('week', ts) AS DATE) AS week, label, score FROM ({SCORED})),
f AS (SELECT min(week) AS fw FROM s),
v AS (SELECT week, count(*) AS volume, avg(score) AS mean_score, avg(CAST(score >= 0.5 AS INT)) AS rate FROM s GROUP BY 1),
b AS (SELECT min(score) AS lo, max(score) AS hi, count(*) AS rn FROM s, f WHERE week = fw),
e AS (SELECT week, {" + ".join(f"CASE WHEN score >= lo + {i} * ((hi - lo) / 10) THEN 1 ELSE 0 END" for i in range(1, 10))} AS bin FROM s, b),
k AS (SELECT v.week, volume AS cn, rn, g.bin, (SELECT count(*) FROM e, f WHERE e.week = fw AND e.bin = g.bin) AS r,
             (SELECT count(*) FROM e WHERE e.week = v.week AND e.bin = g.bin) AS c FROM v, b, range(0, 10) g(bin)),
psi AS (SELECT week,
               sum(((c + 1e-6) / (cn + 1e-5) - (r + 1e-6) / (rn + 1e-5)) * ln(((c + 1e-6) / (cn + 1e-5)) / ((r + 1e-6) / (rn + 1e-5)))) AS psi
        FROM k GROUP BY 1),
u AS (SELECT v.week, s.score, CASE WHEN s.week = fw THEN 1 ELSE 0 END AS r, CASE WHEN s.week = v.week THEN 1 ELSE 0 END AS c
      FROM v, f, s WHERE s.week = fw OR s.week = v.week),
ug AS (SELECT week, score, sum(r) AS r, sum(c) AS c FROM u GROUP BY 1, 2),
ks AS (SELECT week, max(gap) AS d FROM (
         SELECT week, abs(sum(r) OVER (PARTITION BY week ORDER BY score) / sum(r) OVER (PARTITION BY week)
                        - sum(c) OVER (PARTITION BY week ORDER BY score) / sum(c) OVER (PARTITION BY week)) AS gap FROM ug) GROUP BY 1),
g AS (SELECT week, score, sum(label) AS pos, count(*) - sum(label) AS neg FROM s GROUP BY 1, 2),
rk AS (SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cg FROM g WINDOW w AS (PARTITION BY week ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
q AS (SELECT week, sum(neg * (cp - pos + pos / 2)) / (sum(pos)::DOUBLE * sum(neg)) AS roc_auc, sum(pos * cp / (cp + cg)) / sum(pos) AS pr_auc
      FROM rk GROUP BY 1),
cm AS (SELECT week, sum(CASE WHEN score >= 0.5 AND label = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN score >= 0.5 AND label = 0 THEN 1 ELSE 0 END) AS fp,
              sum(CASE WHEN score < 0.5 AND label = 1 THEN 1 ELSE 0 END) AS fn, avg(pow(score - label, 2)) AS brier FROM s GROUP BY 1),
cal AS (SELECT week, {" + ".join(f"CAST(score > {i} / 10.0::DOUBLE AS INT)" for i in range(1, 10))} AS bin,
               avg(score) AS mp, avg(label) AS fpos, count(*) AS n FROM s GROUP BY 1, 2),
ece AS (SELECT week, sum(n * abs(fpos - mp)) / sum(n) AS ece FROM cal GROUP BY 1)
SELECT v.week, volume, round(mean_score, 6) AS mean_score, round(rate, 6) AS predicted_positive_rate, round(psi, 6) AS psi,
       {_STATUS} AS psi_status, round(d, 6) AS ks_statistic, CASE WHEN psi > 0.1 THEN 'drift_detected' END AS alert,
       round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall, round(brier, 6) AS brier_score, round(ece, 6) AS ece
FROM v JOIN psi ON v.week = psi.week JOIN ks ON v.week = ks.week JOIN q ON v.week = q.week JOIN cm ON v.week = cm.week
JOIN ece ON v.week = ece.week""")
def weekly_monitor(spark, d):
    out = drift.weekly_monitor(scored(spark, d), "ts", "score", "label")
    return rounded(out, {c: 6 for c in (
        "mean_score", "predicted_positive_rate", "psi", "ks_statistic", "roc_auc", "pr_auc", "f1", "precision", "recall",
        "brier_score", "ece",
    )})
