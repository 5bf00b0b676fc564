"""Models on orders: which orders are large, seen through noise.

The label is planted by a rule on the price with about a fifth of the rows
flipped by a hash, so a model has something to learn and a ceiling to hit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.operators import calibrate, explain, model
from riskloom.operators.evaluate import full_metrics
from riskloom.operators.rollup import RollupSpec, rollup
from riskloom.operators.split import train_valid_test
from riskloom.operators.state import Preprocessor, fit_standard
from riskloom.functions.scalars import predicted_class, risk_band
from riskloom.plans.catalog import query, rounded, table
from riskloom.plans.queries_evaluate import SCORED, scored
from riskloom.plans.queries_features import allocate_sql
from riskloom.session import stage

_LINE_STATS = RollupSpec("l_orderkey", "LINE", {
    "l_quantity": ["count", "mean", "max"],
    "l_discount": ["mean"],
    "l_extendedprice": ["sum"],
})
_NUMERIC = ["price", "age", "LINE_l_quantity_COUNT", "LINE_l_quantity_MEAN", "LINE_l_discount_MEAN", "LINE_l_extendedprice_SUM"]
_CATEGORICAL = ["o_orderpriority", "o_orderstatus"]
_KEY = "o_orderkey"
_SMALL_BOOSTER = {"n_estimators": 10, "learning_rate": 0.2, "max_depth": 4, "num_leaves": 16, "min_data_in_leaf": 20}


def applications(spark, d) -> DataFrame:
    lines = rollup(table(spark, d, "lineitem"), _LINE_STATS).withColumnRenamed("l_orderkey", _KEY)
    flip = F.conv(F.substring(F.md5(F.col(_KEY).cast("string")), 1, 2), 16, 10).cast("int") < 51
    large = F.col("o_totalprice") > 250000
    base = table(spark, d, "orders").select(
        _KEY,
        (large != flip).cast("int").alias("label"),
        (F.col("o_totalprice") / 1000).alias("price"),
        F.datediff(F.lit("2002-01-01").cast("date"), "o_orderdate").cast("double").alias("age"),
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("o_orderpriority"),
        "o_orderstatus",
    )
    return base.join(lines, _KEY, "left")


def prepared(spark, d) -> tuple[DataFrame, list[str]]:
    """Split and preprocessed rows. Fits read them many times, so both steps are staged."""
    rows = stage(train_valid_test(stage(applications(spark, d)), _KEY, "label"))
    pre = Preprocessor(_NUMERIC, _CATEGORICAL).fit(rows.where(F.col("part") == "train"))
    return stage(pre.transform(rows, keep=[_KEY, "label", "part"])), pre.outputs


def _parts(matrix: DataFrame, features: list[str]) -> dict[str, DataFrame]:
    assembled = model.assemble(matrix, features, [_KEY, "label", "part"])
    return {p: assembled.where(F.col("part") == p).drop("part") for p in ("train", "valid", "test")}


_POWERS = {
    "price": 0.5, "age": 0.0, "LINE_l_quantity_COUNT": 1.0, "LINE_l_quantity_MEAN": 2.0, "LINE_l_discount_MEAN": -0.5,
    "LINE_l_extendedprice_SUM": 0.25,
}
_FLIP = "CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 2) AS INTEGER) < 51"
_APPLICATIONS = f"""
l AS (SELECT l_orderkey, count(l_quantity) AS "LINE_l_quantity_COUNT", avg(l_quantity) AS "LINE_l_quantity_MEAN",
             avg(l_discount) AS "LINE_l_discount_MEAN", sum(l_extendedprice) AS "LINE_l_extendedprice_SUM" FROM lineitem GROUP BY 1),
a AS (SELECT o_orderkey, CAST((o_totalprice > 250000) <> ({_FLIP}) AS INT) AS label, o_totalprice / 1000 AS price,
             CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS DOUBLE) AS age,
             nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority, o_orderstatus, l.* EXCLUDE (l_orderkey)
      FROM orders LEFT JOIN l ON o_orderkey = l_orderkey),
r AS (SELECT o_orderkey, label, row_number() OVER (PARTITION BY label ORDER BY md5(concat(o_orderkey, ':42')), o_orderkey) AS rk FROM a),
s0 AS (SELECT label, count(*) AS size FROM a GROUP BY label),
n0 AS (SELECT sum(size) AS n FROM s0)""" + allocate_sql(0, "0.15::DOUBLE * n") + allocate_sql(1, "0.15::DOUBLE / 0.85::DOUBLE * n") + """,
parts AS (SELECT o_orderkey, rk > k0.take + k1.take AS train FROM r JOIN k0 ON r.label = k0.label JOIN k1 ON r.label = k1.label),
x AS (SELECT a.*, train FROM a JOIN parts ON a.o_orderkey = parts.o_orderkey)"""


def _powered_sql(c: str) -> str:
    p = _POWERS[c]
    up = f"ln(1 + f_{c})" if p == 0 else f"(pow(1 + f_{c}, {p}) - 1) / {p}"
    down = f"-ln(1 - f_{c})" if p == 2 else f"-(pow(1 - f_{c}, {2 - p}) - 1) / {2 - p}"
    return f"CASE WHEN f_{c} >= 0 THEN {up} ELSE {down} END"


_MATRIX_SQL = f"""
WITH {_APPLICATIONS},
med AS (SELECT {", ".join(f'quantile_cont(CAST("{c}" AS DOUBLE), 0.5) AS m_{c}' for c in _NUMERIC)} FROM x WHERE train),
filled AS (SELECT x.*, {", ".join(f'coalesce(CAST("{c}" AS DOUBLE), m_{c}) AS f_{c}' for c in _NUMERIC)} FROM x, med),
powered AS (SELECT *, {", ".join(f"{_powered_sql(c)} AS p_{c}" for c in _NUMERIC)} FROM filled),
fit AS (SELECT {", ".join(f"avg(p_{c}) AS a_{c}, stddev_pop(p_{c}) AS s_{c}" for c in _NUMERIC)} FROM powered WHERE train),
mode AS (SELECT o_orderpriority AS top FROM x WHERE train AND o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT o_orderkey, {", ".join(f'round((p_{c} - a_{c}) / s_{c}, 6) + 0.0 AS "num__{c}"' for c in _NUMERIC)},
       {", ".join(f"CAST(coalesce(o_orderpriority, top) = '{v}' AS INT)::DOUBLE AS \"cat__o_orderpriority_{v}\"" for v in ("2-HIGH", "3-MEDIUM", "5-LOW"))},
       {", ".join(f"CAST(o_orderstatus = '{v}' AS INT)::DOUBLE AS \"cat__o_orderstatus_{v}\"" for v in "OP")}
FROM powered, fit, mode"""


@query("preprocessed_matrix", _MATRIX_SQL)
def preprocessed_matrix(spark, d):
    """Fitted on the train part, with the powers of an earlier run."""
    rows = stage(train_valid_test(stage(applications(spark, d)), _KEY, "label"))
    pre = Preprocessor(_NUMERIC, _CATEGORICAL, powers=dict(_POWERS)).fit(rows.where(F.col("part") == "train"))
    return rounded(pre.transform(rows, keep=[_KEY]), {f"num__{c}": 6 for c in _NUMERIC})


@query("model_scores")
def model_scores(spark, d):
    matrix, features = prepared(spark, d)
    parts = _parts(matrix, features)
    fitted = model.fit_booster(parts["train"], "label", _SMALL_BOOSTER, valid=parts["valid"])
    scored = model.with_probability(fitted, parts["test"], [_KEY])
    return scored.select(
        _KEY,
        F.round("score", 6).alias("probability"),
        predicted_class(F.col("score"), F.lit(0.5)).alias("predicted_class"),
        risk_band(F.col("score")).alias("risk_category"),
    )


@query("model_comparison")
def model_comparison(spark, d):
    matrix, features = prepared(spark, d)
    parts = _parts(matrix, features)
    return model.compare_models(parts["train"], parts["valid"], "label", model.default_contenders("label"))


@query("baseline_logistic")
def baseline_logistic(spark, d):
    matrix, features = prepared(spark, d)
    parts = _parts(matrix, features)
    fitted = model.fit_logistic(parts["train"], "label", inverse_penalty=0.0001)
    return full_metrics(model.with_probability(fitted, parts["test"], ["label"]), "label", "score")


@query("param_search")
def param_search(spark, d):
    matrix, features = prepared(spark, d)
    parts = _parts(matrix, features)
    space = [("n_estimators", 3, 8, "int"), ("learning_rate", 0.05, 0.3, "log"), ("max_depth", 2, 4, "int")]
    found = model.search_params(parts["train"], parts["valid"], "label", model.random_params(3, space=space))
    return found.table(spark)


@query("feature_importance")
def feature_importance(spark, d):
    matrix, features = prepared(spark, d)
    fitted = model.fit_booster(_parts(matrix, features)["train"], "label", _SMALL_BOOSTER)
    return model.importance_table(fitted, features, spark)


@query("feature_count_sweep")
def feature_count_sweep(spark, d):
    matrix, features = prepared(spark, d)
    train, valid = (matrix.where(F.col("part") == p) for p in ("train", "valid"))
    quick = {**_SMALL_BOOSTER, "n_estimators": 5}
    ranked = model.rank_features(model.fit_booster(_parts(matrix, features)["train"], "label", quick), features)
    swept, _ = model.sweep_feature_counts(train, valid, "label", ranked, [2, 5, len(features)], quick)
    return swept


_CALIBRATED = 4

# Newton steps for two weights from zero; rows that share a score share a weight.
_STEPS = 12


def _newton_sql(k: int) -> str:
    return f"""
g{k} AS (SELECT a, b, sum(w1 - (w1 + w0) * p) AS gb, sum((w1 - (w1 + w0) * p) * x) AS ga, sum((w1 + w0) * p * (1 - p)) AS hb,
                sum((w1 + w0) * p * (1 - p) * x) AS hab, sum((w1 + w0) * p * (1 - p) * x * x) AS ha
         FROM (SELECT *, 1 / (1 + exp(-(a * x + b))) AS p FROM t, b{k - 1}) GROUP BY a, b),
b{k} AS (SELECT a + (hb * ga - hab * gb) / (ha * hb - hab * hab) AS a, b + (ha * gb - hab * ga) / (ha * hb - hab * hab) AS b FROM g{k})"""


_HALVES = f"""
s AS (SELECT event_id, label, score FROM ({SCORED})),
w AS (SELECT score AS x, sum(label) AS pos, sum(1 - label) AS neg FROM s WHERE event_id % 2 = 0 GROUP BY 1)"""
_SIGMOID = f"""
u AS (SELECT (sum(pos) + 1.0) / (sum(pos) + 2.0) AS hi, 1.0 / (sum(neg) + 2.0) AS lo FROM w),
t AS (SELECT x, pos * hi + neg * lo AS w1, pos * (1 - hi) + neg * (1 - lo) AS w0 FROM w, u),
b0 AS (SELECT CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b), {", ".join(_newton_sql(k) for k in range(1, _STEPS + 1))},
sig AS (SELECT event_id, label, score, 1 / (1 + exp(-(a * score + b))) AS sigmoid FROM s, b{_STEPS} WHERE event_id % 2 = 1)"""
# the isotonic fit at a score is the largest, over starts before it, of the smallest mean up to an end after it
_ISOTONIC = """
c AS (SELECT x, row_number() OVER (ORDER BY x) AS i, sum(pos) OVER (ORDER BY x) AS cp, sum(pos + neg) OVER (ORDER BY x) AS cn, pos, neg FROM w),
m AS (SELECT j.i AS j, k.i AS i, (k.cp - j.cp + j.pos) / CAST(k.cn - j.cn + j.pos + j.neg AS DOUBLE) AS mean FROM c j JOIN c k ON k.i >= j.i),
low AS (SELECT j, i, min(mean) OVER (PARTITION BY j ORDER BY i DESC) AS v FROM m),
iso AS (SELECT c.x, f FROM (SELECT i, max(v) AS f FROM low GROUP BY 1) h JOIN c ON c.i = h.i),
q AS (SELECT DISTINCT score FROM s WHERE event_id % 2 = 1),
near AS (SELECT score, max(CASE WHEN x <= score THEN x END) AS x0, min(CASE WHEN x >= score THEN x END) AS x1 FROM q, iso GROUP BY 1),
fitted AS (SELECT score, CASE WHEN x0 IS NULL THEN r.f WHEN x1 IS NULL OR x0 = x1 THEN l.f
                          ELSE l.f + (r.f - l.f) * (score - x0) / (x1 - x0) END AS isotonic
       FROM near LEFT JOIN iso l ON l.x = x0 LEFT JOIN iso r ON r.x = x1)"""


def _scored_halves(spark, d) -> tuple[DataFrame, DataFrame]:
    """Scored events in two halves: one to fit a calibrator, one to judge it."""
    rows = scored(spark, d).select("event_id", "label", "score")
    return rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1")


@query("platt_calibration", f"""
WITH {_HALVES}, {_SIGMOID} SELECT event_id, label, round(score, 9) AS score, round(sigmoid, {_CALIBRATED}) AS calibrated FROM sig""")
def platt_calibration(spark, d):
    fit_rows, judge_rows = _scored_halves(spark, d)
    return rounded(calibrate.fit_sigmoid(fit_rows, "label", "score").apply(judge_rows, "score"), {"score": 9, "calibrated": _CALIBRATED})


@query("isotonic_calibration", f"""
WITH {_HALVES}, {_ISOTONIC}
SELECT event_id, label, round(s.score, 9) AS score, round(isotonic, {_CALIBRATED}) AS calibrated FROM s JOIN fitted ON s.score = fitted.score WHERE event_id % 2 = 1""")
def isotonic_calibration(spark, d):
    fit_rows, judge_rows = _scored_halves(spark, d)
    return rounded(calibrate.fit_isotonic(fit_rows, "label", "score").apply(judge_rows, "score"), {"score": 9, "calibrated": _CALIBRATED})


@query("calibration_choice", f"""
WITH {_HALVES}, {_SIGMOID}, {_ISOTONIC},
e AS (SELECT avg(pow(score - label, 2)) AS n, avg(pow(sigmoid - label, 2)) AS s, avg(pow(isotonic - label, 2)) AS i
      FROM (SELECT sig.*, isotonic FROM sig JOIN fitted ON sig.score = fitted.score)),
v AS (SELECT 'none' AS method, n AS b, n FROM e UNION ALL SELECT 'sigmoid', s, n FROM e UNION ALL SELECT 'isotonic', i, n FROM e),
best AS (SELECT CASE WHEN min(n) - min(b) > {calibrate.MIN_GAIN} * min(n) THEN arg_min(method, b) ELSE 'none' END AS method FROM v)
SELECT v.method, round(b, {_CALIBRATED}) AS brier_score, v.method = best.method AS selected FROM v, best""")
def calibration_choice(spark, d):
    fit_rows, judge_rows = _scored_halves(spark, d)
    chosen, briers = calibrate.choose_calibrator(fit_rows, judge_rows, "label", "score")
    rows = [(kind, round(value, _CALIBRATED), kind == chosen.kind) for kind, value in briers.items()]
    return spark.createDataFrame(rows, "method string, brier_score double, selected boolean")


@query("tree_attribution")
def tree_attribution(spark, d):
    matrix, features = prepared(spark, d)
    parts = _parts(matrix, features)
    fitted = model.fit_booster(parts["train"], "label", _SMALL_BOOSTER)
    test = matrix.where(F.col("part") == "test")
    explained = explain.tree_attributions(fitted, test, _KEY, features)
    return explain.top_factors(explained, [_KEY], explain.attribution_columns(features))


# --------------------------------------------------------------------------
# explanations of a linear score with given weights

_WEIGHTS = {"l_quantity": 0.0503, "l_discount": -12.1, "l_tax": 7.53, "l_linenumber": -0.207, "unit_price": 0.0}
_VALUES = """
SELECT l_orderkey, l_linenumber AS line, l_quantity, l_discount + 0.0 AS l_discount, l_tax + 0.0 AS l_tax,
       CAST(l_linenumber AS DOUBLE) AS l_linenumber, l_extendedprice / l_quantity AS unit_price, l_partkey, l_suppkey
FROM lineitem"""
_ATTRIBUTIONS = ", ".join(f"{w}::DOUBLE * ({f} - round((SELECT avg({f}) FROM v), 9)) AS a_{f}" for f, w in _WEIGHTS.items())


def _linear(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("line"), "l_partkey", "l_suppkey", "l_quantity",
        (F.col("l_discount") + 0.0).alias("l_discount"), (F.col("l_tax") + 0.0).alias("l_tax"),
        F.col("l_linenumber").cast("double").alias("l_linenumber"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
    )
    means = {c: round(m, 9) for c, (m, _) in fit_standard(rows, list(_WEIGHTS)).items()}
    return rows, explain.linear_attributions(_WEIGHTS, means)


_ID = ["l_orderkey", "line", "l_partkey", "l_suppkey"]


@query("linear_attribution", f"""
WITH v AS ({_VALUES})
SELECT l_orderkey, line, l_partkey, l_suppkey, {", ".join(f"round(a_{f}, 6) + 0.0 AS {f}" for f in _WEIGHTS)}
FROM (SELECT *, {_ATTRIBUTIONS} FROM v)""")
def linear_attribution(spark, d):
    rows, values = _linear(spark, d)
    out = rows.select(*_ID, *[v.alias(f) for f, v in values.items()])
    return rounded(out, {f: 6 for f in values})


def _label_case() -> str:
    return "CASE f " + " ".join(f"WHEN '{f}' THEN '{explain.feature_label(f)}'" for f in _WEIGHTS) + " END"


_FACTOR_ROWS = f"""
v AS ({_VALUES}), w AS (SELECT row_number() OVER () AS id, * FROM v),
a AS (SELECT id, l_orderkey, line, l_partkey, l_suppkey, {_ATTRIBUTIONS.replace("FROM v", "FROM v")} FROM w),
u AS ({" UNION ALL ".join(f"SELECT id, '{f}' AS f, a_{f} AS x FROM a" for f in _WEIGHTS)}),
k AS (SELECT id, f, {_label_case()} AS label, x, row_number() OVER (PARTITION BY id, x > 0 ORDER BY abs(x) DESC, f) AS rk FROM u WHERE x <> 0),
top AS (SELECT id, string_agg(label, '|' ORDER BY rk) FILTER (WHERE x > 0) AS risk,
               string_agg(label, '|' ORDER BY rk) FILTER (WHERE x < 0) AS protective
        FROM k WHERE rk <= 2 GROUP BY id)"""


@query("top_factors", f"""
WITH {_FACTOR_ROWS}
SELECT l_orderkey, line, l_partkey, l_suppkey, coalesce(risk, '') AS risk, coalesce(protective, '') AS protective,
       'MODEL EXPLANATION (not causal reasoning):' || chr(10) || 'Top factors increasing default risk:' || chr(10)
       || coalesce('  • ' || replace(risk, '|', chr(10) || '  • '), '  None') || chr(10)
       || 'Top factors reducing default risk:' || chr(10)
       || coalesce('  • ' || replace(protective, '|', chr(10) || '  • '), '  None') AS text_summary
FROM a LEFT JOIN top ON a.id = top.id""")
def top_factors(spark, d):
    rows, values = _linear(spark, d)
    ranked = explain.top_factors(rows, _ID, values, top=2)
    return ranked.select(
        *_ID,
        F.array_join("top_risk_factors.label", "|").alias("risk"),
        F.array_join("top_protective_factors.label", "|").alias("protective"),
        "text_summary",
    )


@query("global_importance", f"""
WITH v AS ({_VALUES}), a AS (SELECT {_ATTRIBUTIONS} FROM v)
{" UNION ALL ".join(f"SELECT '{f}' AS feature, '{explain.feature_label(f)}' AS label, round(avg(abs(a_{f})), 6) + 0.0 AS mean_abs_attribution FROM a" for f in _WEIGHTS)}""")
def global_importance(spark, d):
    rows, values = _linear(spark, d)
    return rounded(explain.global_importance(rows, values), {"mean_abs_attribution": 6})
