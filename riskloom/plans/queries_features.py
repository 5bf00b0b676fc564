"""Scalar features, bins, encodings and fitted transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import scalars as s
from riskloom.functions.binning import cut, one_hot
from riskloom.operators import state
from riskloom.operators.split import random_rows, stratified_sample, train_test, train_valid_test
from riskloom.plans.catalog import query, rounded, table
from riskloom.plans.queries_history import orders

_PRIORITY_RANKS = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2, "5-LOW": 3}
_BANDS = ["Lowest", "Low", "Medium", "High", "Highest"]


@query("ratio_features", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_tax <> 0 THEN l_discount / l_tax END + 0.0 AS discount_tax,
       l_extendedprice / l_quantity AS unit_price, l_quantity * l_discount * l_tax + 0.0 AS interaction,
       l_discount - l_tax + 0.0 AS shortfall, l_quantity / -365.0::DOUBLE AS years
FROM lineitem""")
def ratio_features(spark, d):
    c = F.col
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (s.safe_ratio(c("l_discount"), c("l_tax")) + 0.0).alias("discount_tax"),
        s.safe_ratio(c("l_extendedprice"), c("l_quantity")).alias("unit_price"),
        (s.product(c("l_quantity"), c("l_discount"), c("l_tax")) + 0.0).alias("interaction"),
        (s.payment_shortfall(c("l_discount"), c("l_tax")) + 0.0).alias("shortfall"),
        s.days_to_years(c("l_quantity")).alias("years"),
    )


@query("sentinel_flags", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity = 50 THEN 1 ELSE 0 END AS quantity_anomaly,
       nullif(l_quantity, 50) AS quantity, CASE WHEN nullif(l_tax, 0) IS NULL THEN 0 ELSE 1 END AS has_tax
FROM lineitem""")
def sentinel_flags(spark, d):
    quantity = F.col("l_quantity")
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        s.sentinel_flag(quantity, 50.0).alias("quantity_anomaly"),
        s.drop_sentinel(quantity, 50.0).alias("quantity"),
        s.presence_flag(s.drop_sentinel(F.col("l_tax"), 0.0)).alias("has_tax"),
    )


@query("ordinal_encode", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2
       WHEN '5-LOW' THEN 3 END AS priority_rank,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'UNSET' ELSE o_orderpriority END AS priority_label
FROM orders""")
def ordinal_encode(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        s.ordinal(F.col("o_orderpriority"), _PRIORITY_RANKS).alias("priority_rank"),
        s.recode(F.col("o_orderpriority"), {"4-NOT SPECIFIED": "UNSET"}).alias("priority_label"),
    )


@query("onehot_drop_first", """
SELECT o_orderkey, CAST(coalesce(p = '2-HIGH', false) AS DOUBLE) AS "o_orderpriority_2_HIGH",
       CAST(coalesce(p = '3-MEDIUM', false) AS DOUBLE) AS "o_orderpriority_3_MEDIUM",
       CAST(coalesce(p = '5-LOW', false) AS DOUBLE) AS "o_orderpriority_5_LOW"
FROM (SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS p FROM orders)""")
def onehot_drop_first(spark, d):
    rows = orders(spark, d)
    levels = state.fit_levels(rows, ["o_orderpriority"], at_most=100)["o_orderpriority"]
    return s.clean_names(rows.select("o_orderkey", *one_hot("o_orderpriority", levels, drop_first=True)))


def _bin_sql(value: str, edges: str, count: int) -> str:
    whens = " ".join(f"WHEN {value} <= {edges}[{i + 2}] THEN {i}" for i in range(count))
    return f"CASE WHEN {value} < {edges}[1] THEN NULL {whens} END"


@query("quantile_bins", f"""
WITH e AS (SELECT quantile_cont(o_totalprice, [0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS q FROM orders
           WHERE o_orderdate < TIMESTAMP '1999-01-01')
SELECT o_orderkey, {_bin_sql("o_totalprice", "q", 5)} AS price_bin FROM orders, e""")
def quantile_bins(spark, d):
    """Edges from orders before 1999, applied to all: later prices may fall outside."""
    rows = table(spark, d, "orders")
    edges = state.fit_quantile_edges(rows.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")), ["o_totalprice"])
    return state.quantile_bins(rows, {"price_bin": "o_totalprice"}, edges).select("o_orderkey", "price_bin")


@query("quantile_labels", f"""
WITH e AS (SELECT quantile_cont(c_acctbal, [0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS q FROM customer),
b AS (SELECT {_bin_sql("c_acctbal", "q", 5)} AS bin, CAST(c_mktsegment = 'BUILDING' AS INT) AS y FROM customer, e)
SELECT list_extract(['Lowest', 'Low', 'Medium', 'High', 'Highest'], bin + 1) AS category, count(*) AS n,
       round(100.0 * avg(y), 6) AS rate_pct
FROM b GROUP BY bin""")
def quantile_labels(spark, d):
    from riskloom.operators.profile import rate_by_category

    rows = table(spark, d, "customer").withColumn("y", (F.col("c_mktsegment") == "BUILDING").cast("int"))
    edges = state.fit_quantile_edges(rows, ["c_acctbal"])
    banded = state.quantile_bins(rows, {"band": "c_acctbal"}, edges, _BANDS)
    return rounded(rate_by_category(banded, "band", "y"), {"rate_pct": 6})


@query("fixed_bins", """
SELECT p_partkey, CASE WHEN a <= 0 THEN NULL WHEN a <= 5 THEN 'New (0-5 yrs)' WHEN a <= 10 THEN 'Medium (5-10 yrs)'
       WHEN a <= 20 THEN 'Old (10-20 yrs)' WHEN a <= 100 THEN 'Very Old (>20 yrs)' END AS age_band
FROM (SELECT p_partkey, p_size - 1 AS a FROM part)""")
def fixed_bins(spark, d):
    labels = ["New (0-5 yrs)", "Medium (5-10 yrs)", "Old (10-20 yrs)", "Very Old (>20 yrs)"]
    band = cut(F.col("p_size") - 1, [0, 5, 10, 20, 100], labels, include_lowest=False)
    return table(spark, d, "part").select("p_partkey", band.alias("age_band"))


@query("risk_bands", """
SELECT event_id, round(p, 6) AS probability, CAST(p >= 0.14789 AS INT) AS predicted_class,
       CASE WHEN round(p, 6) < 0.15 THEN 'LOW' WHEN round(p, 6) < 0.30 THEN 'MEDIUM'
            WHEN round(p, 6) < 0.50 THEN 'HIGH' ELSE 'VERY HIGH' END AS risk_category
FROM (SELECT event_id, value / (value + 50.0) AS p FROM events)""")
def risk_bands(spark, d):
    p = F.col("value") / (F.col("value") + 50.0)
    return table(spark, d, "events").select(
        "event_id",
        F.round(p, 6).alias("probability"),
        s.predicted_class(p, F.lit(0.14789)).alias("predicted_class"),
        s.risk_band(p).alias("risk_category"),
    )


# --------------------------------------------------------------------------
# fitted transforms: parameters from lines shipped before 2000, applied to all

_TRAIN = "l_shipdate < TIMESTAMP '2000-01-01'"


def _lines(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", s.drop_sentinel(F.col("l_tax"), 0.0).alias("tax"),
    )
    return rows, rows.where(F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp_ntz"))


@query("median_impute", f"""
SELECT l_orderkey, l_linenumber,
       round(coalesce(nullif(l_tax, 0), (SELECT median(nullif(l_tax, 0)) FROM lineitem WHERE {_TRAIN})), 6) AS tax
FROM lineitem""")
def median_impute(spark, d):
    rows, train = _lines(spark, d)
    middle = state.exact_quantiles(train, ["tax"], [0.5])["tax"][0]
    return rows.select("l_orderkey", "l_linenumber", F.round(F.coalesce("tax", F.lit(middle)), 6).alias("tax"))


@query("mode_impute", """
WITH o AS (SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS p FROM orders),
top AS (SELECT p FROM o WHERE p IS NOT NULL GROUP BY p ORDER BY count(*) DESC, p LIMIT 1)
SELECT o_orderkey, coalesce(p, (SELECT p FROM top)) AS priority FROM o""")
def mode_impute(spark, d):
    rows = orders(spark, d)
    mode = state.fit_modes(rows, ["o_orderpriority"])["o_orderpriority"]
    return rows.select("o_orderkey", F.coalesce("o_orderpriority", F.lit(mode)).alias("priority"))


@query("standard_scale", f"""
SELECT l_orderkey, l_linenumber, round((l_quantity - m) / s, 6) + 0.0 AS quantity
FROM lineitem, (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s FROM lineitem WHERE {_TRAIN})""")
def standard_scale(spark, d):
    rows, train = _lines(spark, d)
    fitted = state.fit_standard(train, ["l_quantity"])["l_quantity"]
    return rows.select(
        "l_orderkey", "l_linenumber", (F.round(state.standardise(F.col("l_quantity"), *fitted), 6) + 0.0).alias("quantity")
    )


@query("minmax_scale", f"""
SELECT l_orderkey, l_linenumber, round((l_quantity - lo) / (hi - lo), 6) AS quantity
FROM lineitem, (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem WHERE {_TRAIN})""")
def minmax_scale(spark, d):
    rows, train = _lines(spark, d)
    fitted = state.fit_min_max(train, ["l_quantity"])["l_quantity"]
    return rows.select(
        "l_orderkey", "l_linenumber", F.round(state.min_max(F.col("l_quantity"), *fitted), 6).alias("quantity")
    )


@query("yeo_johnson_apply", """
SELECT c_custkey,
       round(CASE WHEN x >= 0 THEN (pow(x + 1, 0.5) - 1) / 0.5 ELSE -(pow(1 - x, 1.5) - 1) / 1.5 END, 6) AS half,
       round(CASE WHEN x >= 0 THEN ln(1 + x) ELSE -(pow(1 - x, 2) - 1) / 2 END, 6) AS zero,
       round(CASE WHEN x >= 0 THEN (pow(x + 1, 2) - 1) / 2 ELSE -ln(1 - x) END, 6) AS two,
       round(CASE WHEN x >= 0 THEN (pow(x + 1, -0.7) - 1) / -0.7 ELSE -(pow(1 - x, 2.7) - 1) / 2.7 END, 6) AS negative
FROM (SELECT c_custkey, c_acctbal / 937 AS x FROM customer)""")
def yeo_johnson_apply(spark, d):
    powers = {"half": 0.5, "zero": 0.0, "two": 2.0, "negative": -0.7}
    x = F.col("c_acctbal") / 937
    return table(spark, d, "customer").select(
        "c_custkey", *[F.round(state.yeo_johnson(x, p), 6).alias(name) for name, p in powers.items()]
    )


# A power is best where the likelihood on either side is lower; three decimals of it can be checked on a grid.
@query("yeo_johnson_fit", """
WITH x AS (SELECT c_acctbal / 937 AS x FROM customer),
grid AS (SELECT i / 100.0::DOUBLE AS p FROM range(-300, 501) t(i)),
t AS (SELECT p, x, CASE WHEN x >= 0 THEN CASE WHEN abs(p) < 1e-9 THEN ln(1 + x) ELSE (pow(x + 1, p) - 1) / p END
                        ELSE CASE WHEN abs(p - 2) < 1e-9 THEN -ln(1 - x) ELSE -(pow(1 - x, 2 - p) - 1) / (2 - p) END
                   END AS y
      FROM x, grid),
l AS (SELECT p, -0.5 * ln(var_pop(y)) + (p - 1) * avg(sign(x) * ln(1 + abs(x))) AS likelihood FROM t GROUP BY p)
SELECT 'acctbal' AS feature, round(arg_max(p, likelihood), 2) AS power FROM l""")
def yeo_johnson_fit(spark, d):
    rows = table(spark, d, "customer").select((F.col("c_acctbal") / 937).alias("acctbal"))
    fitted = state.fit_yeo_johnson(rows, ["acctbal"])
    return spark.createDataFrame([(c, round(p, 2)) for c, p in fitted.items()], "feature string, power double")


# --------------------------------------------------------------------------
# splits

_RANKED = """
WITH a AS (SELECT c_custkey, CAST(c_acctbal < 0 AS INT) AS label FROM customer),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat(c_custkey, ':42')), c_custkey) AS rk FROM a),
s0 AS (SELECT label, count(*) AS size FROM a GROUP BY label),
n0 AS (SELECT sum(size) AS n FROM s0)"""


def allocate_sql(step: int, total: str) -> str:
    """Common tables that spread ``total`` rows over the classes left after ``step`` cuts."""
    s, n, t = f"s{step}", f"n{step}", f"t{step}"
    return f""",
{t} AS (SELECT CAST(ceil({total}) AS BIGINT) AS total FROM {n}),
f{step} AS (SELECT label, size, floor(size * total / n) AS base, size * total / n - floor(size * total / n) AS frac
            FROM {s}, {n}, {t}),
k{step} AS (SELECT label, size, base + CASE WHEN row_number() OVER (ORDER BY frac DESC, label)
                   <= (SELECT max(total) FROM {t}) - (SELECT sum(base) FROM f{step}) THEN 1 ELSE 0 END AS take
            FROM f{step}),
s{step + 1} AS (SELECT label, size - take AS size FROM k{step}),
n{step + 1} AS (SELECT sum(size) AS n FROM s{step + 1})"""


@query("stratified_split", _RANKED + allocate_sql(0, "0.15::DOUBLE * n") + allocate_sql(1, "0.15::DOUBLE / 0.85::DOUBLE * n") + """
SELECT c_custkey, r.label, CASE WHEN rk <= k0.take THEN 'test' WHEN rk <= k0.take + k1.take THEN 'valid' ELSE 'train' END AS part
FROM r JOIN k0 ON r.label = k0.label JOIN k1 ON r.label = k1.label""")
def stratified_split(spark, d):
    return train_valid_test(_applicants(spark, d), "c_custkey", "label").select("c_custkey", "label", "part")


@query("train_test_split", _RANKED + allocate_sql(0, "0.2::DOUBLE * n") + """
SELECT c_custkey, CASE WHEN rk <= k0.take THEN 'test' ELSE 'train' END AS part FROM r JOIN k0 ON r.label = k0.label""")
def train_test_split(spark, d):
    return train_test(_applicants(spark, d), "c_custkey", "label").select("c_custkey", "part")


@query("stratified_sample", _RANKED + allocate_sql(0, "0.01::DOUBLE * n") + """
SELECT c_custkey, r.label FROM r JOIN k0 ON r.label = k0.label WHERE rk <= k0.take""")
def stratified_sample_query(spark, d):
    return stratified_sample(_applicants(spark, d), "c_custkey", "label").select("c_custkey", "label")


@query("random_sample", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(concat(o_orderkey, ':42')), o_orderkey LIMIT 200")
def random_sample(spark, d):
    return random_rows(table(spark, d, "orders"), "o_orderkey", 200).select("o_orderkey", "o_totalprice")


def _applicants(spark, d):
    return table(spark, d, "customer").select("c_custkey", (F.col("c_acctbal") < 0).cast("int").alias("label"))
