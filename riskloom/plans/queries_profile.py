"""Table profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import scalars as s
from riskloom.operators import profile
from riskloom.operators.history import attach_target
from riskloom.plans.catalog import query, rounded, table
from riskloom.plans.queries_history import orders


def _gappy(spark, d):
    """Lineitems with sentinels turned into gaps."""
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_quantity",
        s.drop_sentinel(F.col("l_tax"), 0.0).alias("tax"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_quantity") > 30, F.col("l_discount")).alias("bulk_discount"),
    )


_GAPPY = """
SELECT l_orderkey, l_quantity, nullif(l_tax, 0) AS tax, nullif(l_returnflag, 'N') AS flag,
       CASE WHEN l_quantity > 30 THEN l_discount END AS bulk_discount
FROM lineitem"""
_GAPPY_COLUMNS = ["l_orderkey", "l_quantity", "tax", "flag", "bulk_discount"]


def _missing_sql(columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(100.0 * avg(CAST({c} IS NULL AS INT)), 6) AS missing_pct FROM g" for c in columns
    )


@query("missingness_profile", f"""
WITH g AS ({_GAPPY}), m AS ({_missing_sql(_GAPPY_COLUMNS)})
SELECT * FROM m WHERE missing_pct > 0 ORDER BY missing_pct DESC, feature LIMIT 30""")
def missingness_profile(spark, d):
    return rounded(profile.top_missing(_gappy(spark, d), 30), {"missing_pct": 6})


@query("sparse_columns", f"""
WITH g AS ({_GAPPY}), m AS ({_missing_sql(_GAPPY_COLUMNS)}) SELECT feature FROM m WHERE missing_pct > 50""")
def sparse_columns(spark, d):
    dropped = profile.sparse_columns(_gappy(spark, d))
    return spark.createDataFrame([(c,) for c in dropped], "feature string")


@query("class_balance", """
WITH v AS (
  SELECT 'o_orderstatus' AS feature, o_orderstatus AS value FROM orders
  UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'),
t AS (SELECT feature, count(*) AS a FROM v GROUP BY feature)
SELECT v.feature, value, count(*) AS n, round(100.0 * count(*) / max(a), 6) AS pct
FROM v JOIN t ON v.feature = t.feature GROUP BY v.feature, value""")
def class_balance(spark, d):
    shares = profile.value_shares(orders(spark, d), ["o_orderstatus", "o_orderpriority"])
    return rounded(shares, {"pct": 6})


@query("cardinality_split", """
WITH c AS (
  SELECT 'o_orderstatus' AS feature, count(DISTINCT o_orderstatus) AS n_levels FROM orders
  UNION ALL SELECT 'o_orderpriority', count(DISTINCT nullif(o_orderpriority, '4-NOT SPECIFIED')) FROM orders
  UNION ALL SELECT 'o_custkey', count(DISTINCT o_custkey) FROM orders)
SELECT feature, n_levels, CASE WHEN n_levels < 10 THEN 'low' ELSE 'high' END AS cardinality FROM c""")
def cardinality_split(spark, d):
    levels = profile.cardinalities(orders(spark, d), ["o_orderstatus", "o_orderpriority", "o_custkey"])
    return levels.withColumn("cardinality", F.when(F.col("n_levels") < 10, "low").otherwise("high"))


@query("default_rate_by_category", """
SELECT o_orderpriority AS category, count(*) AS n, round(avg(CAST(o_orderstatus = 'F' AS INT)) * 100, 6) AS rate_pct
FROM orders GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 3""")
def default_rate_by_category(spark, d):
    rows = table(spark, d, "orders").withColumn("y", (F.col("o_orderstatus") == "F").cast("int"))
    return rounded(profile.rate_by_category(rows, "o_orderpriority", "y", limit=3), {"rate_pct": 6})


# The condition keeps rows whose priority is NULL, unlike a plain SQL inequality.
@query("child_default_rate", """
WITH a AS (SELECT c_custkey, CAST(c_acctbal < 0 AS INT) AS label FROM customer),
j AS (SELECT label, nullif(o_orderpriority, '4-NOT SPECIFIED') AS p, o_orderstatus FROM a LEFT JOIN orders ON c_custkey = o_custkey),
k AS (SELECT * FROM j WHERE p IS DISTINCT FROM '5-LOW')
SELECT o_orderstatus AS category, count(label) AS n, round(avg(label) * 100, 6) AS rate_pct
FROM k WHERE o_orderstatus IS NOT NULL GROUP BY 1""")
def child_default_rate(spark, d):
    applications = table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"), (F.col("c_acctbal") < 0).cast("int").alias("label")
    )
    joined = attach_target(orders(spark, d), applications, "o_custkey", "label")
    kept = joined.where(s.differs(F.col("o_orderpriority"), "5-LOW"))
    return rounded(profile.rate_by_category(kept, "o_orderstatus", "label"), {"rate_pct": 6})


@query("sentinel_default_rate", """
SELECT l_quantity = 50 AS is_sentinel, count(*) AS n, round(avg(CAST(l_returnflag = 'R' AS INT)), 6) AS target_rate
FROM lineitem GROUP BY 1""")
def sentinel_default_rate(spark, d):
    rows = table(spark, d, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    return rounded(profile.rate_by_sentinel(rows, "l_quantity", 50, "y"), {"target_rate": 6})


_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("target_correlation", "WITH l AS (SELECT *, CAST(l_returnflag = 'R' AS INT) AS y FROM lineitem), c AS ("
       + " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, y) AS r FROM l" for c in _NUMBERS) + """)
SELECT * FROM (SELECT feature, round(r, 6) AS correlation, 'negative' AS side FROM c ORDER BY r, feature LIMIT 3)
UNION ALL SELECT * FROM (SELECT feature, round(r, 6), 'positive' FROM c ORDER BY r DESC, feature LIMIT 3)""")
def target_correlation(spark, d):
    rows = table(spark, d, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    return rounded(profile.strongest_correlations(rows, _NUMBERS, "y", 3), {"correlation": 6})


def _describe_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
    CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
    round(quantile_cont({c}, 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM g"""


@query("summary_stats", "WITH g AS (SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, "
       "o_totalprice FROM orders) "
       + " UNION ALL ".join(_describe_sql(c) for c in ("o_orderkey", "o_custkey", "o_totalprice")))
def summary_stats(spark, d):
    stats = profile.describe(table(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"])
    return rounded(stats, {"mean": 4, "std": 4, "p25": 6, "p50": 6, "p75": 6})


def _histogram_sql(rows: str, bins: int) -> str:
    """Counts per class in equal-width bins over the whole range, the last bin closed."""
    return f"""
WITH v AS ({rows}), b AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
h AS (SELECT y, least(CAST(floor((x - lo) / (hi - lo) * {bins}) AS INT), {bins - 1}) AS bin, count(*) AS n,
             max(lo) AS lo, max(hi) AS hi FROM v, b GROUP BY 1, 2)
SELECT y, bin, n, round(lo + bin * (hi - lo) / {bins}, 6) AS bin_left,
       round(n / sum(n) OVER (PARTITION BY y) / ((hi - lo) / {bins}), 6) AS density FROM h"""


@query("histogram_by_class", _histogram_sql(
    "SELECT l_extendedprice / 1000 AS x, CAST(l_returnflag = 'R' AS INT) AS y FROM lineitem", 50))
def histogram_by_class(spark, d):
    rows = table(spark, d, "lineitem").select(
        (F.col("l_extendedprice") / 1000).alias("x"), (F.col("l_returnflag") == "R").cast("int").alias("y")
    )
    return rounded(profile.histogram(rows, "x", 50, by="y"), {"bin_left": 6, "density": 6})


@query("log_debt_histogram", _histogram_sql(
    "SELECT ln(1 + c_acctbal) AS x, CAST(c_mktsegment = 'BUILDING' AS INT) AS y FROM customer WHERE c_acctbal > 0", 25))
def log_debt_histogram(spark, d):
    rows = table(spark, d, "customer").where(F.col("c_acctbal") > 0).select(
        F.log1p("c_acctbal").alias("x"), (F.col("c_mktsegment") == "BUILDING").cast("int").alias("y")
    )
    return rounded(profile.histogram(rows, "x", 25, by="y"), {"bin_left": 6, "density": 6})


def _distribution_sql(name: str, rows: str) -> str:
    return f"""SELECT '{name}' AS score, round(avg(p), 6) AS mean, round(stddev_pop(p), 6) AS std,
    round(quantile_cont(p, 0.1), 6) AS p10, round(quantile_cont(p, 0.5), 6) AS p50, round(quantile_cont(p, 0.9), 6) AS p90,
    round(avg(CAST(p >= 0.5 AS INT)), 6) AS predicted_positive_rate, count(p) AS n FROM ({rows})"""


@query("score_distribution", " UNION ALL ".join([
    _distribution_sql("all", "SELECT value / (value + 50.0) AS p FROM events"),
    _distribution_sql("purchase", "SELECT value / (value + 50.0) AS p FROM events WHERE event_type = 'purchase'"),
]))
def score_distribution(spark, d):
    p = F.col("value") / (F.col("value") + 50.0)
    out = profile.score_distribution(
        table(spark, d, "events"), {"all": p, "purchase": F.when(F.col("event_type") == "purchase", p)}
    )
    return rounded(out, {c: 6 for c in ("mean", "std", "p10", "p50", "p90", "predicted_positive_rate")})
