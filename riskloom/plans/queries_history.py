"""History rollups: orders, their lineitems and user events per customer.

Money is taken in whole cents and dates in whole days, so sums are exact and
means do not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.functions.scalars import clean_names
from riskloom.operators.history import attach, join_child_rollup, outer_join, until
from riskloom.operators.rollup import RollupSpec, rollup, status_rollup, with_payment_columns
from riskloom.operators.state import fit_levels, fit_modes
from riskloom.plans.catalog import query, rounded, table

ORDER_STATS = RollupSpec("o_custkey", "ORD", {
    "cents": ["count", "mean", "sum", "max", "min"],
    "days": ["mean", "max", "min", "var"],
})
EVENT_STATS = RollupSpec("user_id", "EVT", {
    "cents": ["mean", "sum", "max", "min"],
    "k": ["mean", "max", "sum"],
    "days": ["mean", "max", "min", "count"],
})
PAYMENT_STATS = RollupSpec("o_custkey", "INSTAL", {
    "l_suppkey": ["nunique"],
    "PAYMENT_PERC": ["mean", "sum", "max", "min"],
    "PAYMENT_DIFF": ["mean", "sum", "max", "min"],
    "AMT_INSTALMENT": ["mean", "sum", "max"],
    "AMT_PAYMENT": ["mean", "sum", "max"],
})


def orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("o_orderpriority"),
        F.round(F.col("o_totalprice") * 100).alias("cents"),
        F.datediff("o_orderdate", F.lit("2001-08-01").cast("date")).alias("days"),
    )


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        "user_id",
        F.round(F.col("value") * 100).alias("cents"),
        F.regexp_extract("props", r"(\d+)", 1).cast("bigint").alias("k"),
        F.datediff("ts", F.lit("2024-02-01").cast("date")).alias("days"),
    )


def payments(spark: SparkSession, d: str) -> DataFrame:
    """Instalment rows: due is the tax and paid the discount of a line, in cents."""
    lines = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_suppkey",
        F.round(F.col("l_extendedprice") * F.col("l_tax") * 100).alias("AMT_INSTALMENT"),
        F.round(F.col("l_extendedprice") * F.col("l_discount") * 100).alias("AMT_PAYMENT"),
    )
    owners = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return with_payment_columns(lines.join(owners, "l_orderkey"))


def order_rollup(spark: SparkSession, d: str) -> DataFrame:
    return rollup(orders(spark, d), ORDER_STATS)


def event_rollup(spark: SparkSession, d: str) -> DataFrame:
    return rollup(events(spark, d), EVENT_STATS)


def payment_rollup(spark: SparkSession, d: str) -> DataFrame:
    return rollup(payments(spark, d), PAYMENT_STATS)


# --------------------------------------------------------------------------
# the same in SQL

_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority,
       round(o_totalprice * 100) AS cents, date_diff('day', DATE '2001-08-01', CAST(o_orderdate AS DATE)) AS days
FROM orders"""
_EVENTS = r"""
SELECT user_id, round(value * 100) AS cents, CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS k,
       date_diff('day', DATE '2024-02-01', CAST(ts AS DATE)) AS days
FROM events"""
_PAYMENTS = """
SELECT o_custkey, l_suppkey, due, paid, CASE WHEN due <> 0 THEN paid / due END AS perc, due - paid AS diff
FROM (SELECT o_custkey, l_suppkey, round(l_extendedprice * l_tax * 100) AS due,
             round(l_extendedprice * l_discount * 100) AS paid
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

ORDER_SQL = f"""
SELECT o_custkey, count(cents) AS "ORD_cents_COUNT", avg(cents) AS "ORD_cents_MEAN", sum(cents) AS "ORD_cents_SUM",
       max(cents) AS "ORD_cents_MAX", min(cents) AS "ORD_cents_MIN", avg(days) AS "ORD_days_MEAN",
       CAST(max(days) AS INT) AS "ORD_days_MAX", CAST(min(days) AS INT) AS "ORD_days_MIN",
       round(var_samp(days), 4) AS "ORD_days_VAR"
FROM ({_ORDERS}) GROUP BY o_custkey"""
EVENT_SQL = f"""
SELECT user_id, avg(cents) AS "EVT_cents_MEAN", sum(cents) AS "EVT_cents_SUM", max(cents) AS "EVT_cents_MAX",
       min(cents) AS "EVT_cents_MIN", avg(k) AS "EVT_k_MEAN", max(k) AS "EVT_k_MAX",
       CAST(sum(k) AS BIGINT) AS "EVT_k_SUM", avg(days) AS "EVT_days_MEAN",
       CAST(max(days) AS INT) AS "EVT_days_MAX", CAST(min(days) AS INT) AS "EVT_days_MIN",
       count(days) AS "EVT_days_COUNT"
FROM ({_EVENTS}) GROUP BY user_id"""
PAYMENT_SQL = f"""
SELECT o_custkey, count(DISTINCT l_suppkey) AS "INSTAL_l_suppkey_NUNIQUE",
       round(avg(perc), 9) + 0.0 AS "INSTAL_PAYMENT_PERC_MEAN",
       round(coalesce(sum(perc), 0), 6) + 0.0 AS "INSTAL_PAYMENT_PERC_SUM",
       round(max(perc), 9) + 0.0 AS "INSTAL_PAYMENT_PERC_MAX", round(min(perc), 9) + 0.0 AS "INSTAL_PAYMENT_PERC_MIN",
       avg(diff) + 0.0 AS "INSTAL_PAYMENT_DIFF_MEAN", sum(diff) + 0.0 AS "INSTAL_PAYMENT_DIFF_SUM",
       max(diff) + 0.0 AS "INSTAL_PAYMENT_DIFF_MAX", min(diff) + 0.0 AS "INSTAL_PAYMENT_DIFF_MIN",
       avg(due) + 0.0 AS "INSTAL_AMT_INSTALMENT_MEAN", sum(due) + 0.0 AS "INSTAL_AMT_INSTALMENT_SUM",
       max(due) + 0.0 AS "INSTAL_AMT_INSTALMENT_MAX", avg(paid) + 0.0 AS "INSTAL_AMT_PAYMENT_MEAN",
       sum(paid) + 0.0 AS "INSTAL_AMT_PAYMENT_SUM", max(paid) + 0.0 AS "INSTAL_AMT_PAYMENT_MAX"
FROM ({_PAYMENTS}) GROUP BY o_custkey"""

_ORDER_PLACES = {"ORD_days_VAR": 4}
_RATIO_PLACES = {
    "INSTAL_PAYMENT_PERC_MEAN": 9,
    "INSTAL_PAYMENT_PERC_SUM": 6,
    "INSTAL_PAYMENT_PERC_MAX": 9,
    "INSTAL_PAYMENT_PERC_MIN": 9,
}


def _plain(df: DataFrame) -> DataFrame:
    """Negative zeros made plain in all double columns."""
    doubles = {f.name for f in df.schema if f.dataType.simpleString() == "double"}
    return df.select(*[(F.col(c) + 0.0).alias(c) if c in doubles else F.col(c) for c in df.columns])


def _round_payments(df: DataFrame) -> DataFrame:
    return _plain(rounded(df, _RATIO_PLACES))


@query("hist_child_rollup", ORDER_SQL)
def hist_child_rollup(spark, d):
    return rounded(order_rollup(spark, d), _ORDER_PLACES)


@query("hist_event_rollup", EVENT_SQL)
def hist_event_rollup(spark, d):
    return event_rollup(spark, d)


@query("hist_installment_rollup", PAYMENT_SQL)
def hist_installment_rollup(spark, d):
    return _round_payments(payment_rollup(spark, d))


# --------------------------------------------------------------------------
# grandchild -> child -> parent

_STATUS_SQL = """
SELECT l_orderkey, avg(l_linenumber) AS "BB_l_linenumber_MEAN",
       CAST(sum(l_linenumber) AS BIGINT) AS "BB_l_linenumber_SUM",
       round(var_samp(l_linenumber), 6) AS "BB_l_linenumber_VAR",
       avg(n) AS "BB_l_returnflag_N_MEAN", CAST(sum(n) AS BIGINT) AS "BB_l_returnflag_N_SUM",
       round(var_samp(n), 6) + 0.0 AS "BB_l_returnflag_N_VAR",
       avg(r) AS "BB_l_returnflag_R_MEAN", CAST(sum(r) AS BIGINT) AS "BB_l_returnflag_R_SUM",
       round(var_samp(r), 6) + 0.0 AS "BB_l_returnflag_R_VAR"
FROM (SELECT *, CAST(l_returnflag = 'N' AS INT) AS n, CAST(l_returnflag = 'R' AS INT) AS r FROM lineitem)
GROUP BY l_orderkey"""


def line_status(spark, d):
    return status_rollup(table(spark, d, "lineitem"), "l_orderkey", "l_returnflag", ["A", "N", "R"], ["l_linenumber"])


@query("hist_status_rollup", _STATUS_SQL)
def hist_status_rollup(spark, d):
    return rounded(line_status(spark, d), {
        "BB_l_linenumber_VAR": 6, "BB_l_returnflag_N_VAR": 6, "BB_l_returnflag_R_VAR": 6,
    })


_TWO_LEVEL = RollupSpec("o_custkey", "BUREAU", {
    "cents": ["count", "mean", "max"],
    "BB_l_linenumber_SUM": ["sum", "max", "mean"],
    "BB_l_returnflag_N_SUM": ["sum", "max"],
    "BB_l_returnflag_R_SUM": ["sum", "mean", "count"],
})


@query("hist_two_level_rollup", f"""
SELECT o_custkey, count(cents) AS "BUREAU_cents_COUNT", avg(cents) AS "BUREAU_cents_MEAN",
       max(cents) AS "BUREAU_cents_MAX",
       CAST(coalesce(sum("BB_l_linenumber_SUM"), 0) AS BIGINT) AS "BUREAU_BB_l_linenumber_SUM_SUM",
       max("BB_l_linenumber_SUM") AS "BUREAU_BB_l_linenumber_SUM_MAX",
       avg("BB_l_linenumber_SUM") AS "BUREAU_BB_l_linenumber_SUM_MEAN",
       CAST(coalesce(sum("BB_l_returnflag_N_SUM"), 0) AS BIGINT) AS "BUREAU_BB_l_returnflag_N_SUM_SUM",
       max("BB_l_returnflag_N_SUM") AS "BUREAU_BB_l_returnflag_N_SUM_MAX",
       CAST(coalesce(sum("BB_l_returnflag_R_SUM"), 0) AS BIGINT) AS "BUREAU_BB_l_returnflag_R_SUM_SUM",
       avg("BB_l_returnflag_R_SUM") AS "BUREAU_BB_l_returnflag_R_SUM_MEAN",
       count("BB_l_returnflag_R_SUM") AS "BUREAU_BB_l_returnflag_R_SUM_COUNT"
FROM ({_ORDERS}) o LEFT JOIN ({_STATUS_SQL}) s ON o.o_orderkey = s.l_orderkey GROUP BY o_custkey""")
def hist_two_level_rollup(spark, d):
    loans = orders(spark, d).withColumnRenamed("o_orderkey", "l_orderkey")
    return rollup(join_child_rollup(loans, line_status(spark, d), "l_orderkey"), _TWO_LEVEL)


_LEVELS = [("o_orderstatus", v) for v in "FOP"] + [
    ("o_orderpriority", v) for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")
]


def _level_sql(column: str, level: str) -> str:
    name = f"{column}_{level}".replace("-", "_")
    hit = f"CAST({column} = '{level}' AS INT)"
    return f'avg({hit}) AS "{name}_MEAN", CAST(sum({hit}) AS BIGINT) AS "{name}_SUM"'


@query("hist_categorical_rollup", f"""
WITH o AS ({_ORDERS}),
top AS (SELECT o_orderpriority AS mode FROM o WHERE o_orderpriority IS NOT NULL
        GROUP BY o_orderpriority ORDER BY count(*) DESC, o_orderpriority LIMIT 1),
filled AS (SELECT o_custkey, o_orderstatus, coalesce(o_orderpriority, (SELECT mode FROM top)) AS o_orderpriority FROM o)
SELECT o_custkey, {", ".join(_level_sql(c, v) for c, v in _LEVELS)} FROM filled GROUP BY o_custkey""")
def hist_categorical_rollup(spark, d):
    child = orders(spark, d)
    columns = ["o_orderstatus", "o_orderpriority"]
    spec = RollupSpec("o_custkey", "", {}, fit_levels(child, columns, at_most=100), fit_modes(child, columns))
    return clean_names(rollup(child, spec))


_ORDER_NUMBERS = ", ".join(
    f'{sql} AS "ORD_cents_{stat}"' for stat, sql in {"COUNT": "count(cents)", "MAX": "max(cents)", "SUM": "sum(cents)"}.items()
)


@query("hist_combined_rollup", f"""
WITH o AS ({_ORDERS})
SELECT o_custkey, {_ORDER_NUMBERS}, {", ".join(_level_sql("o_orderstatus", v) for v in "FOP")} FROM o GROUP BY o_custkey""")
def hist_combined_rollup(spark, d):
    spec = RollupSpec("o_custkey", "ORD", {"cents": ["count", "max", "sum"]}, {"o_orderstatus": list("FOP")})
    return rollup(orders(spark, d), spec)


# --------------------------------------------------------------------------
# joins on the applicant key


def history(spark: SparkSession, d: str) -> DataFrame:
    return outer_join(
        "cust_key",
        order_rollup(spark, d).withColumnRenamed("o_custkey", "cust_key"),
        event_rollup(spark, d).withColumnRenamed("user_id", "cust_key"),
        payment_rollup(spark, d).withColumnRenamed("o_custkey", "cust_key"),
    )


_HISTORY_SQL = f"""
SELECT * FROM (SELECT o_custkey AS cust_key, * EXCLUDE (o_custkey) FROM ({ORDER_SQL}))
FULL JOIN (SELECT user_id AS cust_key, * EXCLUDE (user_id) FROM ({EVENT_SQL})) USING (cust_key)
FULL JOIN (SELECT o_custkey AS cust_key, * EXCLUDE (o_custkey) FROM ({PAYMENT_SQL})) USING (cust_key)"""


@query("hist_outer_join", _HISTORY_SQL)
def hist_outer_join(spark, d):
    return _round_payments(rounded(history(spark, d), _ORDER_PLACES))


@query("feature_join", f"""
SELECT c_custkey AS cust_key, c_acctbal, c_mktsegment, h.* EXCLUDE (cust_key)
FROM customer LEFT JOIN ({_HISTORY_SQL}) h ON c_custkey = h.cust_key""")
def feature_join(spark, d):
    applications = table(spark, d, "customer").select(F.col("c_custkey").alias("cust_key"), "c_acctbal", "c_mktsegment")
    return _round_payments(rounded(attach(applications, history(spark, d), "cust_key"), _ORDER_PLACES))


@query("history_until", f"""
SELECT o_custkey, count(cents) AS "PAST_cents_COUNT", max(days) AS "PAST_days_MAX"
FROM (SELECT o_custkey, cents, CAST(days AS INT) AS days FROM ({_ORDERS}) WHERE days <= -365) GROUP BY o_custkey""")
def history_until(spark, d):
    spec = RollupSpec("o_custkey", "PAST", {"cents": ["count"], "days": ["max"]})
    return rollup(until(orders(spark, d), "days", -365), spec)
