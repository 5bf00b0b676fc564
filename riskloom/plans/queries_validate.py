"""Data quality: keys, ranges, domains and text records."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import validate
from riskloom.plans.catalog import query, table

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]


@query("dq_key_checks", """
WITH k AS (SELECT l_orderkey AS key, count(*) AS n FROM lineitem GROUP BY 1)
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS rows, CAST(coalesce(sum(n) FILTER (WHERE key IS NULL), 0) AS BIGINT) AS null_keys,
       count(*) FILTER (WHERE key IS NOT NULL AND n > 1) AS duplicated_keys,
       CAST(coalesce(sum(n - 1) FILTER (WHERE key IS NOT NULL), 0) AS BIGINT) AS extra_rows
FROM k""")
def dq_key_checks(spark, d):
    return validate.key_check(table(spark, d, "lineitem"), "l_orderkey")


@query("dq_range_checks", """
SELECT 'range:c_acctbal' AS "check", count(*) FILTER (WHERE c_acctbal <= 0) AS violations FROM customer
UNION ALL SELECT 'range:c_nationkey', count(*) FILTER (WHERE c_nationkey < 1) FROM customer
UNION ALL SELECT 'target_binary', count(*) FILTER (WHERE c_acctbal > 9000) FROM customer
UNION ALL SELECT 'target_not_null', count(*) FILTER (WHERE c_acctbal < 0) FROM customer
UNION ALL SELECT 'target_rate', CASE WHEN avg(CAST(c_acctbal < 4000 AS INT)) BETWEEN 0.05 AND 0.35 THEN 0 ELSE 1 END FROM customer""")
def dq_range_checks(spark, d):
    rows = table(spark, d, "customer").withColumn(
        "TARGET", F.when(F.col("c_acctbal") > 9000, 2).when(F.col("c_acctbal") >= 0, 1)
    )
    rules = [
        validate.Rule("range:c_acctbal", F.col("c_acctbal") > 0),
        validate.Rule("range:c_nationkey", F.col("c_nationkey") >= 1),
        *validate.binary_target("TARGET"),
    ]
    rate = validate.rate_check(rows.withColumn("y", (F.col("c_acctbal") < 4000).cast("int")), "y", 0.05, 0.35)
    return validate.rule_check(rows, rules).unionByName(rate)


@query("dq_content_checks", """
SELECT 'all_null_rows' AS "check", count(*) FILTER (WHERE l_tax = 0 AND l_quantity > 40) AS violations FROM lineitem
UNION ALL SELECT 'infinite_values', count(*) FILTER (WHERE l_tax <> 0 AND l_discount = 0) FROM lineitem""")
def dq_content_checks(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey",
        F.when((F.col("l_tax") != 0) | (F.col("l_quantity") <= 40), F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_tax") != 0, F.when(F.col("l_discount") == 0, float("inf")).otherwise(F.col("l_tax"))).alias("tax"),
    )
    return validate.content_check(rows, exclude=["l_orderkey"])


@query("dq_domain_rejects", """
SELECT c_custkey, 'c_mktsegment' AS "column", c_mktsegment AS value FROM customer WHERE c_mktsegment = 'MACHINERY'""")
def dq_domain_rejects(spark, d):
    return validate.domain_rejects(table(spark, d, "customer"), "c_custkey", {"c_mktsegment": _SEGMENTS})


_RECORD_TYPES = {"o_orderkey": "int64", "amount": "float64", "priority": "object", "count": "int64"}
_RECORD_DOMAINS = {"priority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]}

# Text records with planted faults: a word for an amount, a fraction for a count, unknown priorities.
_RECORDS = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'lots' ELSE CAST(o_totalprice AS VARCHAR) END AS amount,
       o_orderpriority AS priority, CASE WHEN o_custkey % 10 = 3 THEN '2.5' WHEN o_custkey % 10 = 4 THEN NULL
                                         ELSE CAST(o_custkey AS VARCHAR) END AS "count"
FROM orders"""


def _records(spark, d):
    c = F.col
    return table(spark, d, "orders").select(
        c("o_orderkey").cast("string").alias("o_orderkey"),
        F.when((c("o_orderstatus") == "P") & (c("o_orderpriority") == "1-URGENT"), "lots")
        .otherwise(c("o_totalprice").cast("string")).alias("amount"),
        c("o_orderpriority").alias("priority"),
        F.when(c("o_custkey") % 10 == 3, "2.5").when(c("o_custkey") % 10 != 4, c("o_custkey").cast("string")).alias("count"),
    )


@query("dq_record_rejects", f"""
WITH r AS ({_RECORDS})
SELECT o_orderkey, 'amount' AS "column", amount AS value, 'not_a_number' AS reason FROM r WHERE amount = 'lots'
UNION ALL SELECT o_orderkey, 'priority', priority, 'unknown_level' FROM r WHERE priority = '4-NOT SPECIFIED'
UNION ALL SELECT o_orderkey, 'count', "count", 'not_an_integer' FROM r WHERE "count" = '2.5'""")
def dq_record_rejects(spark, d):
    checked = validate.check_records(_records(spark, d), _RECORD_TYPES, _RECORD_DOMAINS)
    return validate.rejected_records(checked, "o_orderkey")


@query("dq_record_valid", f"""
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(amount AS DOUBLE) AS amount, priority, CAST("count" AS BIGINT) AS "count"
FROM ({_RECORDS}) WHERE amount <> 'lots' AND priority <> '4-NOT SPECIFIED' AND coalesce("count", '') <> '2.5'""")
def dq_record_valid(spark, d):
    checked = validate.check_records(_records(spark, d), _RECORD_TYPES, _RECORD_DOMAINS)
    return validate.valid_records(checked, _RECORD_TYPES)


@query("domain_catalog", """
SELECT DISTINCT 'o_orderstatus' AS "column", o_orderstatus AS value FROM orders
UNION ALL SELECT DISTINCT 'o_orderpriority', o_orderpriority FROM orders""")
def domain_catalog(spark, d):
    return validate.domain_catalog(table(spark, d, "orders"))
