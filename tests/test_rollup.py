import credit
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators.history import attach_target, outer_join
from riskloom.operators.rollup import RollupSpec, category_rollup_long, rollup, status_rollup, with_payment_columns
from riskloom.operators.state import fit_levels, fit_modes
from riskloom.plans.history import build_history
from riskloom.sources import contracts as c


def test_null_and_single_row_semantics(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (2, None), (None, 9.0)], "k int, x double")
    spec = RollupSpec("k", "T", {"x": ["count", "mean", "sum", "var", "nunique", "min"]})
    rows = {r["k"]: r for r in rollup(df, spec).collect()}
    assert set(rows) == {1, 2}
    assert (rows[1]["T_x_COUNT"], rows[1]["T_x_SUM"], rows[1]["T_x_VAR"]) == (1, 2.0, None)
    assert (rows[2]["T_x_COUNT"], rows[2]["T_x_SUM"], rows[2]["T_x_MEAN"], rows[2]["T_x_NUNIQUE"]) == (0, 0.0, None, 0)


def test_payment_columns(spark):
    df = spark.createDataFrame([(0.0, 5.0), (10.0, 4.0)], "AMT_INSTALMENT double, AMT_PAYMENT double")
    rows = with_payment_columns(df).collect()
    assert [r["PAYMENT_PERC"] for r in rows] == [None, 0.4]
    assert [r["PAYMENT_DIFF"] for r in rows] == [-5.0, 6.0]


def test_status_rollup_matches_pandas(spark):
    balance = credit.history(range(40))["bureau_balance"]
    got = status_rollup(credit.to_spark(spark, balance), "SK_ID_BUREAU", "STATUS", c.STATUS_LEVELS, ["MONTHS_BALANCE"])
    got = got.toPandas().set_index("SK_ID_BUREAU").sort_index().astype(float)
    hot = pd.get_dummies(balance, columns=["STATUS"], drop_first=True, dtype=float)
    want = hot.groupby("SK_ID_BUREAU").agg(["mean", "sum", "var"])
    want.columns = [f"BB_{a}_{b.upper()}" for a, b in want.columns]
    pd.testing.assert_frame_equal(got[sorted(got)], want[sorted(want)].astype(float), check_names=False)


def test_level_rollups_match_pandas(spark):
    bureau = credit.history(range(40))["bureau"]
    df = credit.to_spark(spark, bureau)
    names = ["CREDIT_ACTIVE", "CREDIT_TYPE"]
    levels, fills = fit_levels(df, names, at_most=100), fit_modes(df, names)
    assert fills["CREDIT_ACTIVE"] == "Closed"
    wide = rollup(df, RollupSpec(c.KEY, "", {}, levels, fills)).toPandas().set_index(c.KEY).sort_index()
    # levels outside the contract count in the denominator only
    fewer = {"CREDIT_ACTIVE": ["Active"]}
    spec = RollupSpec(c.KEY, "B", {"CREDIT_DAY_OVERDUE": ["sum"]}, fewer)
    both = rollup(df, spec).toPandas().set_index(c.KEY).sort_index()
    active = bureau.groupby(c.KEY).CREDIT_ACTIVE.apply(lambda s: (s == "Active").sum())
    np.testing.assert_allclose(both["CREDIT_ACTIVE_Active_SUM"], active.sort_index())
    np.testing.assert_allclose(both["B_CREDIT_DAY_OVERDUE_SUM"], bureau.groupby(c.KEY).CREDIT_DAY_OVERDUE.sum().sort_index())
    filled = bureau.assign(CREDIT_ACTIVE=bureau.CREDIT_ACTIVE.fillna("Closed"))
    want = filled.groupby(c.KEY).CREDIT_ACTIVE.apply(lambda s: (s == "Active").mean())
    np.testing.assert_allclose(wide["CREDIT_ACTIVE_Active_MEAN"], want.sort_index())


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("b",), ("a",)], "x string")
    assert fit_modes(df, ["x"]) == {"x": "a"}


def test_too_many_levels_are_refused(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("x"))
    with pytest.raises(ValueError, match="too many levels"):
        fit_levels(df, ["x"], at_most=10)


def test_outer_join_keeps_every_key_without_another_exchange(spark):
    left = spark.range(0, 60).groupBy((F.col("id") % 20).alias("k")).agg(F.sum("id").alias("a"))
    right = spark.range(0, 60).groupBy((F.col("id") % 30 + 10).alias("k")).agg(F.max("id").alias("b"))
    joined = outer_join("k", left, right)
    want = left.join(right, "k", "full")
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, want.select("k", "a", "b").collect()), key=str)
    plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 2


def test_outer_join_with_uneven_runtime_partitions(spark):
    """Partition coalescing at run time must not separate the rows of a key."""
    conf = spark.conf
    conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        big = spark.range(40_000).groupBy((F.col("id") % 20_000).alias("k")).agg(F.sum("id").alias("a"))
        few = spark.range(900).groupBy((F.col("id") % 300 + 19_900).alias("k")).agg(F.max("id").alias("b"))
        want = big.join(few, "k", "full").select("k", "a", "b").collect()
        assert sorted(map(str, outer_join("k", big, few).collect())) == sorted(map(str, want))
    finally:
        conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")


def test_outer_join_refuses_shared_columns(spark):
    left = spark.createDataFrame([(1, 2)], "k int, a int")
    with pytest.raises(ValueError, match="several tables"):
        outer_join("k", left, left)


def test_attach_target_is_a_left_join(spark):
    apps = spark.createDataFrame([(1, 0), (2, 1), (3, 0)], "k int, TARGET int")
    child = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (9, "w")], "k int, v string")
    got = attach_target(child, apps, "k", "TARGET").select("k", "TARGET", "v").collect()
    assert sorted(map(tuple, got), key=str) == [(1, 0, "x"), (1, 0, "y"), (2, 1, "z"), (3, 0, None)]


def test_history_build_matches_pandas(spark):
    tables = credit.history(range(100, 160))
    hist = build_history({n: credit.to_spark(spark, t) for n, t in tables.items()})
    got = hist.toPandas().set_index(c.KEY).sort_index()
    keys = set().union(*[set(t[c.KEY]) for t in tables.values() if c.KEY in t])
    assert set(got.index) == keys
    pos = tables["POS_CASH_balance"].groupby(c.KEY)
    np.testing.assert_allclose(got["POS_SK_DPD_MEAN"], pos.SK_DPD.mean().reindex(got.index))
    np.testing.assert_allclose(got["POS_CNT_INSTALMENT_FUTURE_SUM"].astype(float), pos.CNT_INSTALMENT_FUTURE.sum().reindex(got.index))
    pay = tables["installments_payments"]
    perc = (pay.AMT_PAYMENT / pay.AMT_INSTALMENT.replace(0, np.nan)).groupby(pay[c.KEY])
    np.testing.assert_allclose(got["INSTAL_PAYMENT_PERC_MAX"], perc.max().reindex(got.index))
    assert "NAME_CONTRACT_STATUS_Unused_offer_MEAN" in got and "BUREAU_BB_STATUS_1_MEAN_MEAN" in got
    bureau = tables["bureau"].groupby(c.KEY)
    np.testing.assert_allclose(got["BUREAU_AMT_ANNUITY_SUM"].astype(float), bureau.AMT_ANNUITY.sum().reindex(got.index))


def test_same_result_for_any_partitioning(spark):
    bureau = credit.to_spark(spark, credit.history(range(30))["bureau"])
    spec = RollupSpec(c.KEY, "B", {"CREDIT_DAY_OVERDUE": ["sum", "mean", "nunique"]})
    one = sorted(rollup(bureau.coalesce(1), spec).collect())
    assert one == sorted(rollup(bureau.repartition(13), spec).collect())
