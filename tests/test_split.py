import math

import pytest
from pyspark.sql import functions as F

from riskloom.operators import split


def rows(spark, n=997, positive=7):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") % positive == 0).cast("int").alias("y"))


def test_sizes_ratio_and_partitioning(spark):
    df = rows(spark)
    parts = split.train_valid_test(df, "k", "y")
    sizes = {r["part"]: (r["n"], r["p"]) for r in parts.groupBy("part").agg(F.count("k").alias("n"), F.avg("y").alias("p")).collect()}
    test = math.ceil(0.15 * 997)
    assert sizes["test"][0] == test
    assert sizes["valid"][0] == math.ceil(0.15 / 0.85 * (997 - test))
    assert all(abs(p - 1 / 7) < 0.005 for _, p in sizes.values())
    again = split.train_valid_test(df.repartition(9), "k", "y")
    assert sorted(parts.collect()) == sorted(again.collect())
    other = split.train_valid_test(df, "k", "y", seed=1)
    assert sorted(parts.collect()) != sorted(other.collect())


def test_no_shuffle_of_the_rows(spark):
    plan = split.train_test(rows(spark), "k", "y")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_ties_in_the_hash_prefix(spark, monkeypatch):
    monkeypatch.setattr(split, "_HASH_DIGITS", 1)
    monkeypatch.setattr(split, "_HASH_RANGE", 16.0)
    parts = split.train_test(rows(spark), "k", "y").groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in parts} == {"test": 200, "train": 797}


def test_null_class_and_tiny_classes(spark):
    df = spark.createDataFrame([(i, None if i < 3 else "a") for i in range(20)], "k int, y string")
    sample = split.stratified_sample(df, "k", "y", share=0.5)
    assert sample.count() == 10
    assert sample.where("y is null").count() in (1, 2)


@pytest.mark.parametrize("sizes,total", [({0: 7, 1: 3}, 5), ({0: 1, 1: 1, 2: 1}, 2), ({"a": 10}, 4)])
def test_allocation_adds_up(sizes, total):
    got = split.allocate(sizes, total)
    assert sum(got.values()) == total and all(got[k] <= sizes[k] for k in sizes)


def test_random_rows(spark):
    df = rows(spark)
    first = split.random_rows(df, "k", 20)
    assert first.count() == 20 and sorted(first.collect()) == sorted(split.random_rows(df.repartition(5), "k", 20).collect())


def test_the_place_of_a_row_is_hashed_once(spark):
    from riskloom.operators.split import train_valid_test

    df = spark.range(2000).selectExpr("id AS k", "cast(id % 5 = 0 AS int) AS label")
    out = train_valid_test(df, "k", "label")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("md5(") == 1 and out.columns == ["k", "label", "part"]
