"""Keyed tables: what a lookup finds, and what it reads."""

import re

import pytest
from pyspark.sql import functions as F

from riskloom.operators.history import attach
from riskloom.sources.keyed import FOLDER, folder_of, open_keyed, write_keyed


@pytest.fixture(scope="module")
def orders(spark, small):
    return spark.read.parquet(f"{small}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")


@pytest.fixture(scope="module")
def store(spark, orders, tmp_path_factory):
    return write_keyed(orders, str(tmp_path_factory.mktemp("keyed") / "orders"), "o_orderkey", folders=64)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_whole_table_comes_back(spark, orders, store):
    assert sorted(store.read(spark).collect()) == sorted(orders.collect())
    assert store.read(spark).columns == orders.columns


def test_few_keys_read_their_folders_only(spark, orders, store):
    keys = orders.orderBy("o_orderkey").limit(5).select(F.col("o_orderkey").cast("int").alias("o_orderkey"))  # another type
    found = store.lookup(keys)
    hit = {r[0] for r in keys.select(folder_of(F.col("o_orderkey").cast("long"), 64)).collect()}
    assert len(hit) <= 5
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(found)).group(1)
    assert FOLDER in filters
    read = {int(re.search(rf"{FOLDER}=(\d+)", f).group(1)) for f in found.inputFiles()}
    assert read >= hit  # the files of the table
    touched = {r[0] for r in found.select(folder_of(F.col("o_orderkey"), 64)).distinct().collect()}
    assert touched <= hit
    want = orders.join(keys, "o_orderkey").collect()
    assert sorted(found.join(keys, "o_orderkey").collect()) == sorted(want) and want


def test_joined_rows_are_those_of_the_plain_join(spark, orders, store):
    some = orders.where("o_orderkey % 7 = 0").select("o_orderkey").unionByName(
        spark.createDataFrame([(None,), (-5,), (-5,)], "o_orderkey long"))
    key = lambda r: tuple((v is not None, v) for v in r)
    want = sorted(attach(some, orders, "o_orderkey").collect(), key=key)
    assert sorted(attach(some, store, "o_orderkey").collect(), key=key) == want
    with pytest.raises(ValueError):
        attach(some.withColumnRenamed("o_orderkey", "k"), store, "k")


def test_no_keys_and_all_keys(spark, orders, store):
    assert store.lookup(orders.limit(0)).count() == 0
    everything = store.lookup(orders)
    assert everything.count() == orders.count() and "PartitionFilters: []" in plan(everything)


def test_null_repeated_and_missing_values(spark, tmp_path):
    rows = [(None, 1.0), (3, float("nan")), (3, 2.0), (4, None)]
    kept = write_keyed(spark.createDataFrame(rows, "k long, x double"), str(tmp_path / "t"), "k", folders=3)
    keys = spark.createDataFrame([(3,), (None,)], "k long")
    found = kept.lookup(keys).join(keys, "k").collect()
    assert sorted((r["k"], r["x"] is None) for r in found) == [(3, False), (3, True)]
    assert kept.read(spark).count() == 4


def test_a_new_build_takes_over_when_complete(spark, orders, tmp_path):
    path = str(tmp_path / "t")
    old = write_keyed(orders.limit(10), path, "o_orderkey", folders=4)
    new = write_keyed(orders.limit(20), path, "o_orderkey", folders=8)
    assert open_keyed(spark, path) == new and new.path != old.path
    assert old.read(spark).count() == 10  # who opened it before still reads it
    empty = write_keyed(orders.limit(0), path, "o_orderkey", folders=8)
    assert empty.lookup(orders).count() == 0 and empty.read(spark).count() == 0


def test_names_and_places_are_checked(spark, orders, tmp_path):
    with pytest.raises(FileNotFoundError):
        open_keyed(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        write_keyed(orders.withColumn(FOLDER, F.lit(1)), str(tmp_path / "t"), "o_orderkey")
    with pytest.raises(ValueError):
        write_keyed(orders, str(tmp_path / "t"), "o_orderkey", folders=0)
