import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import ordered


def test_running_totals_with_hot_value(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([np.full(3000, 7.0), rng.normal(5, 4, 6000).round(2)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(7)
    counts = df.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    for buckets in (1, 5, 40):
        placed = ordered.with_buckets(counts, "v", buckets=buckets, sketch_from=df)
        rows = ordered.running(placed, ["v"], {"upto": F.col("n")}, following=["v"], preceding=["v"]).orderBy("v").collect()
        distinct, sizes = np.unique(values, return_counts=True)
        assert [r["upto"] for r in rows] == np.cumsum(sizes).tolist()
        assert [r["next_v"] for r in rows] == [*distinct[1:].tolist(), None]
        assert [r["prev_v"] for r in rows] == [None, *distinct[:-1].tolist()]


def test_running_totals_per_key_descending(spark):
    rows = [(k, float(v)) for k in "ab" for v in range(50)]
    df = spark.createDataFrame(rows, "k string, v double")
    placed = ordered.with_buckets(df, "v", ["k"], buckets=6, descending=True)
    got = {(r["k"], r["v"]): r["i"] for r in ordered.running(placed, ["v"], {"i": F.lit(1)}, ["k"], descending=True).collect()}
    assert got == {(k, v): 50 - int(v) for k, v in rows}


@pytest.mark.parametrize("n", [1, 2, 5, 1000])
def test_quantiles_match_numpy(spark, n):
    rng = np.random.default_rng(n)
    a, b = rng.normal(size=n), rng.integers(0, 4, n).astype(float)
    df = spark.createDataFrame([(float(x), float(y), None) for x, y in zip(a, b)], "a double, b double, c double")
    shares = [0.0, 0.1, 0.25, 0.5, 0.8, 1.0]
    got = ordered.exact_quantiles(df, ["a", "b", "c"], shares)
    assert got["a"] == np.quantile(a, shares).tolist()
    assert got["b"] == np.quantile(b, shares).tolist()
    assert got["c"] is None


def test_quantiles_through_brackets(spark):
    """A third of the rows share one value."""
    rng = np.random.default_rng(9)
    values = np.concatenate([np.full(20_000, 3.0), rng.exponential(5, 40_000)])
    df = spark.createDataFrame([(float(v),) for v in values], "a double").repartition(6)
    shares = [0.05, 0.3, 0.5, 0.77, 0.999]
    assert ordered.exact_quantiles(df, ["a"], shares)["a"] == np.quantile(values, shares).tolist()


def test_missed_bracket_is_searched_again(spark, monkeypatch):
    real = ordered.order_statistics
    calls = []

    def narrow(data, wanted):
        calls.append(len(wanted))
        shifted = [(c, low + 1e9, high + 1e9, r) for c, low, high, r in wanted] if len(calls) == 1 else wanted
        return real(data, shifted)

    monkeypatch.setattr(ordered, "order_statistics", narrow)
    df = spark.range(101).select(F.col("id").cast("double").alias("a"))
    assert ordered.exact_quantiles(df, ["a"], [0.5]) == {"a": [50.0]}
    assert len(calls) == 2


def test_heavy_tail_is_dealt_evenly(spark):
    rng = np.random.default_rng(5)
    values = rng.lognormal(0, 2.5, 20_000)
    df = spark.createDataFrame([(float(v),) for v in values], "a double")
    bucketed = ordered.with_buckets(df, "a", buckets=8)
    sizes = [r["count"] for r in bucketed.groupBy(ordered.BUCKET).count().collect()]
    assert max(sizes) < 2 * len(values) / 8
    shares = [0.0, 0.0001, 0.5, 0.9999, 1.0]
    assert ordered.exact_quantiles(df, ["a"], shares)["a"] == np.quantile(values, shares).tolist()
