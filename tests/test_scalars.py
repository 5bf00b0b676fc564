import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.functions import binning, scalars as s


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def out(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_sentinel(spark):
    df = column(spark, [365243, -5, None], "long")
    assert out(df, s.sentinel_flag(F.col("x"), 365243)) == [1, 0, 0]
    assert out(df, s.drop_sentinel(F.col("x"), 365243)) == [None, -5, None]


def test_safe_ratio_and_product(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (None, 2.0), (1.0, None)], "a double, b double")
    assert out(df, s.safe_ratio(F.col("a"), F.col("b"))) == [0.5, None, None, None]
    assert out(df, s.product(F.col("a"), F.col("b"))) == [2.0, 0.0, None, None]


def test_differs_keeps_null(spark):
    df = column(spark, ["XAP", "HC", None], "string")
    assert out(df.where(s.differs(F.col("x"), "XAP")), F.col("x")) == ["HC", None]


def test_ordinal_and_recode(spark):
    df = column(spark, ["b", "a", "?", None], "string")
    assert out(df, s.ordinal(F.col("x"), {"a": 0, "b": 1})) == [1, 0, None, None]
    assert out(df, s.recode(F.col("x"), {"?": "unknown"})) == ["b", "a", "unknown", None]


def test_normalise_missing(spark):
    df = s.normalise_missing(column(spark, [1.0, float("nan"), float("inf"), float("-inf"), None]))
    assert out(df, F.col("x")) == [1.0, None, None, None, None]


def test_risk_band_edges(spark):
    df = column(spark, [0.1499999, 0.15, 0.1499994, 0.3, 0.5, 0.9, None])
    assert out(df, s.risk_band(F.col("x"))) == ["MEDIUM", "MEDIUM", "LOW", "HIGH", "VERY HIGH", "VERY HIGH", None]


def test_clean_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Cash loans` int, `a-b` int")
    assert s.clean_names(df).columns == ["Cash_loans", "a_b"]
    with pytest.raises(ValueError, match="collide"):
        s.clean_names(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))


@pytest.mark.parametrize("lowest", [True, False])
def test_cut_matches_pandas(spark, lowest):
    edges = [0.0, 1.0, 2.5, 7.0]
    values = [-1.0, 0.0, 0.5, 1.0, 1.0000001, 2.5, 6.9, 7.0, 7.1, None]
    got = out(column(spark, values), binning.cut(F.col("x"), edges, include_lowest=lowest))
    want = pd.cut(pd.Series(values, dtype=float), edges, labels=False, include_lowest=lowest)
    assert got == [None if math.isnan(w) else int(w) for w in want]


def test_cut_without_intervals(spark):
    assert out(column(spark, [3.0, None]), binning.cut(F.col("x"), [3.0])) == [None, None]


def test_grid_position_is_exact(spark):
    grid = [float(t) for t in np.linspace(0.01, 0.99, 200)]
    near = [np.nextafter(t, d) for t in grid for d in (-1, 2)]
    values = [0.0, 1.0, -5.0, *grid, *[float(v) for v in near]]
    got = out(column(spark, values), binning.grid_position(F.col("x"), grid))
    assert got == [int(np.searchsorted(grid, v, side="right")) for v in values]


def test_histogram_bin_matches_numpy(spark):
    rng = np.random.default_rng(3)
    values = [*rng.normal(size=500).tolist(), 0.0, 1.0]
    edges = binning.histogram_edges(min(values), max(values), 50)
    values += edges
    got = np.bincount(out(column(spark, values), binning.histogram_bin(F.col("x"), edges)), minlength=50)
    assert got.tolist() == np.histogram(values, bins=edges)[0].tolist()


def test_constant_range():
    assert binning.histogram_edges(2.0, 2.0, 4) == [1.5, 1.75, 2.0, 2.25, 2.5]


def test_one_hot(spark):
    df = column(spark, ["b", "a", None, "new"], "string")
    rows = df.select(*binning.one_hot("x", ["b", "a", "c"], drop_first=True)).collect()
    assert rows[0].asDict() == {"x_b": 1.0, "x_c": 0.0}
    assert [sum(r) for r in rows] == [1.0, 0.0, 0.0, 0.0]
