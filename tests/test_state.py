import credit
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import state
from riskloom.operators.features import FeatureEngineer, application_features
from riskloom.operators.state import NotFittedError, Preprocessor
from riskloom.sources import contracts as c


def likelihood(x, p):
    size, m = np.log1p(np.abs(x)), np.where(x < 0, 2 - p, p)
    t = np.sign(x) * np.where(np.abs(m) < 1e-12, size, np.expm1(m * size) / np.where(m == 0, 1, m))
    return -0.5 * np.log(t.var()) + (p - 1) * (np.sign(x) * size).mean()


@pytest.mark.parametrize("kind", ["lognormal", "signed", "left", "ties"])
def test_power_maximises_the_likelihood(spark, kind):
    rng = np.random.default_rng(5)
    x = {
        "lognormal": rng.lognormal(8, 1.5, 3000),
        "signed": rng.normal(1, 3, 3000) ** 3,
        "left": -rng.exponential(20, 3000),
        "ties": rng.integers(0, 5, 3000).astype(float),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(5)
    p = state.fit_yeo_johnson(df, ["x"])["x"]
    grid = np.linspace(p - 0.5, p + 0.5, 2001)
    assert abs(grid[np.argmax([likelihood(x, g) for g in grid])] - p) < 6e-4


def test_power_of_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(3.0, None), (3.0, None)], "a double, b double")
    assert state.fit_yeo_johnson(df, ["a", "b"]) == {"a": 1.0, "b": 1.0}


def test_scales(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    fitted = state.fit_standard(df, ["a", "b"])
    assert fitted["a"][1] == pytest.approx(np.std([1, 2, 4]))
    assert [r[0] for r in df.select(state.standardise(F.col("b"), *fitted["b"])).collect()] == [0.0] * 3
    assert [r[0] for r in df.select(state.min_max(F.col("b"), 5.0, 5.0)).collect()] == [0.0] * 3


def test_edges_are_unique_and_not_refitted(spark):
    train = spark.createDataFrame([(1.0,)] * 8 + [(2.0,), (9.0,)], "x double")
    edges = state.fit_quantile_edges(train, ["x"])
    assert edges["x"][0] == 1.0 and len(edges["x"]) == len(set(edges["x"]))
    test = spark.createDataFrame([(1.0,), (100.0,), (None,)], "x double")
    assert [r["b"] for r in state.quantile_bins(test, {"b": "x"}, edges).collect()] == [0, None, None]


def preprocessed(spark):
    frame = credit.applications(300)
    df = credit.to_spark(spark, frame).withColumn("nothing", F.lit(None).cast("double"))
    numeric = ["AMT_CREDIT", "OWN_CAR_AGE", "DAYS_BIRTH", "nothing"]
    return df, Preprocessor(numeric, ["CODE_GENDER"]).fit(df)


def test_preprocessor_outputs(spark):
    df, pre = preprocessed(spark)
    out = pre.transform(df, keep=[c.KEY]).toPandas()
    assert list(out) == [c.KEY, *pre.outputs]
    assert "num__nothing" not in out and "cat__CODE_GENDER_F" not in out
    numbers = out[[n for n in pre.outputs if n.startswith("num__")]]
    assert np.allclose(numbers.mean(), 0, atol=1e-9) and np.allclose(numbers.std(ddof=0), 1)
    assert not out.isna().any().any()


def test_preprocessor_applies_without_refitting(spark, tmp_path):
    df, pre = preprocessed(spark)
    other = credit.to_spark(spark, credit.applications(40, seed=8, income_scale=1e6)).withColumn("nothing", F.lit(1.0))
    other = other.withColumn("CODE_GENDER", F.lit("unseen"))
    before = (dict(pre.medians), dict(pre.powers), dict(pre.scales))
    out = pre.transform(other)
    assert out.select(*[n for n in pre.outputs if n.startswith("cat__")]).distinct().collect()[0] == (0.0, 0.0)
    assert (pre.medians, pre.powers, pre.scales) == before
    pre.save(spark, str(tmp_path / "state"))
    loaded = Preprocessor.load(spark, str(tmp_path / "state"))
    assert loaded == pre
    assert loaded.transform(other).collect() == out.collect()


def test_empty_column_lists_and_unfitted(spark):
    df = spark.createDataFrame([(1, 2.0)], "k int, x double")
    assert Preprocessor([], []).fit(df).transform(df, keep=["k"]).columns == ["k"]
    with pytest.raises(NotFittedError, match="fit"):
        Preprocessor(["x"], []).transform(df)
    with pytest.raises(NotFittedError, match="fit"):
        FeatureEngineer().transform(df)


# --------------------------------------------------------------------------
# application features


def test_minimal_row(spark):
    row = {
        "SK_ID_CURR": 100001, "AMT_INCOME_TOTAL": 150000.0, "AMT_CREDIT": 450000.0, "AMT_ANNUITY": 22500.0,
        "DAYS_BIRTH": -12000, "DAYS_EMPLOYED": -2000, "EXT_SOURCE_1": 0.5, "EXT_SOURCE_2": 0.6, "EXT_SOURCE_3": 0.4,
        "FLAG_OWN_CAR": "Y",
    }
    df = spark.createDataFrame([row]).withColumn("OWN_CAR_AGE", F.lit(None).cast("double"))
    got = application_features(df).first()
    assert (got["DAYS_EMPLOYED_ANOMALY"], got["FLAG_OWN_CAR"]) == (0, 0)
    assert got["YEARS_BIRTH"] == pytest.approx(12000 / 365)
    assert (got["CREDIT_INCOME_PERCENT"], got["ANNUITY_INCOME_PERCENT"]) == pytest.approx((3.0, 0.15))
    assert (got["PAYMENT_RATE"], got["EXT_SOURCE_PRODUCT"]) == pytest.approx((0.05, 0.12))


def test_edge_rows(spark):
    df = spark.createDataFrame(
        [(1, 0.0, 10.0, 365243, None), (2, 5.0, 0.0, -3, 0.2)],
        "SK_ID_CURR long, AMT_INCOME_TOTAL double, AMT_CREDIT double, DAYS_EMPLOYED long, EXT_SOURCE_1 double",
    )
    a, b = application_features(df).orderBy("SK_ID_CURR").collect()
    assert (a["DAYS_EMPLOYED_ANOMALY"], a["DAYS_EMPLOYED"], a["CREDIT_INCOME_PERCENT"]) == (1, None, None)
    assert (b["DAYS_EMPLOYED_ANOMALY"], b["DAYS_EMPLOYED"], b["PAYMENT_RATE"]) == (0, -3, None)
    assert a["EXT_SOURCE_PRODUCT"] is None and b["EXT_SOURCE_PRODUCT"] is None


def test_engineer_contract(spark, tmp_path):
    train = credit.to_spark(spark, credit.applications(200))
    test = credit.to_spark(spark, credit.applications(50, seed=4, first_key=500000, income_scale=1e6))
    hist = spark.createDataFrame([(100001, 2.5), (7, 1.0)], "SK_ID_CURR long, POS_SK_DPD_MEAN double")
    engineer = FeatureEngineer(hist, keep_bins=True).fit(train.drop("TARGET"))
    edges = {k: list(v) for k, v in engineer.edges.items()}
    out = engineer.transform(test)
    assert engineer.edges == edges
    assert out.columns == [c.KEY, *c.MAIN_FEATURES, *c.QUANTILE_BINS, "POS_SK_DPD_MEAN"]
    assert out.count() == 50
    # incomes are ten times those of the training rows, so many fall outside the edges
    assert out.where(F.col("INCOME_QUANTILE_BINS").isNull()).count() > 0
    assert out.where(F.col("TOTALAREA_MODE").isNotNull()).count() == 0
    encoded = engineer.transform(train).agg(
        F.sum("CODE_GENDER_M"), F.sum("NAME_FAMILY_STATUS_Single___not_married"), F.count("NAME_EDUCATION_TYPE_ENCODED")
    ).first()
    assert all(v > 0 for v in encoded)
    chosen = FeatureEngineer(hist, final_features=["POS_SK_DPD_MEAN", "PAYMENT_RATE", "absent"]).fit(train)
    assert chosen.transform(train).columns == [c.KEY, "POS_SK_DPD_MEAN", "PAYMENT_RATE"]
    engineer.save(spark, str(tmp_path / "f"))
    again = FeatureEngineer(hist, keep_bins=True).load(spark, str(tmp_path / "f"))
    assert sorted(again.transform(test).collect()) == sorted(out.collect())


@pytest.mark.parametrize("outlier, size", [(1e9, 1000.0), (-1e12, 1e6)])
def test_power_fit_beside_an_outlier(spark, outlier, size):
    rng = np.random.default_rng(3)
    values = np.append(size + rng.gamma(2.0, 3.0, 4000), outlier)
    power = state.fit_yeo_johnson(spark.createDataFrame([(float(v),) for v in values], "x double"), ["x"])["x"]

    def likelihood(p):
        m = np.where(values < 0, 2 - p, p)
        log = np.log1p(np.abs(values))
        with np.errstate(over="ignore", invalid="ignore"):
            t = np.sign(values) * np.where(np.abs(m) < 1e-12, log, np.expm1(m * log) / np.where(m == 0, 1, m))
            spread = t.var()
        return -0.5 * np.log(spread) + (p - 1) * (np.sign(values) * log).mean() if 0 < spread < np.inf else -np.inf

    # far from zero the variances themselves carry rounding noise of this size
    assert likelihood(power) >= max(likelihood(p) for p in np.arange(-20, 20, 0.25)) - 0.01
