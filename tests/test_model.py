import itertools
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import explain, model
from riskloom.operators.split import train_test
from riskloom.plans.queries_model import model_comparison

NAMES = ["a", "b", "d"]


@pytest.fixture(scope="module")
def parts(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 3))
    y = rng.random(1500) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] * (x[:, 1] > 0))))
    rows = [(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y))]
    df = train_test(spark.createDataFrame(rows, "k long, a double, b double, d double, y int"), "k", "y")
    whole = model.assemble(df, NAMES, ["k", "y", "part", *NAMES]).cache()
    return whole.where("part = 'train'"), whole.where("part = 'test'")


QUICK = {"n_estimators": 8, "learning_rate": 0.3, "max_depth": 3, "num_leaves": 8, "min_data_in_leaf": 5}


@pytest.fixture(scope="module")
def booster(parts):
    return model.fit_booster(parts[0].select("y", model.FEATURES), "y", QUICK)


def test_comparison(parts):
    contenders = model.default_contenders("y", booster_rounds=5, forest_trees=10)
    rows = model.compare_models(*parts, "y", contenders).collect()
    assert [r["model"] for r in rows] == ["Logistic Regression", "Random Forest", "Gradient Boosting"]
    assert all(0.7 < r["roc_auc"] < 0.99 and 0 < r["brier_score"] < 0.25 for r in rows)


def test_the_comparison_query_fits_every_round_and_tree(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(9)
    orders = [
        (k, float(rng.uniform(1000, 500000)), f"199{k % 7}-0{1 + k % 9}-1{k % 10}", ("2-HIGH", "3-MEDIUM", "5-LOW", "4-NOT SPECIFIED")[k % 4], "FOP"[k % 3])
        for k in range(600)
    ]
    lines = [(k, float(rng.integers(1, 50)), float(rng.integers(0, 10)) / 100, float(rng.uniform(900, 90000))) for k in range(600) for _ in range(3)]
    schema = "o_orderkey long, o_totalprice double, o_orderdate string, o_orderpriority string, o_orderstatus string"
    spark.createDataFrame(orders, schema).withColumn("o_orderdate", F.to_date("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    schema = "l_orderkey long, l_quantity double, l_discount double, l_extendedprice double"
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    asked = {}

    def quick(kind, size):  # notes what is asked of the engine, and fits two trees
        def make(**settings):
            asked[kind.__name__] = settings
            return kind(**{**settings, size: 2})

        return make

    for kind, size in ((model.RandomForestClassifier, "numTrees"), (model.GBTClassifier, "maxIter")):
        monkeypatch.setattr(model, kind.__name__, quick(kind, size))
    rows = model_comparison(spark, str(tmp_path)).collect()
    assert [r["model"] for r in rows] == ["Logistic Regression", "Random Forest", "Gradient Boosting"]
    forest, booster = asked["RandomForestClassifier"], asked["GBTClassifier"]
    assert forest["numTrees"] == 100
    assert [booster[k] for k in ("maxIter", "stepSize", "maxDepth", "minInstancesPerNode", "subsamplingRate")] == [300, 0.1, 5, 20, 1.0]


def test_logistic_matches_newton(parts):
    train = parts[0]
    fit = model.fit_logistic(train, "y", inverse_penalty=0.05, balanced=True)
    rows = train.select(*NAMES, "y").toPandas()
    x, y = np.c_[rows[NAMES].to_numpy(), np.ones(len(rows))], rows.y.to_numpy()
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    beta, ridge = np.zeros(4), np.diag([1 / 0.05] * 3 + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        beta -= np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (w * (p - y)) + ridge @ beta)
    assert [*fit.coefficients, fit.intercept] == pytest.approx(beta, abs=1e-4)


def test_a_stopped_search_goes_on(parts, spark, tmp_path, monkeypatch):
    record = str(tmp_path / "search")
    draws = model.random_params(4, space=[("n_estimators", 2, 3, "int"), ("learning_rate", 0.1, 0.4, "log")])
    fitted, fit = [], model.fit_booster

    def stopping(train, label, params, **more):
        if len(fitted) == 2:
            raise RuntimeError("the driver is lost")
        fitted.append(params)
        return fit(train, label, params, **more)

    monkeypatch.setattr(model, "fit_booster", stopping)
    with pytest.raises(RuntimeError):
        model.search_params(*parts, "y", draws, parallelism=1, record=record)
    assert fitted == draws[:2]
    (tmp_path / "search" / "trial-00003.json").write_text('{"trial":3,"roc_au')  # half written when the driver went
    fitted.clear()
    monkeypatch.setattr(model, "fit_booster", lambda *a, **k: (fitted.append(a[2]), fit(*a, **k))[1])
    resumed = model.search_params(*parts, "y", draws, parallelism=1, record=record)
    assert fitted == draws[2:]
    fitted.clear()
    assert model.search_params(*parts, "y", draws, record=record) == resumed and not fitted  # nothing is left to fit
    assert resumed == model.search_params(*parts, "y", draws, parallelism=1)
    fitted.clear()
    model.search_params(*parts, "y", [{**draws[0], "n_estimators": 4}], record=record)
    assert len(fitted) == 1  # other parameters under the same number


def test_search_and_sweep(parts, spark):
    draws = model.random_params(2, space=[("n_estimators", 2, 4, "int"), ("learning_rate", 0.1, 0.4, "log")])
    assert draws == model.random_params(2, space=[("n_estimators", 2, 4, "int"), ("learning_rate", 0.1, 0.4, "log")])
    found = model.search_params(*parts, "y", draws)
    assert found.best_auc == max(a for _, a, _ in found.trials) and found.table(spark).count() == 2
    plain = [p.drop(model.FEATURES) for p in parts]
    table, best = model.sweep_feature_counts(*plain, "y", ["a", "b", "d"], [1, 3], QUICK)
    assert best in (1, 3) and table.count() == 2


def test_search_ranges():
    for draw in model.random_params(50):
        for name, low, high, _ in model.SEARCH_SPACE:
            assert low <= draw[name] <= high


def test_booster_settings():
    got = model.booster_settings(model.BOOSTER_PARAMS)
    assert (got["maxIter"], got["maxDepth"], got["minInstancesPerNode"]) == (766, 5, 51)


def test_importances(booster, spark):
    rows = model.importance_table(booster, [f"num__{n}" for n in NAMES], spark, 2).collect()
    assert [r["feature"] for r in rows] == ["a", "b"] and rows[0]["importance"] > 0.5
    assert model.rank_features(booster, NAMES)[0] == "a"


def test_scores_are_probabilities_and_repeatable(parts, booster):
    again = model.fit_booster(parts[0].select("y", model.FEATURES), "y", QUICK)
    one = model.with_probability(booster, parts[1], ["k"]).orderBy("k").collect()
    assert one == model.with_probability(again, parts[1], ["k"]).orderBy("k").collect()
    assert all(0 <= r["score"] <= 1 for r in one)


def shapley(node, x):
    """Path-dependent Shapley values by summing over all feature subsets."""

    def value(n, known):
        if n.getClass().getSimpleName() == "LeafNode":
            return n.prediction()
        f, at = n.split().featureIndex(), n.split().threshold()
        if f in known:
            return value(n.leftChild() if x[f] <= at else n.rightChild(), known)
        whole = n.impurityStats().rawCount()
        return sum(value(ch, known) * ch.impurityStats().rawCount() / whole for ch in (n.leftChild(), n.rightChild()))

    m, out = len(x), np.zeros(len(x))
    for i in range(m):
        others = [j for j in range(m) if j != i]
        for size in range(m):
            for s in itertools.combinations(others, size):
                weight = factorial(size) * factorial(m - size - 1) / factorial(m)
                out[i] += weight * (value(node, {*s, i}) - value(node, set(s)))
    return out


def test_tree_attributions(parts, booster):
    test = parts[1]
    got = explain.tree_attributions(booster, test, "k", NAMES)
    margin = booster.transform(test).select("k", *NAMES, F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("m"))
    rows = got.join(margin, "k").orderBy("k").collect()
    assert all(r["base"] + sum(r["attributions"]) == pytest.approx(r["m"]) for r in rows)
    trees = list(zip(booster._java_obj.trees(), booster.treeWeights))
    for r in rows[:3]:
        want = sum(w * shapley(t.rootNode(), [r[n] for n in NAMES]) for t, w in trees)
        assert r["attributions"] == pytest.approx(want)


def test_linear_attributions_add_up(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, 0.0, 5.0)], "k int, a double, b double")
    weights, means = {"a": 0.5, "b": -2.0}, {"a": 1.0, "b": 4.0}
    base = explain.linear_base(weights, means, 0.7)
    parts = explain.linear_attributions(weights, means)
    rows = df.select("a", "b", (parts["a"] + parts["b"] + base).alias("m")).collect()
    assert [r["m"] for r in rows] == pytest.approx([0.7 + 0.5 * r["a"] - 2 * r["b"] for r in rows])


def test_factors_and_texts(spark):
    df = spark.createDataFrame([(1, 0.3, -0.2, 0.0), (2, 0.0, 0.0, 0.0)], "k int, a double, b double, c double")
    values = {"num__PAYMENT_RATE": F.col("a"), "cat__CODE_GENDER_M": F.col("b"), "num__SOME_THING": F.col("c")}
    first, second = explain.top_factors(df, ["k"], values).orderBy("k").collect()
    assert [tuple(f) for f in first["top_risk_factors"]] == [("num__PAYMENT_RATE", "annuity-to-credit ratio (payment rate)", 0.3)]
    assert [f["label"] for f in first["top_protective_factors"]] == ["gender (male)"]
    assert second["top_risk_factors"] == [] and second["text_summary"].count("  None") == 2
    assert first["text_summary"].splitlines()[2] == "  • annuity-to-credit ratio (payment rate)"
    ranked = explain.top_factors(df, ["k"], values).where("k = 1")
    text = ranked.select(explain.report_text(F.lit(0.123), "top_risk_factors", "top_protective_factors")).first()[0]
    assert "Risk score: 12.3%" in text and "↑  annuity-to-credit ratio (payment rate) (impact: +0.3000)" in text
    assert "↓  gender (male) (impact: -0.2000)" in text


def test_labels():
    assert explain.feature_label("num__SOME_x2y THING") == "Some X2Y Thing"
    assert explain.feature_label("num__FLAG_OWN_CAR") == "car ownership flag"


def test_global_importance(spark):
    df = spark.createDataFrame([(1.0, -3.0), (-2.0, 1.0)], "a double, b double")
    rows = explain.global_importance(df, {"a": F.col("a"), "b": F.col("b")}, top=1).collect()
    assert [tuple(r) for r in rows] == [("b", "B", 2.0)]


def test_patterns_counted_and_sorted_agree(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 6))
    x[::50] = np.nan
    boxes = [(f, -0.8, 0.5 + f / 9, 0.5) for f in (4, 0, 5, 2)]
    used = [f for f, *_ in boxes]
    hits, place = np.unique((x[:, used] > -0.8) & (x[:, used] <= [b[2] for b in boxes]), axis=0, return_inverse=True)
    for counted in (12, 0):
        monkeypatch.setattr(explain, "_COUNTED", counted)
        got, at = explain._patterns(np.ascontiguousarray(x.T), boxes)
        assert (got == hits).all() and (at == place.ravel()).all()
