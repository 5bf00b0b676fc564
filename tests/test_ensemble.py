"""Early stopping with patience: losses of all beginnings of an ensemble, the best round, and the truncated model."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskloom.operators import ensemble, model
from riskloom.session import stage

SETTINGS = {"n_estimators": 12, "learning_rate": 0.5, "max_depth": 3, "num_leaves": 8, "min_data_in_leaf": 5, "bagging_fraction": 0.8}


@pytest.fixture(scope="module")
def parts(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(900, 4)), 2)
    y = (x[:, 0] + 0.5 * x[:, 1] * x[:, 2] + rng.normal(size=900) > 0).astype(int)
    rows = stage(spark.createDataFrame([(int(b), Vectors.dense(a), i) for i, (a, b) in enumerate(zip(x, y))], ["y", "features", "i"]))
    return rows.where("i < 600").select("y", "features"), rows.where("i >= 600").select("y", "features")


@pytest.fixture(scope="module")
def fitted(parts):
    return model.fit_booster(parts[0], "y", SETTINGS)


def loss(booster, rows):
    """Mean log loss of the model's own probabilities."""
    p = F.get(vector_to_array("probability"), F.lit(1))
    return booster.transform(rows).agg(F.avg(-F.when(F.col("y") == 1, F.log(p)).otherwise(F.log(1 - p)))).first()[0]


def test_losses_equal_an_evaluation_of_every_round(parts, fitted):
    got = ensemble.prefix_losses(fitted, parts[1], "y")
    want = [loss(ensemble.truncate(fitted, n), parts[1]) for n in range(1, len(got) + 1)]
    assert len(got) == 12 and got == pytest.approx(want, rel=1e-9)
    assert loss(fitted, parts[1]) == pytest.approx(got[-1], rel=1e-9)


def test_longer_fits_begin_alike(parts, fitted, spark):
    short = model.fit_booster(parts[0], "y", {**SETTINGS, "n_estimators": 5})
    nodes = [sorted(map(tuple, ensemble.node_table(m, spark).where("tree < 5").fillna(0.0).collect())) for m in (short, fitted)]
    assert nodes[0] == nodes[1] and len(nodes[0]) > 20


def test_the_best_round_is_kept(parts, fitted):
    losses = ensemble.prefix_losses(fitted, parts[1], "y")
    for patience in (1, 2, 4, 50):
        best, seen = 0, 0
        for i, value in enumerate(losses):  # round by round, as a trainer that waits would
            best, seen = (i, 0) if value < losses[best] else (best, seen + (i > 0))
            if seen == patience:
                break
        stopped = model.fit_booster(parts[0], "y", SETTINGS, valid=parts[1], patience=patience)
        assert len(stopped.treeWeights) == best + 1
        assert loss(stopped, parts[1]) == pytest.approx(losses[best], rel=1e-9)


def test_when_to_stop():
    assert ensemble.early_stop([3, 2, 1, 2, 3, 0], 2) == (3, True)
    assert ensemble.early_stop([3, 2, 1, 2, 3, 0], 4) == (6, False)
    assert ensemble.early_stop([1, 1, 1], 2) == (1, True)  # no better is no better


def test_a_truncated_model_is_saved_and_read(parts, fitted, tmp_path):
    short = ensemble.truncate(fitted, 3)
    short.write().overwrite().save(str(tmp_path / "m"))
    again = type(short).load(str(tmp_path / "m"))
    assert len(again.treeWeights) == 3 and loss(again, parts[1]) == pytest.approx(loss(short, parts[1]))
    assert sum(short.featureImportances.toArray()) == pytest.approx(1)
