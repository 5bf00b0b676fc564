"""Classifiers on Spark ML, their comparison, search and importances."""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.operators.ensemble import early_stop, prefix_losses, truncate
from riskloom.operators.evaluate import full_metrics, ranking_metrics
from riskloom.session import stage
from riskloom.sources.sinks import write_json
from riskloom.sources.tables import path_exists

FEATURES = "features"
PROBABILITY = "probability"

# ---- fixed values: tuned parameters of the boosted model
BOOSTER_PARAMS = {
    "n_estimators": 766,
    "learning_rate": 0.14661696258280738,
    "max_depth": 15,
    "num_leaves": 24,
    "min_data_in_leaf": 51,
    "feature_fraction": 0.9287838567079353,
    "bagging_fraction": 0.9495916039524935,
}

# ---- fixed values: search ranges (name, low, high, scale)
SEARCH_SPACE = [
    ("n_estimators", 100, 2000, "int"),
    ("learning_rate", 1e-3, 0.2, "log"),
    ("max_depth", 3, 15, "int"),
    ("num_leaves", 20, 400, "int"),
    ("min_data_in_leaf", 10, 100, "int"),
    ("feature_fraction", 0.5, 1.0, "uniform"),
    ("bagging_fraction", 0.5, 1.0, "uniform"),
]


def assemble(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Feature vector plus the kept columns; only these travel to the trainer."""
    assembler = VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="error")
    return assembler.transform(df).select(*keep, FEATURES)


def balanced_weight(df: DataFrame, label: str) -> Column:
    """``n / (2 * n_class)`` per row."""
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(sizes.values())
    weight = F.lit(None).cast("double")
    for value, size in sizes.items():
        weight = F.when(F.col(label) == value, F.lit(n / (len(sizes) * size))).otherwise(weight)
    return weight


def positive_probability(c: Column | str = PROBABILITY) -> Column:
    return F.get(vector_to_array(c), F.lit(1))


def with_probability(model: Model, assembled: DataFrame, keep: Sequence[str], name: str = "score") -> DataFrame:
    return model.transform(assembled).select(*keep, positive_probability().alias(name))


# --------------------------------------------------------------------------
# the three classifiers


def fit_logistic(
    train: DataFrame, label: str, inverse_penalty: float = 1.0, balanced: bool = False, max_iter: int = 1000
) -> Model:
    """L2 logistic regression; the penalty is ``1 / (C * n)`` per unit of mean loss."""
    n = train.count()
    columns = {"labelCol": label, "featuresCol": FEATURES}
    if balanced:
        train = train.withColumn("_weight", balanced_weight(train, label))
        columns["weightCol"] = "_weight"
    return LogisticRegression(
        **columns, maxIter=max_iter, regParam=1.0 / (inverse_penalty * n), elasticNetParam=0.0, standardization=False
    ).fit(train)


def fit_forest(train: DataFrame, label: str, trees: int = 100, max_depth: int = 10, seed: int = 42) -> Model:
    weighted = train.withColumn("_weight", balanced_weight(train, label))
    return RandomForestClassifier(
        labelCol=label, featuresCol=FEATURES, weightCol="_weight", numTrees=trees, maxDepth=max_depth, seed=seed
    ).fit(weighted)


def booster_settings(params: Mapping) -> dict:
    """Library-neutral parameters in Spark's terms.

    Spark grows trees level by level, so a leaf budget becomes the depth that
    holds as many leaves.
    """
    depth = min(int(params.get("max_depth", 6)), max(1, round(math.log2(params.get("num_leaves", 31)))))
    return {
        "maxIter": int(params.get("n_estimators", 100)),
        "stepSize": float(params.get("learning_rate", 0.1)),
        "maxDepth": depth,
        "minInstancesPerNode": int(params.get("min_data_in_leaf", 20)),
        "featureSubsetStrategy": str(float(params.get("feature_fraction", 1.0))),
        "subsamplingRate": float(params.get("bagging_fraction", 1.0)),
    }


def fit_booster(
    train: DataFrame, label: str, params: Mapping = BOOSTER_PARAMS, valid: DataFrame | None = None, seed: int = 42, patience: int = 50
) -> Model:
    """Gradient-boosted trees; with validation rows, those of the round after which ``patience`` rounds bring no lower loss.

    The engine cannot wait for a better round, so ever longer ensembles are fitted (the same seed begins them alike) until the best
    round lies ``patience`` rounds back or the full number is reached; the rest is cut off. This costs at most twice
    the rounds of a fit that stops there, and every length is judged by one pass over the validation rows.
    """
    settings = booster_settings(params)
    if settings["featureSubsetStrategy"] == "1.0":
        settings["featureSubsetStrategy"] = "all"
    rounds = settings.pop("maxIter")

    def fit(n: int) -> Model:
        return GBTClassifier(
            labelCol=label, featuresCol=FEATURES, maxIter=n, **settings, seed=seed, checkpointInterval=10).fit(train)

    if valid is None:
        return fit(rounds)
    n = min(rounds, 2 * patience)
    while True:
        fitted = fit(n)
        best, stopped = early_stop(prefix_losses(fitted, valid, label, FEATURES), patience)
        if stopped or n == rounds:
            return truncate(fitted, best)
        n = min(rounds, 2 * n)


# --------------------------------------------------------------------------
# comparison, search, selection


def auc(model: Model, assembled: DataFrame, label: str) -> float:
    scored = with_probability(model, assembled, [label])
    return ranking_metrics(scored, label, "score").first()["roc_auc"]


@dataclass
class Contender:
    name: str
    fit: Callable[[DataFrame], Model]


def default_contenders(label: str, seed: int = 42, booster_rounds: int = 300, forest_trees: int = 100) -> list[Contender]:
    booster = {"n_estimators": booster_rounds, "learning_rate": 0.1, "num_leaves": 31, "max_depth": 6}
    return [
        Contender("Logistic Regression", lambda t: fit_logistic(t, label, balanced=True)),
        Contender("Random Forest", lambda t: fit_forest(t, label, trees=forest_trees, seed=seed)),
        Contender("Gradient Boosting", lambda t: fit_booster(t, label, booster, seed=seed)),
    ]


def compare_models(
    train: DataFrame, valid: DataFrame, label: str, contenders: Sequence[Contender]
) -> DataFrame:
    """One row per model: quality on the validation rows and times.

    ``train`` and ``valid`` are read by every fit, so pass them materialised.
    """
    n_valid = valid.count()
    rows = []
    for contender in contenders:
        started = time.perf_counter()
        model = contender.fit(train)
        fitted = time.perf_counter()
        scored = stage(with_probability(model, valid, [label]))  # the metrics read the scores twice
        m = full_metrics(scored, label, "score", 0.5).first()
        done = time.perf_counter()
        rows.append((
            contender.name,
            *[round(float(m[c]), 4) for c in ("roc_auc", "pr_auc", "recall", "precision", "f1", "brier_score")],
            round(fitted - started, 1),
            round((done - fitted) * 1000 / max(n_valid, 1), 3),
        ))
    return train.sparkSession.createDataFrame(
        rows,
        "model string, roc_auc double, pr_auc double, recall_at_half double, precision_at_half double, "
        "f1_at_half double, brier_score double, train_seconds double, inference_ms_per_row double",
    )


def random_params(trials: int, seed: int = 42, space: Sequence[tuple] = SEARCH_SPACE) -> list[dict]:
    """Seeded draws from the search ranges."""
    rng = np.random.default_rng(seed)
    draws = []
    for _ in range(trials):
        draw = {}
        for name, low, high, scale in space:
            if scale == "int":
                draw[name] = int(rng.integers(low, high + 1))
            elif scale == "log":
                draw[name] = float(math.exp(rng.uniform(math.log(low), math.log(high))))
            else:
                draw[name] = float(rng.uniform(low, high))
        draws.append(draw)
    return draws


@dataclass
class SearchResult:
    best: dict
    best_auc: float
    trials: list[tuple[int, float, dict]] = field(default_factory=list)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, a, {k: float(v) for k, v in p.items()}) for i, a, p in self.trials]
        return spark.createDataFrame(rows, "trial int, roc_auc double, params map<string,double>")


def _finished(spark: SparkSession, record: str, trials: Sequence[Mapping], seed: int) -> dict[int, float]:
    """AUC of the trials that are on record with these parameters and this seed."""
    if not path_exists(spark, record):
        return {}
    rows = spark.read.schema("trial int, roc_auc double, params string, seed long").json(record).collect()
    return {
        r["trial"]: r["roc_auc"] for r in rows
        if r["params"] is not None and r["roc_auc"] is not None and r["seed"] == seed
        and r["trial"] is not None and r["trial"] < len(trials) and json.loads(r["params"]) == dict(trials[r["trial"]])
    }


def search_params(
    train: DataFrame,
    valid: DataFrame,
    label: str,
    trials: Sequence[Mapping],
    parallelism: int = 2,
    seed: int = 42,
    record: str | None = None,
) -> SearchResult:
    """Fit every draw and keep the one with the highest AUC on the validation rows; the first of equals.

    With a folder for the ``record``, which belongs in shared storage, every trial writes a small document there as soon as it is
    done, and a search that is started again fits only what is missing. A trial counts as done if its number, parameters and
    seed agree; a document that a lost driver left half written does not. Tables that have changed need another folder.
    """
    spark = train.sparkSession
    known = _finished(spark, record, trials, seed) if record else {}

    def run(item):
        i, params = item
        if i in known:
            return i, known[i], dict(params)
        model = fit_booster(train, label, params, valid=valid, seed=seed)
        found = auc(model, valid, label)
        if record:
            row = [(i, float(found), json.dumps(dict(params)), seed)]
            write_json(spark.createDataFrame(row, "trial int, roc_auc double, params string, seed long"), f"{record}/trial-{i:05d}.json")
        return i, found, dict(params)

    with ThreadPool(parallelism) as pool:
        done = pool.map(run, list(enumerate(trials)), chunksize=1)
    best = max(done, key=lambda t: (t[1], -t[0]))
    return SearchResult(best[2], best[1], sorted(done, key=lambda t: t[0]))


def importance_table(model: Model, features: Sequence[str], spark: SparkSession, limit: int = 30) -> DataFrame:
    """``feature, importance, importance_raw``: shares of the total, largest first."""
    raw = model.featureImportances.toArray()
    total = float(raw.sum()) or 1.0
    rows = sorted(
        ((f.split("__")[-1], round(float(v) / total, 6), round(float(v), 6)) for f, v in zip(features, raw)),
        key=lambda r: (-r[1], r[0]),
    )[:limit]
    return spark.createDataFrame(rows, "feature string, importance double, importance_raw double")


def rank_features(model: Model, features: Sequence[str]) -> list[str]:
    raw = model.featureImportances.toArray()
    return [f for _, f in sorted(zip(-raw, features))]


def sweep_feature_counts(
    train: DataFrame,
    valid: DataFrame,
    label: str,
    ranked: Sequence[str],
    counts: Sequence[int],
    params: Mapping,
    seed: int = 42,
) -> tuple[DataFrame, int]:
    """``n_features, roc_auc`` for the top-k features, and the best k (the first on ties)."""
    rows = []
    for k in counts:
        top = list(ranked)[:k]
        model = fit_booster(assemble(train, top, [label]), label, params, seed=seed)
        rows.append((k, auc(model, assemble(valid, top, [label]), label)))
    best = max(rows, key=lambda r: r[1])[0]
    return train.sparkSession.createDataFrame(rows, "n_features int, roc_auc double"), best
