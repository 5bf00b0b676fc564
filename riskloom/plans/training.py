"""Training from applications and history to a saved, calibrated scorer."""

from __future__ import annotations

import json
import platform
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

import pyspark
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.functions.scalars import numeric_columns, predicted_class, risk_band, string_columns
from riskloom.operators import explain, model
from riskloom.operators.calibrate import Calibrator, choose_calibrator
from riskloom.operators.isotonic import IsotonicFit
from riskloom.operators.evaluate import compact_metrics, threshold_candidates
from riskloom.operators.features import FeatureEngineer
from riskloom.operators.split import hash_text, train_valid_test
from riskloom.operators.state import Preprocessor
from riskloom.operators.validate import table_fingerprint
from riskloom.session import stage
from riskloom.sources import contracts as c
from riskloom.sources.keyed import KeyedTable

VERSION = "1.1.0"


@dataclass
class Scorer:
    """Fitted steps from a raw application row to a published score."""

    engineer: FeatureEngineer
    preprocessor: Preprocessor
    booster: Model
    calibrator: Calibrator = field(default_factory=Calibrator)
    threshold: float = 0.5
    version: str = VERSION

    def _features(self, applications: DataFrame) -> DataFrame:
        return self.preprocessor.transform(self.engineer.transform(applications), keep=[c.KEY])

    def probabilities(self, matrix: DataFrame, keep: Sequence[str]) -> DataFrame:
        assembled = model.assemble(matrix, self.preprocessor.outputs, keep)
        raw = model.with_probability(self.booster, assembled, keep, "raw_score")
        return self.calibrator.apply(raw, "raw_score", "score").select(*keep, "score")

    def score(self, applications: DataFrame) -> DataFrame:
        """Key, rounded probability, class at the threshold, band and version; no row leaves the cluster."""
        return self._published(self.probabilities(self._features(applications), [c.KEY]))

    def _published(self, scored: DataFrame, more: Sequence[str] = ()) -> DataFrame:
        return scored.select(
            c.KEY,
            F.round("score", 6).alias("probability"),
            predicted_class(F.col("score"), F.lit(self.threshold)).alias("predicted_class"),
            F.lit(self.threshold).alias("threshold"),
            F.lit(self.version).alias("model_version"),
            risk_band(F.col("score")).alias("risk_category"),
            *more,
        )

    def score_with_factors(self, applications: DataFrame, top: int = 5) -> DataFrame:
        """Scores and strongest factors of each row in one pass: the features are made once and nothing is joined."""
        features = self.preprocessor.outputs
        scored = self.probabilities(self._features(applications), [c.KEY, *features])
        attributed = explain.tree_attributions(self.booster, scored, [c.KEY, "score"], features)
        factors = explain.top_factors(attributed, [c.KEY, "score"], explain.attribution_columns(features), top)
        return self._published(factors, ["top_risk_factors", "top_protective_factors", "text_summary"])

    def explain(self, applications: DataFrame, top: int = 5) -> DataFrame:
        """Strongest factors of the uncalibrated margin per row, with their text."""
        matrix = self._features(applications)
        features = self.preprocessor.outputs
        attributed = explain.tree_attributions(self.booster, matrix, c.KEY, features)
        return explain.top_factors(attributed, [c.KEY], explain.attribution_columns(features), top)

    def save(self, spark: SparkSession, path: str) -> None:
        self.engineer.save(spark, f"{path}/features")
        self.preprocessor.save(spark, f"{path}/preprocessor")
        self.booster.write().overwrite().save(f"{path}/booster")
        if self.calibrator.kind == "isotonic":
            self.calibrator.model.save(f"{path}/isotonic")
        record = {
            "threshold": self.threshold,
            "version": self.version,
            "main_features": list(self.engineer.main_features),
            "final_features": self.engineer.final_features and list(self.engineer.final_features),
            "calibrator": [self.calibrator.kind, self.calibrator.slope, self.calibrator.intercept],
        }
        write_record(spark, record, f"{path}/scorer")

    @classmethod
    def load(cls, spark: SparkSession, path: str, history: DataFrame | KeyedTable | None = None) -> Scorer:
        record = read_record(spark, f"{path}/scorer")
        engineer = FeatureEngineer(history, record["main_features"], record["final_features"]).load(spark, f"{path}/features")
        kind, slope, intercept = record["calibrator"]
        isotonic = IsotonicFit.load(spark, f"{path}/isotonic") if kind == "isotonic" else None
        return cls(
            engineer,
            Preprocessor.load(spark, f"{path}/preprocessor"),
            GBTClassificationModel.load(f"{path}/booster"),
            Calibrator(kind, slope, intercept, isotonic),
            record["threshold"],
            record["version"],
        )


def write_record(spark: SparkSession, record: Mapping[str, Any], path: str) -> None:
    """One nested record as a JSON line."""
    spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_record(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def run_training(
    spark: SparkSession,
    applications: DataFrame,
    history: DataFrame | KeyedTable | None,
    out: str,
    params: Mapping = model.BOOSTER_PARAMS,
    final_features: Sequence[str] | None = None,
    seed: int = 42,
    patience: int = 50,
) -> tuple[Scorer, dict]:
    """Split, fit on train only, calibrate and pick the threshold on validation, report test once.

    ``final_features`` is the contract after the history join, for example a list read by ``read_names``.
    The calibrator is fitted on one half of the validation rows and judged on
    the other; the threshold is chosen on the scores that will be published.
    """
    started = time.perf_counter()
    applications = stage(applications)  # the split, the edges and the fingerprint read it many times
    rows = train_valid_test(applications, c.KEY, c.TARGET, seed)
    train_raw = rows.where(F.col("part") == "train")
    engineer = FeatureEngineer(history, final_features=final_features).fit(train_raw)
    engineered = stage(engineer.transform(rows, keep=[c.TARGET, "part"]))

    extra = [c.KEY, c.TARGET, "part"]
    train = engineered.where(F.col("part") == "train")
    preprocessor = Preprocessor(
        numeric_columns(engineered, extra), string_columns(engineered, extra)
    ).fit(train)
    matrix = stage(preprocessor.transform(engineered, keep=extra))
    assembled = model.assemble(matrix, preprocessor.outputs, extra)
    parts = {p: assembled.where(F.col("part") == p) for p in ("train", "valid", "test")}
    keep = [c.TARGET, model.FEATURES]
    booster = model.fit_booster(
        parts["train"].select(*keep), c.TARGET, params, parts["valid"].select(*keep), seed, patience
    )

    valid = stage(model.with_probability(booster, parts["valid"], [c.KEY, c.TARGET], "raw_score"))
    half = F.substring(hash_text(F.col(c.KEY), seed + 1), 1, 1) < "8"
    calibrator, briers = choose_calibrator(valid.where(half), valid.where(~half), c.TARGET, "raw_score")
    published = calibrator.apply(valid, "raw_score", "score")
    candidates = threshold_candidates(published, c.TARGET, "score")
    threshold = candidates["f1_optimal"]

    scorer = Scorer(engineer, preprocessor, booster, calibrator, threshold)
    test = scorer.probabilities(matrix.where(F.col("part") == "test"), [c.TARGET])
    record = {
        "model_version": VERSION,
        "training_timestamp": datetime.now(tz=timezone.utc).isoformat(),
        "training_duration_seconds": round(time.perf_counter() - started, 1),
        "dataset": {
            "fingerprint": table_fingerprint(applications),
            "n_rows": applications.count(),
            "n_features_raw": len(applications.columns),
        },
        "split_strategy": {
            "train_fraction": 0.70, "val_fraction": 0.15, "test_fraction": 0.15, "stratified": True, "random_seed": seed,
        },
        "feature_engineering": {
            "version": VERSION,
            "bin_cols": [name for name, source in engineer.bins.items() if source in engineer.edges],
            "n_final_features": len(engineered.columns) - len(extra),
        },
        "model": {
            "type": type(booster).__name__,
            "hyperparameters": dict(params),
            "best_iteration": len(booster.treeWeights),
            "calibration_method": calibrator.kind,
            "calibration_brier": briers,
        },
        "threshold": {"selected": threshold, "strategy": "f1_optimal_on_val", "all_candidates": candidates},
        "validation_metrics": compact_metrics(published, c.TARGET, "score", threshold).first().asDict(),
        "test_metrics": compact_metrics(test, c.TARGET, "score", threshold).first().asDict(),
        "environment": {
            "python_version": platform.python_version(), "spark_version": pyspark.__version__, "platform": platform.platform(),
        },
    }
    scorer.save(spark, f"{out}/scorer")
    write_record(spark, record, f"{out}/metadata")
    return scorer, record
