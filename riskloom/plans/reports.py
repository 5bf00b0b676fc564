"""Report tables of a scored sample and of the monitored periods, written as JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from riskloom.operators import drift, evaluate
from riskloom.session import stage
from riskloom.sources.sinks import write_json, write_json_lines


def evaluation_report(
    scored: DataFrame, label: str, score: str, candidates: Mapping[str, float], out: str
) -> dict[str, DataFrame]:
    """Curves as folders of JSON lines; calibration, threshold table and metrics as one JSON document each.

    Every table reads the scores again, so they are staged first.
    """
    scored = stage(scored.select(label, score))
    threshold = candidates.get("f1_optimal", 0.5)
    tables = {
        "roc_curve": evaluate.roc_points(scored, label, score),
        "pr_curve": evaluate.pr_points(scored, label, score),
        "calibration_curve": evaluate.calibration_curve(scored, label, score),
        "calibration_error": evaluate.calibration_error(scored, label, score),
        "threshold_comparison": evaluate.threshold_table(scored, label, score, candidates),
        "metrics": evaluate.as_metric_rows(evaluate.full_metrics(scored, label, score, threshold)),
    }
    for name, frame in tables.items():
        # a curve has a point for each distinct score
        (write_json_lines if name in ("roc_curve", "pr_curve") else write_json)(frame, f"{out}/{name}")
    return tables


def drift_report(
    reference: DataFrame, current: DataFrame, features: Sequence[str], out: str, score: str | None = None
) -> dict[str, DataFrame]:
    """Feature drift, alerts and, if a score is named, its drift."""
    wanted = list(dict.fromkeys([*features, *([score] if score else [])]))
    reference, current = (stage(df.select(*[c for c in wanted if c in df.columns])) for df in (reference, current))
    report = stage(drift.drift_report(reference, current, features))
    tables = {"features": report, "alerts": drift.drift_alerts(report)}
    if score:
        tables["predictions"] = drift.prediction_drift(reference, current, score)
    for name, frame in tables.items():
        write_json(frame, f"{out}/{name}")
    return tables
