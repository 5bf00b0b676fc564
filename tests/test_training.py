"""From raw tables to published scores."""

import json

import credit
import pytest
from pyspark.sql import functions as F

from riskloom.plans import reports, scoring
from riskloom.plans.history import build_history
from riskloom.plans.training import Scorer, read_record, run_training
from riskloom.session import stage
from riskloom.sources import contracts as c
from riskloom.streaming.scoring import record_stream, score_stream

PARAMS = {"n_estimators": 6, "learning_rate": 0.3, "max_depth": 3, "num_leaves": 8, "min_data_in_leaf": 10}
FEATURES = [
    "EXT_SOURCE_PRODUCT", "EXT_SOURCE_2", "EXT_SOURCE_3", "PAYMENT_RATE", "DAYS_EMPLOYED", "CODE_GENDER_M",
    "POS_SK_DPD_MEAN", "BUREAU_DAYS_CREDIT_MAX", "TOTALAREA_MODE",
]


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("model"))
    frame = credit.applications(1500, seed=2)
    applications = credit.to_spark(spark, frame)
    tables = credit.history(frame.SK_ID_CURR.to_numpy()[:900])
    history = build_history({n: credit.to_spark(spark, t) for n, t in tables.items()})
    scorer, record = run_training(spark, applications, history, out, PARAMS, FEATURES)
    return out, applications, history, scorer, record


def test_record(spark, trained):
    out, applications, _, scorer, record = trained
    assert read_record(spark, f"{out}/metadata") == json.loads(json.dumps(record))
    assert record["test_metrics"]["roc_auc"] > 0.6
    assert record["threshold"]["selected"] == scorer.threshold
    assert record["dataset"]["n_rows"] == 1500
    assert set(record["model"]["calibration_brier"]) == {"none", "sigmoid", "isotonic"}


def test_loaded_scorer_gives_the_same_scores(spark, trained):
    out, applications, history, scorer, _ = trained
    loaded = Scorer.load(spark, f"{out}/scorer", history)
    first = scorer.score(applications).orderBy(c.KEY).collect()
    assert first == loaded.score(applications).orderBy(c.KEY).collect()
    assert len(first) == 1500 and all(0 <= r["probability"] <= 1 for r in first)


def test_missing_values_are_tolerated(spark, trained):
    _, applications, _, scorer, _ = trained
    bare = applications.limit(5).select(c.KEY)
    rows = scorer.score(bare).collect()
    assert len(rows) == 5 and all(r["probability"] is not None for r in rows)


def test_explanations(trained):
    _, applications, _, scorer, _ = trained
    rows = scorer.explain(applications.limit(20), top=2).collect()
    assert len(rows) == 20 and all(len(r["top_risk_factors"]) <= 2 for r in rows)
    assert any("external credit score" in r["text_summary"] for r in rows)


def records(spark, applications, n=30):
    text = applications.drop(c.TARGET).limit(n)
    text = text.select(*[F.col(name).cast("string").alias(name) for name in text.columns])
    bad = text.limit(1).withColumn(c.KEY, F.lit("999")).withColumn("CODE_GENDER", F.lit("?"))
    return text.unionByName(bad)


def test_batch_of_records(spark, trained):
    _, applications, _, scorer, _ = trained
    batch = scoring.score_records(records(spark, applications), scorer, with_factors=True)
    rows = batch.scores.collect()
    assert len(rows) == 30 and all(r["risk_category"] for r in rows)
    assert [tuple(r) for r in batch.rejects.collect()] == [("999", "CODE_GENDER", "?", "unknown_level")]


def test_repeated_keys_are_scored_row_by_row(spark, trained):
    _, applications, _, scorer, _ = trained
    once = records(spark, applications, 5)
    batch = scoring.score_records(once.unionByName(once), scorer, with_factors=True)
    plain = scoring.score_records(once, scorer).scores.collect()
    rows = batch.scores.collect()
    assert len(rows) == 2 * len(plain)
    assert {(r[c.KEY], r["probability"]) for r in rows} == {(r[c.KEY], r["probability"]) for r in plain}


def test_score_file(spark, trained, tmp_path):
    _, applications, _, scorer, _ = trained
    stats = scoring.score_table(applications, scorer, str(tmp_path / "scores")).first()
    assert stats["n"] == 1500 and 0 < stats["p10"] <= stats["p50"] <= stats["p90"] < 1


def test_reports(spark, trained, tmp_path):
    _, applications, _, scorer, record = trained
    scored = stage(scorer.score(applications).join(applications.select(c.KEY, c.TARGET, "AMT_CREDIT"), c.KEY))
    tables = reports.evaluation_report(scored, c.TARGET, "probability", record["threshold"]["all_candidates"], str(tmp_path / "e"))
    assert tables["roc_curve"].count() <= 200 and tables["threshold_comparison"].count() == 4
    early = scored.where(F.col(c.KEY) % 2 == 0)
    drift = reports.drift_report(early, scored, ["AMT_CREDIT", "probability"], str(tmp_path / "d"), "probability")
    assert drift["features"].where("psi_status = 'stable'").count() == 2
    assert spark.read.json(str(tmp_path / "d" / "alerts")).count() == 1


def test_stream(spark, trained, tmp_path):
    _, applications, _, scorer, _ = trained
    records(spark, applications).repartition(2).write.json(str(tmp_path / "in"))
    stream = record_stream(spark, str(tmp_path / "in"))
    query = score_stream(stream, scorer, str(tmp_path / "out"), str(tmp_path / "cp"), once=True)
    query.awaitTermination()
    published = spark.read.parquet(str(tmp_path / "out" / "scores"))
    batch = {r[c.KEY]: r["probability"] for r in scorer.score(applications.limit(30)).collect()}
    assert {r[c.KEY]: r["probability"] for r in published.collect()} == batch
    assert spark.read.parquet(str(tmp_path / "out" / "rejects")).count() == 1
