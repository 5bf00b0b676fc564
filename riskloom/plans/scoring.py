"""Batch scoring of raw records: validate, score, explain, publish."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from riskloom.operators.profile import score_distribution
from riskloom.operators.validate import check_records, rejected_records, valid_records
from riskloom.plans.training import Scorer
from riskloom.sources import contracts as c
from riskloom.sources.sinks import write_scores


@dataclass
class Batch:
    scores: DataFrame
    rejects: DataFrame


def score_records(records: DataFrame, scorer: Scorer, with_factors: bool = False) -> Batch:
    """Text records to scores; records that break a type or a domain are listed with the reason."""
    checked = check_records(records, c.APPLICATION_TYPES, c.DOMAINS)
    valid = valid_records(checked, c.APPLICATION_TYPES)
    scores = scorer.score_with_factors(valid) if with_factors else scorer.score(valid)
    return Batch(scores, rejected_records(checked, c.KEY))


def score_table(applications: DataFrame, scorer: Scorer, out: str) -> DataFrame:
    """Write the score file; returns the distribution of the published probabilities."""
    scored = scorer.score(applications)
    write_scores(scored, out, c.KEY)
    written = applications.sparkSession.read.option("header", True).schema(f"{c.KEY} long, TARGET double").csv(out)
    return score_distribution(written, {"probability": F.col("TARGET")})
