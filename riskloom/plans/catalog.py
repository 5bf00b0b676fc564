"""Registry of queries: a Spark job and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, places: Mapping[str, int]) -> DataFrame:
    """Named columns rounded, and negative zeros made plain."""
    return df.select(*[
        (F.round(F.col(f"`{c}`"), places[c]) + F.lit(0.0)).alias(c) if c in places else F.col(f"`{c}`")
        for c in df.columns
    ])


def load() -> None:
    """Import the modules that register queries."""
    from riskloom.plans import (  # noqa: F401
        queries_drift,
        queries_evaluate,
        queries_features,
        queries_history,
        queries_model,
        queries_profile,
        queries_validate,
    )
