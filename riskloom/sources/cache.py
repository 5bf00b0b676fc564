"""Stage tables that are built once and re-read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.functions.scalars import normalise_missing
from riskloom.sources.sinks import write_parquet
from riskloom.sources.tables import path_exists, read_parquet


def load_or_build(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], fingerprint: str | None = None
) -> DataFrame:
    """The Parquet table at ``path``, built and written first if it is not there.

    With a fingerprint of the inputs, each input state has its own folder, so
    changed inputs are never served from an old table.
    """
    if fingerprint:
        path = f"{path.rstrip('/')}/inputs={fingerprint}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        write_parquet(normalise_missing(build()), path)
    return read_parquet(spark, path)
