"""Putting rolled-up tables together on the applicant key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from riskloom.sources.keyed import KeyedTable


def join_child_rollup(child: DataFrame, grandchild: DataFrame, key: str) -> DataFrame:
    """Left join of loan-level aggregates into the loan rows; the loan key goes."""
    return child.join(grandchild, key, "left").drop(key)


def outer_join(key: str, *rollups: DataFrame) -> DataFrame:
    """Full outer join of key-unique tables, written as a union and one aggregate.

    A chain of full joins coalesces the key after every step, so Spark has to
    exchange the growing result again for each table. The rollups already are
    hash-partitioned by the key; their union keeps that partitioning, so this
    aggregate needs no exchange at all. ``max`` picks the only row that carries
    a column; the inputs must have one row per key and no common columns.
    """
    columns = [c for r in rollups for c in r.columns if c != key]
    twice = sorted({c for c in columns if columns.count(c) > 1})
    if twice:
        raise ValueError(f"columns appear in several tables: {twice}")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rollups)
    return stacked.groupBy(key).agg(*[F.max(f"`{c}`").alias(c) for c in columns])


def attach(applications: DataFrame, features: DataFrame | KeyedTable, key: str) -> DataFrame:
    """Left join of the feature table; applicants without history keep NULLs.

    Of a keyed store only the folders are read that the applicants' keys hash to.
    """
    if isinstance(features, KeyedTable):
        if features.key != key:
            raise ValueError(f"the store is keyed by {features.key!r}, not {key!r}")
        features = features.lookup(applications)
    return applications.join(features, key, "left")


def attach_target(child: DataFrame, applications: DataFrame, key: str, target: str) -> DataFrame:
    """Every application with its child rows (one-to-many) and the target.

    One applicant may own a large share of the child rows. An outer join cannot
    split that side at run time, an inner join can, so the applications without
    children are added by an anti join against the distinct child keys.
    """
    parents = applications.select(key, target)
    matched = parents.join(child, key)
    alone = parents.join(child.select(key).distinct(), key, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def until(df: DataFrame, offset: str, limit: float = 0) -> DataFrame:
    """Rows dated at or before the application (offsets count days from it)."""
    return df.where(F.col(offset) <= F.lit(limit))
