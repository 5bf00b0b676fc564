"""Table profiles: shares, missingness, rates, correlations, histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskloom.functions.binning import histogram_bin, histogram_edges
from riskloom.functions.scalars import numeric_columns, string_columns
from riskloom.operators.ordered import exact_quantiles


def value_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, value, n, pct`` for every level of the columns; NULL is left out."""
    long = (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "feature", "value")
        .where(F.col("value").isNotNull())
    )
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = df.agg(*[F.count(c).alias(c) for c in columns]).unpivot([], list(columns), "feature", "_all")
    return counts.join(F.broadcast(totals), "feature").select(
        "feature", "value", "n", (F.lit(100.0) * F.col("n") / F.col("_all")).alias("pct")
    )


def missingness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``feature, missing_pct`` per column, from one pass over the table."""
    columns = list(columns or df.columns)
    row = df.agg(*[(F.lit(100.0) * F.avg(F.col(c).isNull().cast("int"))).alias(c) for c in columns])
    return row.unpivot([], columns, "feature", "missing_pct")


def top_missing(df: DataFrame, limit: int = 30, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with gaps, the emptiest first."""
    gaps = missingness(df, columns).where(F.col("missing_pct") > 0)
    return gaps.orderBy(F.desc("missing_pct"), "feature").limit(limit)


def sparse_columns(df: DataFrame, above_pct: float = 50.0) -> list[str]:
    """Columns with strictly more than the given share missing; fitted state."""
    rows = missingness(df).where(F.col("missing_pct") > above_pct).collect()
    sparse = {r["feature"] for r in rows}
    return [c for c in df.columns if c in sparse]


def cardinalities(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, n_levels``: distinct non-NULL values through (column, value) groups."""
    return (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "feature", "value")
        .where(F.col("value").isNotNull())
        .distinct()
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n_levels"))
    )


def split_by_cardinality(df: DataFrame, columns: Sequence[str], below: int = 10) -> tuple[list[str], list[str]]:
    """Columns with fewer than ``below`` levels, and the others."""
    levels = {r["feature"]: r["n_levels"] for r in cardinalities(df, columns).collect()}
    low = [c for c in columns if levels.get(c, 0) < below]
    return low, [c for c in columns if c not in low]


def rate_by_category(df: DataFrame, category: str, target: str, limit: int | None = None) -> DataFrame:
    """``category, n, rate_pct``, the highest rate first; the NULL group is left out."""
    rates = (
        df.where(F.col(category).isNotNull())
        .groupBy(F.col(category).cast("string").alias("category"))
        .agg(F.count(target).alias("n"), (F.avg(target) * 100).alias("rate_pct"))
        .orderBy(F.desc("rate_pct"), "category")
    )
    return rates if limit is None else rates.limit(limit)


def rate_by_sentinel(df: DataFrame, column: str, sentinel, target: str) -> DataFrame:
    """Count and target rate of sentinel rows against all the rest, NULLs included in the rest."""
    hit = F.coalesce(F.col(column) == F.lit(sentinel), F.lit(False))
    return df.groupBy(hit.alias("is_sentinel")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(target).alias("target_rate")
    )


def target_correlations(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """``feature, correlation``: Pearson over the rows where both are present."""
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in columns])
    return row.unpivot([], list(columns), "feature", "correlation").where(F.col("correlation").isNotNull())


def strongest_correlations(df: DataFrame, columns: Sequence[str], target: str, k: int = 10) -> DataFrame:
    """The k lowest and the k highest correlations, marked by ``side``."""
    all_rows = target_correlations(df, columns, target)
    low = all_rows.orderBy("correlation", "feature").limit(k).withColumn("side", F.lit("negative"))
    high = all_rows.orderBy(F.desc("correlation"), "feature").limit(k).withColumn("side", F.lit("positive"))
    return low.unionByName(high)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, count, mean, std, min, p25, p50, p75, max`` with exact quartiles."""
    columns = list(columns)
    basics = df.agg(*[
        F.struct(
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        ).alias(c)
        for c in columns
    ]).unpivot([], columns, "feature", "s").select("feature", "s.*")
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    rows = [(c, *(quartiles[c] or [None] * 3)) for c in columns]
    table = df.sparkSession.createDataFrame(rows, "feature string, p25 double, p50 double, p75 double")
    return basics.join(F.broadcast(table), "feature").select(
        "feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def histogram(df: DataFrame, column: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width bin counts over the column's range, optionally per class.

    ``density`` integrates to one within each class.
    """
    bounds = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")).first()
    if bounds["lo"] is None:
        raise ValueError(f"{column} holds no values")
    edges = histogram_edges(bounds["lo"], bounds["hi"], bins)
    keys = [by] if by else []
    value = F.col(column).cast("double")
    counts = (
        df.where(value.isNotNull())
        .groupBy(*keys, histogram_bin(value, edges).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # one row per class and bin, so a window over a class is small
    share = F.col("n") / F.sum("n").over(W.partitionBy(*keys))
    width = (edges[-1] - edges[0]) / bins
    left = F.get(F.array(*[F.lit(e) for e in edges]), F.col("bin"))
    return counts.select(*keys, "bin", left.alias("bin_left"), "n", (share / F.lit(width)).alias("density"))


def score_distribution(df: DataFrame, scores: Mapping[str, Column], cutoff: float = 0.5) -> DataFrame:
    """One row per named score: mean, population deviation, exact p10/p50/p90, share >= cutoff, n."""
    names = list(scores)
    data = df.select(*[c.alias(n) for n, c in scores.items()])
    basics = data.agg(*[
        F.struct(
            F.avg(n).alias("mean"),
            F.stddev_pop(n).alias("std"),
            F.avg((F.col(n) >= cutoff).cast("int")).alias("predicted_positive_rate"),
            F.count(n).alias("n"),
        ).alias(n)
        for n in names
    ]).unpivot([], names, "score", "s").select("score", "s.*")
    quantiles = exact_quantiles(data, names, [0.1, 0.5, 0.9])
    rows = [(n, *(quantiles[n] or [None] * 3)) for n in names]
    table = df.sparkSession.createDataFrame(rows, "score string, p10 double, p50 double, p90 double")
    return basics.join(F.broadcast(table), "score").select(
        "score", "mean", "std", "p10", "p50", "p90", "predicted_positive_rate", "n"
    )


def column_kinds(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """How many columns are numeric and how many categorical; schema only."""
    rows = [
        ("numeric", len(numeric_columns(df, exclude))),
        ("categorical", len(string_columns(df, exclude))),
    ]
    return df.sparkSession.createDataFrame(rows, "kind string, n_columns int")
