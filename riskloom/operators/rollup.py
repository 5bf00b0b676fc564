"""Child tables rolled up to their parent key.

Every rollup is one ``groupBy(key).agg(...)``: Spark combines on the map side,
so a key that holds a third of the rows costs each task one partial row. A
distinct count adds a combine on (key, value) before the one on the key.
One-hot columns are never materialised; a level's share is its conditional
count over the row count, taken after the aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.binning import level_flag
from riskloom.functions.scalars import payment_shortfall, safe_ratio
from riskloom.functions.stats import aggregate


@dataclass(frozen=True)
class RollupSpec:
    """What to compute per key.

    ``stats`` maps a column to its statistics (output ``<prefix>_<col>_<STAT>``).
    ``levels`` maps a string column to its level contract (outputs
    ``<col>_<level>_MEAN`` and ``_SUM``); ``fills`` holds the fitted mode that
    replaces NULL in such a column.
    """

    key: str
    prefix: str
    stats: Mapping[str, Sequence[str]]
    levels: Mapping[str, Sequence[str]] = field(default_factory=dict)
    fills: Mapping[str, str] = field(default_factory=dict)

    def with_levels(self, levels: Mapping[str, Sequence[str]], fills: Mapping[str, str] | None = None) -> RollupSpec:
        return replace(self, levels=levels, fills=fills or {})


def rollup(df: DataFrame, spec: RollupSpec) -> DataFrame:
    """One row per non-NULL key with all numeric and level outputs of the spec.

    Levels are counted over narrow groups whatever their number: one wide aggregate
    leaves generated code when a contract has many of them.
    """
    if any(spec.levels.values()):
        counts = category_rollup_long(df, spec.key, spec.levels, spec.fills)
        if not spec.stats:
            return counts
        # both sides end partitioned by the key, so this join needs no exchange
        return rollup(df, replace(spec, levels={}, fills={})).join(counts, spec.key)
    aggs: list[Column] = []
    outputs: list[Column] = [F.col(spec.key)]
    for column, stats in spec.stats.items():
        for stat in stats:
            name = f"{spec.prefix}_{column}_{stat.upper()}"
            aggs.append(aggregate(stat, F.col(column)).alias(name))
            outputs.append(F.col(f"`{name}`"))
    grouped = df.where(F.col(spec.key).isNotNull()).groupBy(spec.key).agg(*aggs)
    return grouped.select(*outputs)


def status_rollup(
    df: DataFrame, key: str, status: str, levels: Sequence[str], numeric: Sequence[str], prefix: str = "BB"
) -> DataFrame:
    """Monthly rows to loans: mean, sum and variance of every column but the key.

    The status is one-hot encoded without its smallest level. For a 0/1 column
    with sum ``s`` over ``n`` rows the variance is ``(s - s*s/n) / (n - 1)``, so
    the level columns need no further aggregates.
    """
    kept = sorted(levels)[1:]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [aggregate(stat, F.col(c)).alias(f"{prefix}_{c}_{stat.upper()}") for c in numeric for stat in _MOMENTS]
    aggs += [F.sum(level_flag(F.col(status), level)).alias(f"_s_{level}") for level in kept]
    grouped = df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    n = F.col("_rows")
    out = [F.col(key)] + [F.col(f"{prefix}_{c}_{stat.upper()}") for c in numeric for stat in _MOMENTS]
    for level in kept:
        name, s = f"{prefix}_{status}_{level}", F.col(f"_s_{level}")
        out.append((s / n).alias(f"{name}_MEAN"))
        out.append(s.alias(f"{name}_SUM"))
        out.append(F.when(n > 1, (s - s * s / n) / (n - 1)).alias(f"{name}_VAR"))
    return grouped.select(*out)


_MOMENTS = ("mean", "sum", "var")


def with_payment_columns(df: DataFrame, due: str = "AMT_INSTALMENT", paid: str = "AMT_PAYMENT") -> DataFrame:
    """Add the share of an instalment that was paid and its shortfall."""
    return df.select(
        "*",
        safe_ratio(F.col(paid), F.col(due)).alias("PAYMENT_PERC"),
        payment_shortfall(F.col(due), F.col(paid)).alias("PAYMENT_DIFF"),
    )


def category_rollup_long(df: DataFrame, key: str, levels: Mapping[str, Sequence[str]], fills: Mapping[str, str]) -> DataFrame:
    """Level counts per key through (key, column, level) groups and a pivot.

    It aggregates narrow rows and only widens at the end.
    """
    columns = list(levels)
    filled = [F.coalesce(F.col(c), F.lit(fills[c])).alias(c) if c in fills else F.col(c) for c in columns]
    long = (
        df.where(F.col(key).isNotNull())
        .select(key, *filled)
        .unpivot([key], columns, "_column", "_level")
        .groupBy(key, "_column", "_level")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return level_shares(long, key, levels)


def level_shares(long: DataFrame, key: str, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows ``key, _column, _level, _n`` widened to each level's share and count; one row per group is expected."""
    columns = list(levels)
    entries = {f"{c}:{level}": f"{c}_{level}" for c in columns for level in levels[c]}
    wide = (
        long.withColumn("_name", F.concat_ws(":", "_column", "_level"))
        .groupBy(key)
        .agg(
            F.sum(F.when(F.col("_column") == columns[0], F.col("_n"))).alias("_rows"),
            # at most one entry per contract level
            F.map_from_entries(
                F.collect_list(F.when(F.col("_name").isin(list(entries)), F.struct("_name", "_n")))
            ).alias("_counts"),
        )
    )
    out = [F.col(key)]
    for entry, name in entries.items():
        count = F.coalesce(F.try_element_at("_counts", F.lit(entry)), F.lit(0))
        out += [(count / F.col("_rows")).alias(f"{name}_MEAN"), count.alias(f"{name}_SUM")]
    return wide.select(*out)
