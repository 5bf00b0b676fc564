"""Rollups kept as mergeable state, so that a new delivery is rolled up alone and added to what is there.

The state has two tables. ``moments`` holds a row per key: rows, and for each column the count, sum, sum of squares
about the mean, least and greatest value, as far as its statistics need them. ``values`` holds a row per key, column and
value with its count, for distinct counts and levels; it stays narrow, so a key with very many values is spread over many
rows, and a level that a later delivery brings needs no new build.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskloom.operators.rollup import RollupSpec, level_shares
from riskloom.sources.sinks import write_parquet
from riskloom.sources.tables import read_parquet

_NEEDS = {
    "count": set(), "mean": {"sum"}, "sum": {"sum"}, "var": {"sum", "squares"}, "min": {"least"}, "max": {"most"}, "nunique": set(),
}


@dataclass(frozen=True)
class RollupState:
    spec: RollupSpec
    moments: DataFrame
    values: DataFrame

    def save(self, path: str) -> None:
        """Both tables under ``path``, which must not be one that this state is read from."""
        write_parquet(self.moments, f"{path}/moments")
        write_parquet(self.values, f"{path}/values")


def load_state(spark: SparkSession, path: str, spec: RollupSpec) -> RollupState:
    """The state saved at ``path`` for a rollup of this spec."""
    hint = "save a rollup state first"
    return RollupState(spec, read_parquet(spark, f"{path}/moments", hint), read_parquet(spark, f"{path}/values", hint))


def _parts(stats: Sequence[str]) -> set[str]:
    unknown = set(stats) - set(_NEEDS)
    if unknown:
        raise ValueError(f"unknown statistics {sorted(unknown)}")
    return set().union(*[_NEEDS[s] for s in stats])


def _text(df: DataFrame, name: str) -> Column:
    """A text that is equal for equal values only."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        c = F.when(c == 0, F.lit(0.0)).otherwise(c)  # both zeros are one value
    elif isinstance(kind, T.TimestampType):
        c = F.unix_micros(c)
    elif isinstance(kind, T.BinaryType):
        c = F.hex(c)
    return c.cast("string").alias(name)


def rollup_state(df: DataFrame, spec: RollupSpec) -> RollupState:
    """The state of one delivery. Rows without a key are left out, as by ``rollup``."""
    rows = df.where(F.col(spec.key).isNotNull())
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for column, stats in spec.stats.items():
        c, needs = F.col(f"`{column}`"), _parts(stats)
        parts = [F.count(c).alias("n")]
        if "sum" in needs:
            parts.append(F.sum(c).alias("sum"))
        if "squares" in needs:
            parts.append(F.coalesce(F.var_pop(c) * F.count(c), F.lit(0.0)).alias("squares"))
        if "least" in needs:
            parts.append(F.min(c).alias("least"))
        if "most" in needs:
            parts.append(F.max(c).alias("most"))
        aggs.append(F.struct(*parts).alias(column))
    counted = [c for c in dict.fromkeys([*spec.levels, *_distinct(spec)])]
    if counted:
        long = rows.select(spec.key, *[_text(df, c) for c in counted]).unpivot([spec.key], counted, "_column", "_value")
    else:
        long = rows.select(spec.key, F.lit("").alias("_column"), F.lit("").alias("_value")).where(F.lit(False))
    values = long.groupBy(spec.key, "_column", "_value").agg(F.count(F.lit(1)).alias("_n"))
    return RollupState(spec, rows.groupBy(spec.key).agg(*aggs), values)


def _distinct(spec: RollupSpec) -> list[str]:
    return [c for c, stats in spec.stats.items() if "nunique" in stats]


def merge_states(states: Sequence[RollupState]) -> RollupState:
    """The state of all deliveries together, whatever their order; each key's partial rows meet in one aggregate.

    Squares about the common mean are the sum of each part's own and of ``n * (its mean - common mean)^2``, which
    does not cancel as a difference of large sums would.
    """
    if not states:
        raise ValueError("no state to merge")
    spec = states[0].spec
    if any((s.spec.key, _shape(s.spec)) != (spec.key, _shape(spec)) for s in states):
        raise ValueError("states of different rollups cannot be merged")
    aggs = [F.sum("_rows").alias("_rows")]
    for column, stats in spec.stats.items():
        needs = _parts(stats)
        field = {p: F.col(f"`{column}`.`{p}`") for p in ("n", "sum", "squares", "least", "most")}
        parts = [F.sum(field["n"]).alias("n")]
        if "sum" in needs:
            parts.append(F.sum(field["sum"]).alias("sum"))
        if "squares" in needs:  # one entry a delivery that has the key
            own = F.struct(field["n"].alias("n"), (field["sum"] / F.nullif(field["n"], F.lit(0))).alias("mean"), field["squares"].alias("squares"))
            parts.append(F.collect_list(F.when(field["n"] > 0, own)).alias("parts"))
        if "least" in needs:
            parts.append(F.min(field["least"]).alias("least"))
        if "most" in needs:
            parts.append(F.max(field["most"]).alias("most"))
        aggs.append(F.struct(*parts).alias(column))
    moments = reduce(DataFrame.unionByName, [s.moments for s in states]).groupBy(spec.key).agg(*aggs)
    for column, stats in spec.stats.items():
        if "squares" in _parts(stats):
            moments = moments.withColumn(
                column, F.col(f"`{column}`").withField("squares", _squares(column)).dropFields("parts"))
    values = reduce(DataFrame.unionByName, [s.values for s in states])
    return RollupState(spec, moments, values.groupBy(spec.key, "_column", "_value").agg(F.sum("_n").alias("_n")))


def _squares(column: str) -> Column:
    """Squares about the common mean of a merged column, from its parts."""
    mean = F.col(f"`{column}`.sum") / F.nullif(F.col(f"`{column}`.n"), F.lit(0))

    def add(total: Column, part: Column) -> Column:
        off = part["mean"] - mean
        return total + part["squares"] + part["n"] * off * off

    return F.aggregate(F.col(f"`{column}`.parts"), F.lit(0.0), add)


def _shape(spec: RollupSpec) -> tuple:
    return tuple((c, frozenset(s)) for c, s in sorted(spec.stats.items())), frozenset(spec.levels)


def state_contract(state: RollupState, max_levels: int = 1000) -> RollupSpec:
    """The spec with the levels and the mode of each level column as the whole state knows them.

    Of equally frequent values the least is the mode. A column with more than ``max_levels`` levels is refused.
    """
    columns = list(state.spec.levels)
    known = state.values.where(F.col("_column").isin(columns) & F.col("_value").isNotNull())
    counts = known.groupBy("_column", "_value").agg(F.sum("_n").alias("_n"))
    rows = counts.take(len(columns) * max_levels + 1)
    levels: dict[str, list[str]] = {c: sorted(r["_value"] for r in rows if r["_column"] == c) for c in columns}
    if any(len(found) > max_levels for found in levels.values()):
        raise ValueError(f"a column has more than {max_levels} levels")
    best = {c: min(((-r["_n"], r["_value"]) for r in rows if r["_column"] == c), default=None) for c in columns}
    return replace(state.spec, levels=levels, fills={c: b[1] for c, b in best.items() if b})


def finish(state: RollupState, spec: RollupSpec | None = None) -> DataFrame:
    """The outputs that ``rollup`` gives for all rows the state has seen, under the same names.

    ``spec`` may bring another contract of levels and fills, such as that of ``state_contract``.
    """
    spec = spec or state.spec
    if _shape(spec) != _shape(state.spec):
        raise ValueError("the state holds another rollup")
    out = [F.col(spec.key)]
    for column, stats in spec.stats.items():
        for stat in stats:
            out.append(_output(column, stat).alias(f"{spec.prefix}_{column}_{stat.upper()}"))
    table = state.moments
    distinct = _distinct(spec)
    if distinct:
        there = state.values.where(F.col("_column").isin(distinct) & F.col("_value").isNotNull())
        counts = there.groupBy(spec.key).agg(*[F.count_if(F.col("_column") == c).alias(f"_distinct_{c}") for c in distinct])
        table = table.join(counts, spec.key, "left")
    stats_out = table.select(*out)
    if not any(spec.levels.values()):
        return stats_out
    value = F.col("_value")
    for column, fill in spec.fills.items():
        value = F.when(F.col("_column") == column, F.coalesce(value, F.lit(fill))).otherwise(value)
    long = (
        state.values.where(F.col("_column").isin(list(spec.levels)))
        .select(spec.key, "_column", value.alias("_level"), "_n")
        .groupBy(spec.key, "_column", "_level")
        .agg(F.sum("_n").alias("_n"))
    )
    shares = level_shares(long, spec.key, spec.levels)
    return stats_out.join(shares, spec.key) if spec.stats else shares


def _output(column: str, stat: str) -> Column:
    n = F.col(f"`{column}`.n")
    if stat == "count":
        return n
    if stat == "mean":
        return F.col(f"`{column}`.sum") / F.nullif(n, F.lit(0))
    if stat == "sum":
        return F.coalesce(F.col(f"`{column}`.sum"), F.lit(0))
    if stat == "var":
        return F.when(n > 1, F.col(f"`{column}`.squares") / (n - 1))
    if stat == "min":
        return F.col(f"`{column}`.least")
    if stat == "max":
        return F.col(f"`{column}`.most")
    return F.coalesce(F.col(f"`_distinct_{column}`"), F.lit(0))
