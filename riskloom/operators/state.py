"""Parameters that are fitted once on training rows and then only applied.

Everything fitted here is bounded by the schema (a few numbers per column), so
it lives on the driver as plain values, is saved as a small table, and enters
the transforms as constants: applying a state is one ``select``, no join.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.functions.binning import cut, one_hot
from riskloom.operators.ordered import exact_quantiles


class NotFittedError(RuntimeError):
    """A transform was asked for before its parameters were fitted."""


# --------------------------------------------------------------------------
# levels and modes


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, value, n`` over all given string columns; NULLs left out."""
    return (
        df.select(*columns)
        .unpivot([], list(columns), "feature", "value")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column, the smallest one on ties."""
    if not columns:
        return {}
    best = level_counts(df, columns).groupBy("feature").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")
    )
    return {r["feature"]: r["mode"] for r in best.collect()}


def fit_levels(df: DataFrame, columns: Sequence[str], at_most: int) -> dict[str, list[str]]:
    """Sorted levels per column: the contract for one-hot outputs.

    Every level becomes output columns, so the caller says how many a column may
    have; a column with more is refused, never cut short.
    """
    if not columns:
        return {}
    limit = at_most * len(columns) + 1
    out: dict[str, list[str]] = {c: [] for c in columns}
    for r in level_counts(df, columns).select("feature", "value").limit(limit).collect():
        out[r["feature"]].append(r["value"])
    wide = {c: len(v) for c, v in out.items() if len(v) > at_most}
    if wide:
        raise ValueError(f"too many levels for one-hot columns: {wide}")
    return {c: sorted(v) for c, v in out.items()}


# --------------------------------------------------------------------------
# quantile bins


def fit_quantile_edges(df: DataFrame, columns: Sequence[str], bins: int = 5) -> dict[str, list[float]]:
    """Unique quantile edges per column; a column without values has none."""
    shares = [float(s) for s in np.linspace(0, 1, bins + 1)]
    fitted = exact_quantiles(df, columns, shares)
    return {c: sorted(set(v)) for c, v in fitted.items() if v}


def quantile_bins(df: DataFrame, outputs: Mapping[str, str], edges: Mapping[str, Sequence[float]],
                  labels: Sequence[str] | None = None) -> DataFrame:
    """Add ``outputs[name] -> bin of column`` with fitted edges; nothing is refitted.

    Columns without edges, or absent from this table, get no bin column.
    """
    present = set(df.columns) & set(edges)
    added = [cut(F.col(c), edges[c], labels).alias(name) for name, c in outputs.items() if c in present]
    return df.select("*", *added)


# --------------------------------------------------------------------------
# scaling


def fit_min_max(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(*[F.struct(F.min(c).cast("double"), F.max(c).cast("double")).alias(c) for c in columns]).first()
    return {c: tuple(row[c]) for c in columns}


def min_max(c: Column, low: float, high: float) -> Column:
    """Train range to [0, 1]; other rows may leave it; a constant column gives 0."""
    return (c - F.lit(low)) / F.lit((high - low) or 1.0)


def fit_standard(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation."""
    row = df.agg(*[F.struct(F.avg(c), F.stddev_pop(c)).alias(c) for c in columns]).first()
    return {c: tuple(row[c]) for c in columns}


def standardise(c: Column, mean: float, deviation: float) -> Column:
    return (c - F.lit(mean)) / F.lit(deviation or 1.0)


# --------------------------------------------------------------------------
# power transform


def yeo_johnson(c: Column, power: Column | float) -> Column:
    """Yeo-Johnson transform for a fitted power.

    With ``m = power`` for positive and ``2 - power`` for negative values it is
    ``sign(x) * (exp(m * log1p|x|) - 1) / m``, and ``sign(x) * log1p|x|`` at m = 0.
    """
    size = F.log1p(F.abs(c))
    if isinstance(power, Column):
        m = F.when(c < 0, 2 - power).otherwise(power)
        return F.signum(c) * F.when(F.abs(m) < _NO_POWER, size).otherwise(F.expm1(m * size) / m)
    up, down = (size if abs(m) < _NO_POWER else F.expm1(F.lit(m) * size) / F.lit(m) for m in (power, 2.0 - power))
    return F.when(c >= 0, up).when(c < 0, -down)


_NO_POWER = 1e-12
_CELLS = 2048


def fit_yeo_johnson(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Power of greatest likelihood per column; a constant column keeps its values (power 1).

    The likelihood is first maximised on a fine histogram of ``sign(x) * log1p|x|``
    (2048 cells per column with their own means, so its size depends on the
    schema only). An exact pass over the rows at the optimum and on both sides
    of it then corrects the rest; it is repeated, with wider and then closer
    points, for columns whose maximum it does not bracket, as beside far
    outliers. Three scans for most columns, whatever their number.
    """
    columns = list(columns)
    if not columns:
        return {}
    spark = df.sparkSession
    data = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    bounds = data.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns]).first()
    spans = {c: tuple(_signed_log(bounds[c][k]) for k in ("lo", "hi")) for c in columns if bounds[c]["lo"] is not None}
    powers = {c: 1.0 for c in columns}
    varying = {c: span for c, span in spans.items() if span[0] < span[1]}
    if not varying:
        return powers

    long = data.select(*varying).unpivot([], list(varying), "feature", "x").where(F.col("x").isNotNull())
    table = spark.createDataFrame([(c, lo, _CELLS / (hi - lo)) for c, (lo, hi) in varying.items()], "feature string, lo double, scale double")
    logs = long.join(F.broadcast(table), "feature").select(
        "feature", "lo", "scale", (F.signum("x") * F.log1p(F.abs("x"))).alias("s")
    )
    cell = F.floor((F.col("s") - F.col("lo")) * F.col("scale"))
    cells = logs.groupBy("feature", cell.alias("cell")).agg(F.count("s").alias("n"), F.avg("s").alias("s")).collect()
    by_feature: dict[str, list] = {c: [] for c in varying}
    for r in cells:
        by_feature[r["feature"]].append((r["n"], r["s"]))
    rough = {c: _likeliest_power(np.array(v, dtype=float)) for c, v in by_feature.items()}

    at = dict(rough)
    step = dict.fromkeys(at, _STEP)
    x, p, h = F.col("x"), F.col("p"), F.col("h")
    while at:
        start = spark.createDataFrame([(c, at[c], step[c]) for c in at], "feature string, p double, h double")
        exact = (
            long.join(F.broadcast(start), "feature")
            .groupBy("feature")
            .agg(
                F.avg(F.signum(x) * F.log1p(F.abs(x))).alias("j"),
                *[F.var_pop(yeo_johnson(x, p + F.lit(k) * h)).alias(f"v{k + _REACH}") for k in range(-_REACH, _REACH + 1)],
            )
            .collect()
        )
        for r in exact:
            c = r["feature"]
            around = [_log_likelihood(r[f"v{k + _REACH}"], at[c] + k * step[c], r["j"]) for k in range(-_REACH, _REACH + 1)]
            best = int(np.argmax(around))
            if best in (0, 2 * _REACH) and around[best] > -math.inf:  # not bracketed yet: go on, in longer steps
                at[c] += (best - _REACH) * step[c]
                step[c] *= 4
            elif step[c] > _STEP and around[best] > -math.inf:  # bracketed: look closer
                at[c] += (best - _REACH) * step[c]
                step[c] = max(_STEP, step[c] / _REACH)
            else:
                left, middle, right = around[max(best - 1, 0) : best + 2] if 0 < best < 2 * _REACH else (0.0, 0.0, 0.0)
                bend = left - 2 * middle + right
                shift = 0.5 * (left - right) / bend if -math.inf < bend < 0 else 0.0
                powers[c] = at.pop(c) + (best - _REACH + shift) * step.pop(c)
    return powers


#: Distance of the points at which the exact likelihood is taken last, and how many lie on each side.
_STEP, _REACH = 0.002, 3


def _log_likelihood(variance: float | None, power: float, jacobian: float) -> float:
    if variance is None or not 0 < variance < math.inf:
        return -math.inf
    return -0.5 * math.log(variance) + (power - 1) * jacobian


def _signed_log(x: float) -> float:
    return math.copysign(math.log1p(abs(x)), x)


def _likeliest_power(cells: np.ndarray) -> float:
    """Maximum over the power for weighted values ``n, sign(x) * log1p|x|``."""
    n, s = cells[:, 0] / cells[:, 0].sum(), cells[:, 1]
    size, sign, jacobian = np.abs(s), np.sign(s), float((n * s).sum())

    def likelihood(power: float) -> float:
        m = np.where(s < 0, 2.0 - power, power)
        flat = np.abs(m) < _NO_POWER
        with np.errstate(over="ignore", invalid="ignore"):
            t = sign * np.where(flat, size, np.expm1(m * size) / np.where(flat, 1.0, m))
            spread = float((n * (t - (n * t).sum()) ** 2).sum())
        return -0.5 * math.log(spread) + (power - 1) * jacobian if 0 < spread < math.inf else -math.inf

    low, high = -3.0, 5.0
    known = -math.inf
    while True:
        grid = np.linspace(low, high, 81)
        i = int(np.argmax([likelihood(float(g)) for g in grid]))
        if 0 < i < 80 or likelihood(float(grid[i])) <= known:
            break  # bracketed, or no further gain from going on
        known = likelihood(float(grid[i]))
        low, high = low - (high - low) * (i == 0), high + (high - low) * (i == 80)
    width = float(grid[1] - grid[0])
    low, high = float(grid[i]) - width, float(grid[i]) + width
    golden = (math.sqrt(5) - 1) / 2
    while high - low > 1e-7:
        left, right = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, right) if likelihood(left) >= likelihood(right) else (left, high)
    return (low + high) / 2


# --------------------------------------------------------------------------
# the column-wise pipeline


@dataclass
class Preprocessor:
    """Median -> Yeo-Johnson -> standard scale, and mode -> one-hot.

    Outputs are named ``num__<column>`` and ``cat__<column>_<level>``; all other
    columns are dropped except those in ``keep``. Either list may be empty.
    A numeric column without any training value is dropped, as is the smallest
    level of each categorical; unseen levels give all zeros. Powers that are given
    are kept, for example those of an earlier run.
    """

    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float] = field(default_factory=dict)
    powers: dict[str, float] = field(default_factory=dict)
    scales: dict[str, tuple[float, float]] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    levels: dict[str, list[str]] = field(default_factory=dict)
    fitted: bool = False
    max_levels: int = 1000

    def fit(self, train: DataFrame) -> Preprocessor:
        middle = exact_quantiles(train, self.numeric, [0.5])
        self.medians = {c: v[0] for c, v in middle.items() if v}
        names = list(self.medians)
        filled = train.select(*[self._filled(c).alias(c) for c in names])
        self.powers = {**fit_yeo_johnson(filled, [c for c in names if c not in self.powers]), **self.powers}
        powered = filled.select(*[yeo_johnson(F.col(c), self.powers[c]).alias(c) for c in names])
        self.scales = fit_standard(powered, names) if names else {}
        self.modes = fit_modes(train, self.categorical)
        self.levels = fit_levels(train, self.categorical, self.max_levels)
        self.fitted = True
        return self

    def _filled(self, c: str) -> Column:
        return F.coalesce(F.col(c).cast("double"), F.lit(self.medians[c]))

    @property
    def outputs(self) -> list[str]:
        numeric = [f"num__{c}" for c in self.medians]
        return numeric + [f"cat__{c}_{v}" for c in self.categorical for v in self.levels.get(c, [])[1:]]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        if not self.fitted:
            raise NotFittedError("the preprocessor has not been fitted; call fit() first")
        out = [F.col(c) for c in keep]
        for c in self.medians:
            out.append(standardise(yeo_johnson(self._filled(c), self.powers[c]), *self.scales[c]).alias(f"num__{c}"))
        filled = df.withColumns({
            c: F.coalesce(F.col(c), F.lit(self.modes[c])) for c in self.categorical if c in self.modes
        }) if self.modes else df
        for c in self.categorical:
            out += [flag.alias(f"cat__{c}_{v}") for flag, v in
                    zip(one_hot(c, self.levels.get(c, []), drop_first=True), self.levels.get(c, [])[1:])]
        return filled.select(*out)

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [("numeric", None, json.dumps(self.numeric)), ("categorical", None, json.dumps(self.categorical))]
        for kind in ("medians", "powers", "scales", "modes", "levels"):
            rows += [(kind, c, json.dumps(v)) for c, v in getattr(self, kind).items()]
        table = [(i, *r) for i, r in enumerate(rows)]
        frame = spark.createDataFrame(table, "position int, kind string, column string, value string")
        frame.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preprocessor:
        state: dict[str, dict] = {k: {} for k in ("medians", "powers", "scales", "modes", "levels")}
        lists: dict[str, list[str]] = {}
        for r in spark.read.parquet(path).orderBy("position").collect():
            value = json.loads(r["value"])
            if r["column"] is None:
                lists[r["kind"]] = value
            else:
                state[r["kind"]][r["column"]] = tuple(value) if r["kind"] == "scales" else value
        return cls(lists["numeric"], lists["categorical"], **state, fitted=True)
