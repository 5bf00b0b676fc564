"""Column expressions. All of them stay inside generated code: no UDFs."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame, functions as F, types as T

EMPLOYMENT_SENTINEL = 365243
DAYS_PER_YEAR = 365.0


def sentinel_flag(c: Column, sentinel) -> Column:
    """1 where the value is the sentinel, 0 elsewhere; NULL counts as 0."""
    return F.coalesce(c == F.lit(sentinel), F.lit(False)).cast("int")


def drop_sentinel(c: Column, *sentinels) -> Column:
    """The value, or NULL where it equals one of the sentinels."""
    return F.when(~c.isin(*sentinels), c)


def presence_flag(c: Column) -> Column:
    return c.isNotNull().cast("int")


def days_to_years(c: Column) -> Column:
    return c / F.lit(-DAYS_PER_YEAR)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is NULL on a zero denominator (ANSI division would raise)."""
    return numerator / F.when(denominator != 0, denominator)


def product(*columns: Column) -> Column:
    """Product of all columns, NULL as soon as one is NULL."""
    return reduce(mul, columns)


def payment_shortfall(due: Column, paid: Column) -> Column:
    return due - paid


def differs(c: Column, value) -> Column:
    """``!=`` that keeps NULL rows instead of dropping them."""
    return ~c.eqNullSafe(F.lit(value))


def ordinal(c: Column, ranks: Mapping[str, int]) -> Column:
    """Rank of a level; levels outside the map become NULL."""
    entries = [F.lit(item) for pair in ranks.items() for item in pair]
    return F.try_element_at(F.create_map(*entries), c)


def recode(c: Column, mapping: Mapping[str, str]) -> Column:
    out = c
    for old, new in mapping.items():
        out = F.when(c == old, F.lit(new)).otherwise(out)
    return out


def finite(c: Column) -> Column:
    """The value, or NULL where it is NaN or infinite."""
    infinities = [F.lit(float("inf")), F.lit(float("-inf"))]
    return F.when(~(F.isnan(c) | c.isin(*infinities)), c)


def normalise_missing(df: DataFrame) -> DataFrame:
    """One notion of missing: NaN and infinities of every float column become NULL."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.select(*[finite(F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])


def risk_band(score: Column) -> Column:
    """Band of the published (six-decimal) score."""
    p = F.round(score, 6)
    return (
        F.when(p < 0.15, "LOW")
        .when(p < 0.30, "MEDIUM")
        .when(p < 0.50, "HIGH")
        .when(p.isNotNull(), "VERY HIGH")
    )


def predicted_class(score: Column, threshold: float | Column) -> Column:
    """Inclusive threshold on the unrounded score."""
    return (score >= threshold).cast("int")


# --------------------------------------------------------------------------
# names and column groups


def clean_name(name: str) -> str:
    """Name with every character that is neither letter nor digit set to ``_``."""
    return re.sub(r"\W", "_", name)


def clean_names(df: DataFrame) -> DataFrame:
    """Rename all columns through :func:`clean_name`; two names may not meet."""
    names = [clean_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns collide after cleaning: {clashes}")
    return df.toDF(*names)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def select_contract(df: DataFrame, key: str, wanted: Iterable[str]) -> DataFrame:
    """Key first, then the listed columns that exist, in list order."""
    present = set(df.columns)
    return df.select(key, *[c for c in wanted if c in present and c != key])
