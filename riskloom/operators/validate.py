"""Data quality checks and record validation as table jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskloom.functions.scalars import numeric_columns, string_columns
from riskloom.sources.contracts import MIN_ROWS
from riskloom.sources.tables import schema_of

_CHECK = "check string, violations long"


def schema_check(df: DataFrame, required: Sequence[str], numeric: Sequence[str] = (), min_columns: int = 0) -> DataFrame:
    """``check, violations`` from the schema alone."""
    numbers = set(numeric_columns(df))
    rows = [(f"required:{c}", int(c not in df.columns)) for c in required]
    rows += [(f"numeric:{c}", int(c not in numbers)) for c in numeric]
    rows.append(("min_columns", int(len(df.columns) < min_columns)))
    return df.sparkSession.createDataFrame(rows, _CHECK)


def size_check(df: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """``check, violations``: 1 if the table has fewer rows than a delivery must have."""
    return df.agg((F.count(F.lit(1)) < min_rows).cast("long").alias("violations")).select(
        F.lit("min_rows").alias("check"), "violations")


def key_check(df: DataFrame, key: str) -> DataFrame:
    """``rows, null_keys, duplicated_keys, extra_rows``; counts combine before the shuffle."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    present, n = F.col(key).isNotNull(), F.col("n")
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(~present, n)), F.lit(0)).alias("null_keys"),
        F.count_if(present & (n > 1)).alias("duplicated_keys"),
        F.coalesce(F.sum(F.when(present, n - 1)), F.lit(0)).alias("extra_rows"),
    )


@dataclass(frozen=True)
class Rule:
    """A named condition that every non-NULL value must meet."""

    name: str
    holds: Column


def rule_check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``check, violations`` for all rules in one pass; NULL never violates."""
    row = df.agg(*[F.count_if(~r.holds).alias(f"r{i}") for i, r in enumerate(rules)])
    entries = F.array(*[
        F.struct(F.lit(r.name).alias("check"), F.col(f"r{i}").alias("violations")) for i, r in enumerate(rules)
    ])
    return row.select(F.inline(entries))


def binary_target(target: str) -> list[Rule]:
    return [
        Rule("target_binary", F.col(target).isin(0, 1)),
        Rule("target_not_null", F.col(target).isNotNull()),
    ]


def application_rules(columns: Sequence[str]) -> list[Rule]:
    """Range rules of the application table, for the columns it has."""
    rules = {
        "AMT_CREDIT": F.col("AMT_CREDIT") > 0,
        "AMT_INCOME_TOTAL": F.col("AMT_INCOME_TOTAL") > 0,
        "DAYS_BIRTH": F.col("DAYS_BIRTH") < 0,
        **{f"EXT_SOURCE_{i}": F.col(f"EXT_SOURCE_{i}").between(0, 1) for i in (1, 2, 3)},
    }
    return [Rule(f"range:{c}", holds) for c, holds in rules.items() if c in columns]


def rate_check(df: DataFrame, target: str, low: float, high: float) -> DataFrame:
    """Whether the target rate lies in its expected range."""
    rate = F.avg(target)
    return df.agg((~F.coalesce(rate.between(low, high), F.lit(False))).cast("long").alias("violations")).select(
        F.lit("target_rate").alias("check"), "violations"
    )


def content_check(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Rows without any value, and infinite values in float columns."""
    data = [c for c in df.columns if c not in exclude]
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name in data]
    infinite = [F.coalesce(F.abs(F.col(c)) == float("inf"), F.lit(False)).cast("long") for c in floats]
    empty = F.lit(True)
    for c in data:
        empty = empty & F.col(c).isNull()
    row = df.agg(
        F.count_if(empty).alias("all_null_rows"),
        F.coalesce(F.sum(sum(infinite, F.lit(0))), F.lit(0)).cast("long").alias("infinite_values"),
    )
    return row.unpivot([], ["all_null_rows", "infinite_values"], "check", "violations")


def domain_rejects(df: DataFrame, key: str, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """``key, column, value`` for every value outside its closed domain; NULL is allowed."""
    names = [c for c in domains if c in df.columns]
    found = F.array(*[
        F.when(
            F.col(c).isNotNull() & ~F.col(c).isin(list(domains[c])),
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")),
        )
        for c in names
    ])
    return df.select(key, F.explode(F.array_compact(found)).alias("r")).select(key, "r.*")


# --------------------------------------------------------------------------
# records


def _reason(c: str, kind: str, domains: Mapping[str, Sequence[str]]) -> Column:
    """Why a text value is not acceptable, or NULL."""
    value = F.col(c)
    if c in domains:
        return F.when(~value.isin([str(v) for v in domains[c]]), F.lit("unknown_level"))
    number = value.try_cast("double")
    if kind == "float64":  # neither text nor infinity is one; NaN means missing
        return F.when(value.isNotNull() & (number.isNull() | (F.abs(number) == float("inf"))), F.lit("not_a_number"))
    if kind == "int64":
        whole = value.try_cast("bigint").isNotNull() | F.coalesce(number == F.floor(number), F.lit(False))
        return F.when(value.isNotNull() & ~whole, F.lit("not_an_integer"))
    return F.lit(None).cast("string")


def check_records(df: DataFrame, types: Mapping[str, str], domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Text records plus ``_reasons``: one entry per field that breaks its type or domain.

    All fields are optional, but a record without any value is rejected.
    """
    names = [c for c in types if c in df.columns]
    found = []
    for c in names:
        reason = _reason(c, types[c], domains)
        found.append(F.when(
            reason.isNotNull(),
            F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), reason.alias("reason")),
        ))
    empty = F.lit(True)
    for c in names:
        empty = empty & F.col(c).isNull()
    none = F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("value"),
                    F.lit("empty_record").alias("reason"))
    return df.withColumn("_reasons", F.array_compact(F.array(*found, F.when(empty, none))))


def valid_records(checked: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Accepted records in their proper types."""
    schema = schema_of({c: t for c, t in types.items() if c in checked.columns})
    out = []
    for f in schema:
        c = F.col(f.name)
        if isinstance(f.dataType, T.LongType):
            c = F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))
        elif isinstance(f.dataType, T.DoubleType):
            c = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
        out.append(c.cast(f.dataType).alias(f.name))
    return checked.where(F.size("_reasons") == 0).select(*out)


def rejected_records(checked: DataFrame, key: str) -> DataFrame:
    """``key, column, value, reason``: one row per broken field."""
    return checked.select(key, F.explode("_reasons").alias("r")).select(key, "r.*")


# --------------------------------------------------------------------------
# derived schema


def type_table(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """``column, type`` in the int64 / float64 / object vocabulary."""
    def kind(t: T.DataType) -> str:
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            return "int64"
        return "float64" if isinstance(t, T.NumericType) else "object"

    rows = [(f.name, kind(f.dataType)) for f in df.schema if f.name not in exclude]
    return df.sparkSession.createDataFrame(rows, "column string, type string")


def domain_catalog(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, value``: the distinct non-NULL values of the string columns, as rows."""
    names = list(columns or string_columns(df))
    return (
        df.select(*names)
        .unpivot([], names, "column", "value")
        .where(F.col("value").isNotNull())
        .distinct()
    )


def table_fingerprint(df: DataFrame) -> str:
    """Content fingerprint that depends on the rows but not on their order or files."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("s"),
    ).first()
    return f"{row['n']}-{int(row['s'] or 0) & ((1 << 64) - 1):016x}"
