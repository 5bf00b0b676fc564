"""The offline build of the per-applicant history table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from riskloom.functions.scalars import clean_names, numeric_columns, string_columns
from riskloom.operators.history import join_child_rollup, outer_join, until
from riskloom.operators.rollup import RollupSpec, rollup, status_rollup, with_payment_columns
from riskloom.operators.state import fit_levels, fit_modes
from riskloom.sources import contracts as c
from riskloom.sources.cache import load_or_build
from riskloom.sources.keyed import KeyedTable, write_keyed
from riskloom.sources.tables import read_csv

# ---- fixed values: names of the history tables
TABLES = [
    "bureau", "bureau_balance", "installments_payments", "POS_CASH_balance", "credit_card_balance",
    "previous_application",
]
LOAN_KEY = "SK_ID_BUREAU"


def read_tables(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    return {name: read_csv(spark, paths[name], types=c.HISTORY_TYPES[name]) for name in TABLES}


def balance_rollup(balance: DataFrame) -> DataFrame:
    """Monthly balances per loan."""
    numeric = numeric_columns(balance, [LOAN_KEY])
    return status_rollup(balance, LOAN_KEY, "STATUS", c.STATUS_LEVELS, numeric)


def with_level_contract(spec: RollupSpec, df: DataFrame, max_levels: int = 1000) -> RollupSpec:
    """The spec with the levels and modes of all string columns of the table.

    Each level becomes two output columns; a column with more than ``max_levels`` is refused.
    """
    names = string_columns(df, [spec.key])
    return spec.with_levels(fit_levels(df, names, max_levels), fit_modes(df, names))


def bureau_rollup(bureau: DataFrame, balance: DataFrame, balance_stats: Sequence[str] = ("mean",)) -> DataFrame:
    """Loans per applicant, the monthly balances included through ``balance_stats``."""
    spec = with_level_contract(c.BUREAU, bureau)
    if balance_stats:
        months = balance_rollup(balance)
        added = {name: list(balance_stats) for name in months.columns if name != LOAN_KEY}
        spec = RollupSpec(spec.key, spec.prefix, {**spec.stats, **added}, spec.levels, spec.fills)
        bureau = join_child_rollup(bureau, months, LOAN_KEY)
    return rollup(bureau, spec)


def build_history(
    tables: Mapping[str, DataFrame], balance_stats: Sequence[str] = ("mean",), past_only: bool = False
) -> DataFrame:
    """One row per applicant that appears in any table, all aggregates side by side.

    ``past_only`` leaves out loans dated after the application.
    """
    bureau = tables["bureau"]
    if past_only:
        bureau = until(bureau, "DAYS_CREDIT")
    previous = tables["previous_application"]
    joined = outer_join(
        c.KEY,
        bureau_rollup(bureau, tables["bureau_balance"], balance_stats),
        rollup(with_payment_columns(tables["installments_payments"]), c.INSTALMENTS),
        rollup(tables["POS_CASH_balance"], c.POS_CASH),
        rollup(tables["credit_card_balance"], c.CREDIT_CARD),
        rollup(previous, with_level_contract(c.PREVIOUS, previous)),
    )
    return clean_names(joined)


def load_or_build_history(
    spark: SparkSession, paths: Mapping[str, str], cache: str, fingerprint: str | None = None
) -> DataFrame:
    return load_or_build(spark, cache, lambda: build_history(read_tables(spark, paths)), fingerprint)


def store_history(history: DataFrame, path: str, folders: int = 1024) -> KeyedTable:
    """The history by hash of the applicant, for scorers of few records at a time."""
    return write_keyed(history, path, c.KEY, folders)
