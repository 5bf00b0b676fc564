"""Application-level features with fitted quantile bins."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskloom.functions import scalars as s
from riskloom.functions.binning import one_hot
from riskloom.operators.history import attach
from riskloom.operators.state import NotFittedError, fit_quantile_edges, quantile_bins
from riskloom.sources import contracts as c
from riskloom.sources.keyed import KeyedTable
from riskloom.sources.tables import conform

_INTERACTION = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")
_INPUTS = ("DAYS_EMPLOYED", "OWN_CAR_AGE", "DAYS_BIRTH", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", *_INTERACTION)


def application_features(df: DataFrame, interaction: Sequence[str] = _INTERACTION) -> DataFrame:
    """Derived columns that need no fitted values; absent inputs count as NULL."""
    missing = [name for name in _INPUTS if name not in df.columns]
    df = df.withColumns({name: F.lit(None).cast("double") for name in missing}) if missing else df
    col = F.col
    derived: dict[str, Column] = {
        "DAYS_EMPLOYED_ANOMALY": s.sentinel_flag(col("DAYS_EMPLOYED"), s.EMPLOYMENT_SENTINEL),
        "DAYS_EMPLOYED": s.drop_sentinel(col("DAYS_EMPLOYED"), s.EMPLOYMENT_SENTINEL),
        # takes the place of the raw Y/N column
        "FLAG_OWN_CAR": s.presence_flag(col("OWN_CAR_AGE")),
        "YEARS_BIRTH": s.days_to_years(col("DAYS_BIRTH")),
        "CREDIT_INCOME_PERCENT": s.safe_ratio(col("AMT_CREDIT"), col("AMT_INCOME_TOTAL")),
        "ANNUITY_INCOME_PERCENT": s.safe_ratio(col("AMT_ANNUITY"), col("AMT_INCOME_TOTAL")),
        "PAYMENT_RATE": s.safe_ratio(col("AMT_ANNUITY"), col("AMT_CREDIT")),
        "EXT_SOURCE_PRODUCT": s.product(*[col(name) for name in interaction]),
    }
    return df.withColumns(derived)


def encoded_features(
    df: DataFrame, domains: Mapping[str, Sequence[str]] = c.DOMAINS, below_levels: int = c.ENCODED_BELOW_LEVELS
) -> DataFrame:
    """Education rank and one-hot columns of the low-cardinality strings.

    The level contract is the closed domain, so the columns are the same for
    every table; the smallest level is dropped. Strings with ``below_levels``
    levels or more stay as they are.
    """
    out = [F.col(name) for name in df.columns]
    if "NAME_EDUCATION_TYPE" in df.columns:
        out.append(s.ordinal(F.col("NAME_EDUCATION_TYPE"), c.EDUCATION_RANKS).alias("NAME_EDUCATION_TYPE_ENCODED"))
    strings = set(s.string_columns(df, ["NAME_EDUCATION_TYPE"]))
    for name, levels in domains.items():
        if name in strings and len(levels) < below_levels:
            out += one_hot(name, levels, drop_first=True)
    return df.select(*out)


@dataclass
class FeatureEngineer:
    """Application features, quantile bins fitted on train, and the history join.

    ``main_features`` is the application contract (columns that do not exist are
    added as NULL); ``final_features`` the contract after the history join, by
    default everything.
    """

    history: DataFrame | KeyedTable | None = None
    main_features: Sequence[str] = field(default_factory=lambda: list(c.MAIN_FEATURES))
    final_features: Sequence[str] | None = None
    bins: Mapping[str, str] = field(default_factory=lambda: dict(c.QUANTILE_BINS))
    keep_bins: bool = False
    key: str = c.KEY
    edges: dict[str, list[float]] | None = None

    def fit(self, train: DataFrame) -> FeatureEngineer:
        present = [name for name in self.bins.values() if name in train.columns]
        self.edges = fit_quantile_edges(train, present)
        return self

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Key, the ``keep`` columns as they are, and the features."""
        if self.edges is None:
            raise NotFittedError("the feature engineer has not been fitted; call fit() first")
        encoded = encoded_features(application_features(df))
        flat = s.clean_names(quantile_bins(encoded, self.bins, self.edges))
        kept = [*keep, *self.main_features, *(self.bins if self.keep_bins else ())]
        present = {f.name: f.dataType for f in flat.schema}
        contract = T.StructType([T.StructField(self.key, T.LongType())])
        for name in kept:
            contract.add(name, present.get(name, T.DoubleType()))
        main = conform(flat, contract)
        joined = main if self.history is None else attach(main, self.history, self.key)
        clean = s.clean_names(s.normalise_missing(joined))
        if self.final_features is None:
            return clean
        return s.select_contract(clean, self.key, [*keep, *self.final_features])

    def save(self, spark: SparkSession, path: str) -> None:
        if self.edges is None:
            raise NotFittedError("nothing fitted to save")
        rows = [(name, json.dumps(v)) for name, v in self.edges.items()]
        spark.createDataFrame(rows, "column string, edges string").write.mode("overwrite").parquet(path)

    def load(self, spark: SparkSession, path: str) -> FeatureEngineer:
        self.edges = {r["column"]: json.loads(r["edges"]) for r in spark.read.parquet(path).collect()}
        return self
