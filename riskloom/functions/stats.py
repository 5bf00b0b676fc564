"""The vocabulary of aggregate statistics used by the rollups."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def aggregate(stat: str, c: Column) -> Column:
    """Aggregate by name; a sum over nothing is 0, a variance over one row NULL."""
    if stat == "count":
        return F.count(c)
    if stat == "mean":
        return F.avg(c)
    if stat == "max":
        return F.max(c)
    if stat == "min":
        return F.min(c)
    if stat == "sum":
        return F.coalesce(F.sum(c), F.lit(0))
    if stat == "var":
        return F.var_samp(c)
    if stat == "nunique":
        return F.count_distinct(c)
    raise ValueError(f"unknown statistic {stat!r}")
