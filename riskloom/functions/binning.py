"""Cuts, equal-width bins and one-hot columns."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, functions as F


def cut(
    c: Column,
    edges: Sequence[float],
    labels: Sequence[str] | None = None,
    include_lowest: bool = True,
) -> Column:
    """Right-closed intervals ``(a, b]``; NULL outside the edges.

    ``include_lowest`` closes the first interval on the left as well. The
    result is the interval number from 0, or its label.
    """
    if len(edges) < 2:
        return F.lit(None).cast("int" if labels is None else "string")
    values = list(range(len(edges) - 1)) if labels is None else list(labels)
    if len(values) != len(edges) - 1:
        raise ValueError(f"{len(edges)} edges need {len(edges) - 1} labels, got {len(values)}")
    low = c < F.lit(edges[0]) if include_lowest else c <= F.lit(edges[0])
    out = F.when(low, F.lit(None))
    for upper, value in zip(edges[1:], values):
        out = out.when(c <= F.lit(upper), F.lit(value))
    return out


def grid_position(c: Column, grid: Sequence[float]) -> Column:
    """How many points of an evenly spaced ascending grid are ``<=`` the value.

    The position is computed from the spacing and then corrected against the
    neighbouring grid points, so it is exact and costs the same for any grid
    length.
    """
    points = F.array(*[F.lit(float(g)) for g in grid])
    n = len(grid)
    spacing = (grid[-1] - grid[0]) / (n - 1)
    # held to the grid before it becomes an integer: a value may lie any distance outside
    steps = (c - F.lit(float(grid[0]))) / F.lit(float(spacing))
    at = F.floor(F.greatest(F.least(steps, F.lit(float(n - 1))), F.lit(0.0))).cast("int")
    here = F.get(points, at) <= c
    following = F.coalesce(F.get(points, at + 1) <= c, F.lit(False))
    return F.when(c.isNotNull(), at + here.cast("int") + following.cast("int"))


def histogram_edges(low: float, high: float, bins: int) -> list[float]:
    """Equal-width edges; a constant range is widened by half a unit each side, or by what its size can resolve."""
    if low == high:
        half = max(0.5, abs(low) * 1e-9)
        low, high = low - half, high + half
    return [float(e) for e in np.linspace(low, high, bins + 1)]


def histogram_bin(c: Column, edges: Sequence[float]) -> Column:
    """Bin number from 0 for left-closed bins ``[a, b)``, the last one closed.

    Values beyond the outer edges fall into the first or last bin.
    """
    inner = edges[1:-1]
    if not inner:
        return F.when(c.isNotNull(), F.lit(0))
    if len(inner) == 1:
        return (c >= F.lit(inner[0])).cast("int")
    return grid_position(c, inner)


def one_hot(name: str, levels: Sequence[str], drop_first: bool = False) -> list[Column]:
    """0/1 columns ``<name>_<level>``; NULL and unseen levels give all zeros."""
    kept = sorted(levels)[1:] if drop_first else list(levels)
    return [level_flag(F.col(name), level).cast("double").alias(f"{name}_{level}") for level in kept]


def level_flag(c: Column, level: str) -> Column:
    return F.coalesce(c == F.lit(level), F.lit(False)).cast("int")
