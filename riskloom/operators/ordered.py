"""Global order without a single partition.

Curves, rank statistics and exact quantiles need running totals over *all*
values. A bare ``Window.orderBy`` would move every row into one task. Here the
value range is cut into buckets, a running total is taken inside each bucket,
and the totals of the buckets before it are added from a small table with one
row per bucket.

Any cut points give the right result; they only balance the load. They come
from a quantile sketch and enter the plan as constants, so a retried task sees
the same buckets as the first attempt.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

BUCKET = "_bucket"


def default_buckets(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def cut_points(df: DataFrame, value: str, keys: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Constant table ``keys, _cuts`` with at most ``buckets - 1`` ascending cuts per key.

    The sketch is a map-side aggregate of fixed size; the driver receives one
    short array per key (keys are features or periods, never row ids).
    """
    buckets = buckets or default_buckets(df)
    shares = [i / buckets for i in range(1, buckets)] or [0.5]
    sketch = df.groupBy(*keys).agg(
        F.approx_percentile(F.col(value).cast("double"), shares, max(2000, 10 * buckets)).alias("_cuts")
    )
    rows = [tuple(r[k] for k in keys) + (sorted(set(r["_cuts"] or [])),) for r in sketch.collect()]
    fields = [df.schema[k] for k in keys] + [T.StructField("_cuts", T.ArrayType(T.DoubleType()))]
    return df.sparkSession.createDataFrame(rows, T.StructType(fields))


def _position(cuts: Column, value: Column, buckets: int) -> Column:
    """Number of ascending cuts below the value: every s-th cut first, then one stretch."""
    step = max(1, int(buckets**0.5))
    coarse = F.filter(cuts, lambda cut, i: (i % step == step - 1) & (cut < value))
    skipped = F.size(coarse) * step
    return skipped + F.size(F.filter(F.slice(cuts, skipped + 1, step), lambda cut: cut < value))


def with_buckets(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = (),
    buckets: int | None = None,
    descending: bool = False,
    sketch_from: DataFrame | None = None,
) -> DataFrame:
    """Add the bucket number; buckets ascend in the requested order.

    ``sketch_from`` is the frame to take the cut points from: the uncollapsed
    rows, whose sketch needs no shuffle.
    """
    buckets = buckets or default_buckets(df)
    cuts = cut_points(sketch_from if sketch_from is not None else df, value, keys, buckets)
    if keys:
        out = df.join(F.broadcast(cuts), list(keys))
    else:
        head = cuts.first()
        points = head["_cuts"] if head else []
        out = df.withColumn("_cuts", F.array(*[F.lit(p) for p in points]).cast("array<double>"))
    position = _position(F.col("_cuts"), F.col(value), buckets)
    return out.withColumn(BUCKET, (-position if descending else position).cast("int")).drop("_cuts")


def running(
    df: DataFrame,
    order: Sequence[str],
    totals: Mapping[str, Column],
    keys: Sequence[str] = (),
    descending: bool = False,
    following: Sequence[str] = (),
    preceding: Sequence[str] = (),
    whole: bool = False,
) -> DataFrame:
    """Running totals in global order over a frame that carries ``_bucket``.

    ``totals`` maps output name to the summed expression (inclusive of the row);
    ``whole`` adds ``all_<name>`` with the total per key.
    ``following``/``preceding`` add ``next_<c>``/``prev_<c>`` of the neighbour
    in global order, across bucket borders.
    """
    keys = list(keys)
    names = list(totals)
    inputs = df.select("*", *[e.alias(f"_in_{n}") for n, e in totals.items()])

    # one row per bucket: its totals and its outermost rows
    edge = [F.sum(f"_in_{n}").alias(f"_sum_{n}") for n in names]
    # plain numbers as place and value keep these in a hash aggregate
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    first, last = (F.max_by, F.min_by) if descending else (F.min_by, F.max_by)
    edge += [first(c, place).alias(f"_head_{c}") for c in following]
    edge += [last(c, place).alias(f"_tail_{c}") for c in preceding]
    small = inputs.groupBy(*keys, BUCKET).agg(*edge)
    across = W.partitionBy(*keys).orderBy(BUCKET)
    before = across.rowsBetween(W.unboundedPreceding, -1)
    carry = [F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_off_{n}") for n in names]
    if whole:
        carry += [F.sum(f"_sum_{n}").over(W.partitionBy(*keys)).alias(f"all_{n}") for n in names]
    carry += [F.lead(f"_head_{c}").over(across).alias(f"_next_{c}") for c in following]
    carry += [F.lag(f"_tail_{c}").over(across).alias(f"_prev_{c}") for c in preceding]
    offsets = small.select(*keys, BUCKET, *carry)

    within = W.partitionBy(*keys, BUCKET).orderBy(*[F.desc(o) if descending else F.asc(o) for o in order])
    upto = within.rowsBetween(W.unboundedPreceding, W.currentRow)
    inner = [F.sum(f"_in_{n}").over(upto).alias(f"_run_{n}") for n in names]
    inner += [F.lead(c).over(within).alias(f"_lead_{c}") for c in following]
    inner += [F.lag(c).over(within).alias(f"_lag_{c}") for c in preceding]
    ranked = inputs.select("*", *inner)

    # (keys x buckets) rows whatever the size of the data, hence the broadcast
    joined = ranked.join(F.broadcast(offsets), [*keys, BUCKET])
    out = [F.col(c) for c in df.columns]
    out += [(F.col(f"_run_{n}") + F.col(f"_off_{n}")).alias(n) for n in names]
    out += [F.col(f"all_{n}") for n in names] if whole else []
    out += [F.coalesce(f"_lead_{c}", f"_next_{c}").alias(f"next_{c}") for c in following]
    out += [F.coalesce(f"_lag_{c}", f"_prev_{c}").alias(f"prev_{c}") for c in preceding]
    return joined.select(*out)


# --------------------------------------------------------------------------
# exact quantiles

_SKETCH = 10_000


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> dict[str, list[float] | None]:
    """Exact linearly interpolated quantiles of many columns at once.

    Spark's ``percentile`` and ``median`` keep every distinct value of a column
    in one buffer, which does not survive a large table. Instead: a sketch
    brackets each wanted rank, one scan counts the rows below each bracket, and
    only the values inside the brackets (about ``6 / 10000`` of the rows per
    share) are grouped, ordered and searched for the exact neighbours. A rank
    that a bracket misses is searched again over the whole column.

    Returns one list per column (``None`` for a column without values).
    """
    columns = list(columns)
    if not columns:
        return {}
    ids = {c: f"c{i}" for i, c in enumerate(columns)}
    data = df.select(*[F.col(c).cast("double").alias(ids[c]) for c in columns])

    delta = 3.0 / _SKETCH
    asked = [max(0.0, p - delta) for p in shares] + [min(1.0, p + delta) for p in shares]
    sketch = []
    for c in ids.values():
        sketch += [
            F.count(c).alias(f"{c}_n"),
            F.min(c).alias(f"{c}_lo"),
            F.max(c).alias(f"{c}_hi"),
            F.approx_percentile(c, asked, _SKETCH).alias(f"{c}_q"),
        ]
    head = data.agg(*sketch).first().asDict()

    # one search per (column, share): the ranks wanted and the bracket that holds them
    searches, found = [], {}
    for name, c in ids.items():
        n = head[f"{c}_n"]
        for j, p in enumerate(shares if n else ()):
            whole = (head[f"{c}_lo"], head[f"{c}_hi"])
            if p in (0, 1):  # the ends need no search
                found[name, j] = whole[int(p)]
                continue
            low = head[f"{c}_q"][j] if p > delta else whole[0]
            high = head[f"{c}_q"][len(shares) + j] if p < 1 - delta else whole[1]
            searches.append({"name": name, "c": c, "j": j, "at": p * (n - 1), "in": (low, high), "whole": whole})
    pending = searches
    while pending:
        values = order_statistics(data, [(s["c"], *s["in"], int(s["at"])) for s in pending])
        missed = []
        for s, (left, right) in zip(pending, values):
            if left is None:
                if s["in"] == s["whole"]:
                    raise RuntimeError(f"rank {s['at']} not found in {s['name']}")
                missed.append({**s, "in": s["whole"]})
            else:
                found[s["name"], s["j"]] = _between(left, right, s["at"] - int(s["at"]))
        pending = missed
    return {
        name: [found[name, j] for j in range(len(shares))] if head[f"{c}_n"] else None for name, c in ids.items()
    }


def _between(left: float, right: float | None, share: float) -> float:
    if share == 0 or right is None:
        return left
    gap = right - left
    return left + gap * share if share < 0.5 else right - gap * (1 - share)


def order_statistics(
    data: DataFrame, wanted: Sequence[tuple[str, float, float, int]]
) -> list[tuple[float | None, float | None]]:
    """The values at ranks ``r`` and ``r + 1`` for ``(column, low, high, r)``.

    Only values within ``[low, high]`` are grouped; the first value is None if
    rank ``r`` lies outside.
    """
    number = {b: i for i, b in enumerate(sorted({w[:3] for w in wanted}))}
    outside = data.agg(
        *[F.count_if(F.col(c) < F.lit(low)).alias(f"b{i}") for (c, low, _), i in number.items()],
        # the smallest value beyond the bracket: the upper neighbour of its last rank
        *[F.min(F.when(F.col(c) > F.lit(high), F.col(c))).alias(f"a{i}") for (c, _, high), i in number.items()],
    ).first()

    rows = (
        # most rows lie outside all brackets; they go before the others are multiplied
        data.where(reduce(or_, [F.col(c).between(low, high) for c, low, high in number]))
        .select(
            *[F.when(F.col(c).between(low, high), F.col(c)).alias(str(i)) for (c, low, high), i in number.items()]
        )
        .unpivot([], [str(i) for i in number.values()], "id", "v")
        .where(F.col("v").isNotNull())
        .select(F.col("id").cast("int").alias("id"), "v")
    )
    inside = rows.groupBy("id", "v").agg(F.count(F.lit(1)).alias("n"))
    # cut by a sketch, so that a heavy end or a repeated search over a whole column is dealt evenly
    inside = with_buckets(inside, "v", ["id"], sketch_from=rows)
    ranked = running(inside, ["v"], {"upto": F.col("n")}, ["id"])

    ranks = sorted({
        (number[w[:3]], w[3] + step - outside[f"b{number[w[:3]]}"]) for w in wanted for step in (0, 1)
    })
    targets = data.sparkSession.createDataFrame(ranks, "id int, rank long")
    hits = (
        ranked.join(F.broadcast(targets), "id")
        .where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
        .select("id", "rank", "v")
    )
    at = {(r["id"], r["rank"]): r["v"] for r in hits.collect()}
    out = []
    for w in wanted:
        i = number[w[:3]]
        rank = w[3] - outside[f"b{i}"]
        out.append((at.get((i, rank)), at.get((i, rank + 1), outside[f"a{i}"])))
    return out
