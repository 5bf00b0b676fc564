"""Stratified splits and samples that do not depend on the partitioning.

A row's place is the hash of (id, seed) within its class. A part is "the first
k rows of the class in hash order", and k rows are cut off by comparing the
hash with the k-th smallest one. Finding that value takes narrow scans over the
hash alone; after that a split is a plain column expression, so the wide table
is neither shuffled nor sorted. Ids must be unique.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.operators.ordered import order_statistics
from riskloom.session import stage

_HASH_DIGITS = 13  # 52 bits: exact in a double
_HASH_RANGE = float(16**_HASH_DIGITS)
_PLACE = "_place_in_class"


def hash_text(key: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))


def _hash_number(text: Column) -> Column:
    return F.conv(F.substring(text, 1, _HASH_DIGITS), 16, 10).cast("double")


def class_sizes(df: DataFrame, label: str) -> dict:
    """Rows per class; a split needs few classes, so the counts fit the driver."""
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def allocate(sizes: Mapping, total: int) -> dict:
    """``total`` rows spread over classes by share, the remainders to the largest fractions."""
    n = sum(sizes.values())
    order = sorted(sizes, key=lambda c: (c is not None, c))
    exact = {c: sizes[c] * total / n for c in order}
    out = {c: math.floor(exact[c]) for c in order}
    left = total - sum(out.values())
    for c in sorted(order, key=lambda c: out[c] - exact[c])[:left]:
        out[c] += 1
    return out


def _among_first(df: DataFrame, key: str, label: str, seed: int, sizes: Mapping, wanted: Sequence[tuple]) -> dict:
    """Condition per ``(class, k)``: the row is one of the first k of its class, told by its column ``_PLACE``."""
    text = hash_text(F.col(key), seed)
    number = F.col(_PLACE)
    classes = list(sizes)
    member = {c: F.col(label).eqNullSafe(F.lit(c)) for c in classes}
    # hashing costs more than a scan of the hashes, and the searches below scan them several times
    hashed = stage(df.select(label, _PLACE))
    data = hashed.select(*[F.when(member[c], number).alias(f"c{i}") for i, c in enumerate(classes)])

    out, searches = {}, {}
    for c, k in wanted:
        n = sizes[c]
        if k <= 0 or k >= n:
            out[c, k] = member[c] if k >= n else F.lit(False)
            continue
        # hashes are uniform: the k-th one lies within a few deviations of k / n
        share = k / n
        slack = 8 * math.sqrt(share * (1 - share) / n) + 16 / n
        searches[c, k] = (max(0.0, share - slack) * _HASH_RANGE, min(1.0, share + slack) * _HASH_RANGE)
    while searches:
        order = list(searches)
        ranks = [(f"c{classes.index(c)}", *searches[c, k], k - 1) for c, k in order]
        missed = {}
        for (c, k), (cut, following) in zip(order, order_statistics(data, ranks)):
            if cut is None:
                missed[c, k] = (0.0, _HASH_RANGE)
            elif cut != following:
                out[c, k] = member[c] & (number <= F.lit(cut))
            else:
                out[c, k] = member[c] & _before_tie(df, key, text, number, member[c], cut, k)
        searches = missed
    return out


def _before_tie(df, key: str, text: Column, number: Column, member: Column, cut: float, k: int) -> Column:
    """Several ids share the cutting hash prefix: order those few by full hash and id."""
    place = F.struct(text.alias("t"), F.col(key).alias("k"))
    below = df.where(member & (number < F.lit(cut))).count()
    tied = df.where(member & (number == F.lit(cut))).select(place.alias("p"))
    last = tied.orderBy("p").limit(k - below).agg(F.max("p").alias("p")).first()["p"]
    return place <= F.struct(F.lit(last["t"]).alias("t"), F.lit(last["k"]).alias("k"))


def assign_parts(
    df: DataFrame, key: str, label: str, parts: Sequence[tuple[str, float]], rest: str, seed: int = 42
) -> DataFrame:
    """Add ``part``: held-out parts of exact size with the class ratio kept.

    ``parts`` are ``(name, share of the rows still left)`` in the order they are
    cut off; each has ``ceil(share * left)`` rows. What remains is ``rest``.
    """
    sizes = class_sizes(df, label)
    left = dict(sizes)
    limits = []
    for name, share in parts:
        take = allocate(left, math.ceil(share * sum(left.values())))
        left = {c: left[c] - take[c] for c in left}
        limits += [(name, c, sizes[c] - left[c]) for c in sizes]
    placed = df.withColumn(_PLACE, _hash_number(hash_text(F.col(key), seed)))
    first = _among_first(placed, key, label, seed, sizes, sorted({(c, k) for _, c, k in limits}, key=str))
    part = F.lit(rest)
    for name, c, k in reversed(limits):
        part = F.when(first[c, k], F.lit(name)).otherwise(part)
    return placed.withColumn("part", part).drop(_PLACE)


def train_valid_test(df: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """70 / 15 / 15."""
    return assign_parts(df, key, label, [("test", 0.15), ("valid", 0.15 / 0.85)], "train", seed)


def train_test(df: DataFrame, key: str, label: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    return assign_parts(df, key, label, [("test", test_share)], "train", seed)


def stratified_sample(df: DataFrame, key: str, label: str, share: float = 0.01, seed: int = 42) -> DataFrame:
    return assign_parts(df, key, label, [("sample", share)], "rest", seed).where(F.col("part") == "sample").drop("part")


def random_rows(df: DataFrame, key: str, n: int = 200, seed: int = 42) -> DataFrame:
    """``n`` rows with the smallest hashes: a top-k, not a sort of the table."""
    return df.orderBy(hash_text(F.col(key), seed), key).limit(n)
