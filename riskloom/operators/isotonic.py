"""Isotonic fit of class shares by pooling adjacent violators, at any number of distinct scores.

Distinct scores are dealt into buckets of neighbouring values. Each bucket pools itself; then neighbouring buckets whose borders
still violate the order are pooled together, pair by pair and round by round, until no border does. Blocks stay in
the bucket they begin in, so a task never holds more than two buckets, and the driver sees one row for each of them.
The fitted blocks stay a table, and are applied by a join on the bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from riskloom.operators.ordered import _position, cut_points, default_buckets
from riskloom.session import stage

#: Up to so many ends of blocks are broadcast to the rows; with more the rows are dealt by bucket.
BROADCAST_KNOTS = 500_000
_BLOCKS = "bucket int, low double, high double, pos long, n long"


def pool(blocks: Sequence[tuple]) -> list[tuple]:
    """``(bucket, low, high, pos, n)`` in ascending order, pooled until no share is below the one before it."""
    held: list[tuple] = []
    for block in blocks:
        held.append(tuple(block))
        # whole numbers compare exactly; equal shares make one block
        while len(held) > 1 and held[-2][3] * held[-1][4] >= held[-1][3] * held[-2][4]:
            b, a = held.pop(), held.pop()
            held.append((a[0], a[1], b[2], a[3] + b[3], a[4] + b[4]))
    return held


def _pool_frame(frame: pd.DataFrame) -> pd.DataFrame:
    ordered = frame.sort_values("low")
    rows = zip(*(ordered[c].tolist() for c in ("bucket", "low", "high", "pos", "n")))
    return pd.DataFrame(pool(list(rows)), columns=["bucket", "low", "high", "pos", "n"])


def _bucket(cuts: Sequence[float], score: Column, buckets: int) -> Column:
    return _position(F.array(*[F.lit(c) for c in cuts]).cast("array<double>"), score, buckets).cast("int")


@dataclass
class IsotonicFit:
    """A step function, linear between the ends of neighbouring blocks and constant beyond the outer ones."""

    cuts: list[float]
    knots: DataFrame  # score, value
    buckets: int

    def blocks(self) -> DataFrame:
        """``score, value`` at the ends of the blocks."""
        return self.knots

    def _by_bucket(self) -> DataFrame:
        """The knots of each bucket between the last one before it and the first one behind it."""
        spark = self.knots.sparkSession
        held = self.knots.withColumn("bucket", _bucket(self.cuts, F.col("score"), self.buckets)).groupBy("bucket").agg(
            F.array_sort(F.collect_list(F.struct("score", "value"))).alias("own"))
        every = spark.range(len(self.cuts) + 1).select(F.col("id").cast("int").alias("bucket")).join(held, "bucket", "left")
        # one row a bucket
        across = W.orderBy("bucket")
        before = F.last(F.element_at("own", -1), ignorenulls=True).over(across.rowsBetween(W.unboundedPreceding, -1))
        behind = F.first(F.element_at("own", 1), ignorenulls=True).over(across.rowsBetween(1, W.unboundedFollowing))
        joined = F.filter(F.concat(F.array(before), F.coalesce("own", F.array().cast("array<struct<score: double, value: double>>")), F.array(behind)),
                          lambda k: k.isNotNull())
        return every.select(F.col("bucket").alias("_bucket"), joined.alias("_knots"))

    def apply(self, df: DataFrame, score: str, name: str) -> DataFrame:
        """``df`` with the fitted value; NULL and NaN scores, and fits without a knot, give NULL."""
        table = stage(self._by_bucket())
        if self.knots.count() <= BROADCAST_KNOTS:
            table = F.broadcast(table)
        x = F.col("_x")
        rows = df.withColumn("_x", F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double")))
        rows = rows.withColumn("_bucket", F.coalesce(_bucket(self.cuts, x, self.buckets), F.lit(0)))
        found = rows.join(table, "_bucket", "left").withColumn("_at", F.size(F.filter("_knots", lambda k: k["score"] <= x)))
        left, right = F.get("_knots", F.col("_at") - 1), F.get("_knots", F.col("_at"))
        value = (
            F.when(x.isNull(), None).when(F.col("_at") == 0, right["value"]).when(right.isNull(), left["value"])
            .otherwise(left["value"] + (right["value"] - left["value"]) * (x - left["score"]) / (right["score"] - left["score"]))
        )
        return found.select(*[F.col(f"`{c}`") for c in df.columns if c != name], value.alias(name))

    def save(self, path: str) -> None:
        self.knots.write.mode("overwrite").parquet(f"{path}/knots")
        spark = self.knots.sparkSession
        spark.createDataFrame([(self.cuts, self.buckets)], "cuts array<double>, buckets int").coalesce(1).write.mode("overwrite").parquet(f"{path}/cuts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IsotonicFit:
        head = spark.read.parquet(f"{path}/cuts").first()
        return cls(list(head["cuts"]), spark.read.parquet(f"{path}/knots"), head["buckets"])


def fit(counts: DataFrame, score: str, pos: str, neg: str, buckets: int | None = None) -> IsotonicFit:
    """Fit on distinct scores with their class counts; NULL and NaN scores take no part."""
    buckets = buckets or default_buckets(counts)
    rows = stage(counts.select(F.col(score).cast("double").alias("low"), F.col(pos).cast("long").alias("pos"), (F.col(pos) + F.col(neg)).cast("long").alias("n"))
                 .where(F.col("low").isNotNull() & ~F.isnan("low") & (F.col("n") > 0)))
    cuts = list(cut_points(rows, "low", buckets=buckets).first()["_cuts"])
    blocks = stage(
        rows.withColumn("bucket", _bucket(cuts, F.col("low"), buckets)).select("bucket", "low", F.col("low").alias("high"), "pos", "n")
        .groupBy("bucket").applyInPandas(_pool_frame, _BLOCKS))
    while pairs := _violating(blocks):
        # bounded by the number of buckets
        group = F.broadcast(counts.sparkSession.createDataFrame([(b, a) for a, c in pairs for b in (a, c)], "bucket int, pair int"))
        pooled = blocks.join(group, "bucket").groupBy("pair").applyInPandas(lambda frame: _pool_frame(frame.drop(columns="pair")), _BLOCKS)
        blocks = stage(blocks.join(group, "bucket", "left_anti").unionByName(pooled))
    value = F.col("pos") / F.col("n")
    ends = F.when(F.col("low") == F.col("high"), F.array("low")).otherwise(F.array("low", "high"))
    return IsotonicFit(cuts, stage(blocks.select(F.explode(ends).alias("score"), value.alias("value"))), buckets)


def _violating(blocks: DataFrame) -> list[tuple[int, int]]:
    """Pairs of neighbouring buckets, each bucket in one pair at most, whose border is out of order."""
    share = F.struct("pos", "n")
    edges = sorted(blocks.groupBy("bucket").agg(F.min_by(share, "low").alias("first"), F.max_by(share, "low").alias("last")).collect())
    pairs, i = [], 0
    while i + 1 < len(edges):
        left, right = edges[i]["last"], edges[i + 1]["first"]
        if left["pos"] * right["n"] > right["pos"] * left["n"]:
            pairs.append((edges[i]["bucket"], edges[i + 1]["bucket"]))
            i += 1
        i += 1
    return pairs
