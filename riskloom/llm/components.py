"""Connected components by contraction: no edge list, link or component ever reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.session import stage


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``; the root is the smallest node of the component.

    Each round hooks every node to the smallest of its neighbours' choices and contracts the edges, which at
    least halves the nodes that still have edges; the table of choices of each round is kept in the shared folder,
    and the rounds are composed at the end. Loops and repeated edges do no harm; no edges give no rows.
    """
    edges = stage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        ends = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        nearest = stage(ends.groupBy(F.col("e.a").alias("node")).agg(F.min("e.b").alias("least"))
                        .select("node", F.least("node", "least").alias("next")))
        jumped = nearest.select(F.col("node").alias("next"), F.col("next").alias("root"))
        chosen = stage(nearest.join(jumped, "next").select("node", "root"))
        rounds.append(chosen)
        left = chosen.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = chosen.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = stage(
            edges.join(left, "a").join(right, "b").where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        )
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = rounds[0]
    for later in rounds[1:]:
        onward = later.select(F.col("node").alias("root"), F.col("root").alias("onward"))
        found = found.join(onward, "root", "left").select("node", F.coalesce("onward", "root").alias("root"))
    return found
