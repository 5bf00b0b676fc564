"""Boosted ensembles as tables: nodes read from the stored model, losses of all its beginnings in one pass, and truncation."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.session import stage_folder

#: Rows whose margins under all beginnings are held at once.
_ROWS = 1024


def node_table(model: GBTClassificationModel, spark: SparkSession) -> DataFrame:
    """``tree, node, left, right, feature, threshold, value, weight`` of every node; leaves have children -1.

    The model is written to the shared folder and read back, so no node costs a call to the engine.
    """
    path = f"{stage_folder(spark)}/{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    weights = spark.createDataFrame(list(enumerate(map(float, model.treeWeights))), "tree int, weight double")
    return nodes.join(F.broadcast(weights), "tree").select(
        "tree", F.col("id").alias("node"), F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
        F.col("split.featureIndex").alias("feature"), F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("prediction").alias("value"), "weight")


@dataclass(frozen=True)
class Forest:
    """All trees in flat arrays; the children of a leaf are the leaf itself. As large as the model, whatever the data."""

    roots: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray  # prediction times weight

    @classmethod
    def of(cls, model: GBTClassificationModel, spark: SparkSession) -> Forest:
        rows = node_table(model, spark).orderBy("tree", "node").collect()
        tree = np.array([r["tree"] for r in rows])
        roots = np.searchsorted(tree, np.arange(len(model.treeWeights)))
        base, own = roots[tree], np.arange(len(rows))
        left, right = (np.array([r[c] for r in rows]) for c in ("left", "right"))
        leaf = left < 0
        return cls(
            roots, np.where(leaf, own, base + left), np.where(leaf, own, base + right), np.array([max(0, r["feature"]) for r in rows]),
            np.array([np.inf if r["threshold"] is None else r["threshold"] for r in rows]), np.array([r["value"] * r["weight"] for r in rows]))

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Margin of each row under the first 1, 2, ... trees."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        while True:
            down = np.where(np.take_along_axis(x, self.feature[at], axis=1) <= self.threshold[at], self.left[at], self.right[at])
            if (down == at).all():
                return np.cumsum(self.value[at], axis=1)
            at = down


def prefix_losses(model: GBTClassificationModel, rows: DataFrame, label: str, features: str = "features") -> list[float]:
    """Mean log loss on ``rows`` under the first 1, 2, ... trees, in one pass.

    A task adds up its rows and hands on one number for each tree.
    """
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(Forest.of(model, spark))

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = sent.value
        total, n = np.zeros(len(forest.roots)), 0
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), np.float64).reshape(batch.num_rows, -1)
            sign = 2.0 * np.asarray(batch.column("y")) - 1
            for i in range(0, len(x), _ROWS):
                total += np.logaddexp(0, -2 * sign[i : i + _ROWS, None] * forest.margins(x[i : i + _ROWS])).sum(axis=0)
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64())), pa.array([n], pa.int64())], ["sums", "n"])

    sums = rows.select(F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x")).mapInArrow(losses, "sums array<double>, n long")
    found = sums.select("n", F.posexplode("sums").alias("round", "sum")).groupBy("round").agg((F.sum("sum") / F.sum("n")).alias("loss"))
    return [r["loss"] for r in found.orderBy("round").collect()]


def early_stop(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """How many rounds are best before ``patience`` rounds bring nothing better, and whether that many were seen."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        if i - best >= patience:
            return best + 1, True
    return best + 1, False


def truncate(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first ``rounds`` trees."""
    held, context = model._java_obj, SparkContext._active_spark_context
    gateway, jvm = context._gateway, context._jvm
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    all_trees, all_weights = held.trees(), model.treeWeights
    for i in range(rounds):
        trees[i], weights[i] = all_trees[i], float(all_weights[i])
    short = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        held.uid(), trees, weights, held.numFeatures(), held.numClasses()))
    return short.setFeaturesCol(model.getFeaturesCol())
