"""The distributed isotonic fit against direct pooling and the engine's own."""

import numpy as np
import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from riskloom.operators import isotonic


def direct(scores, labels):
    """Fitted value at each distinct score, by pooling the whole list."""
    x, at = np.unique(scores, return_inverse=True)
    pos, n = np.bincount(at, labels).astype(int), np.bincount(at)
    held = []
    for i in range(len(x)):
        held.append([int(pos[i]), int(n[i]), 1])
        while len(held) > 1 and held[-2][0] * held[-1][1] >= held[-1][0] * held[-2][1]:
            b = held.pop()
            held[-1] = [held[-1][k] + b[k] for k in range(3)]
    return x, np.concatenate([[p / m] * k for p, m, k in held])


def table(spark, scores, labels):
    import pandas as pd

    rows = spark.createDataFrame(pd.DataFrame({"s": scores, "y": labels}))
    return rows, rows.groupBy("s").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q"))


def fitted(spark, scores, labels, asked, **more):
    _, counts = table(spark, scores, labels)
    fit = isotonic.fit(counts, "s", "p", "q", **more)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(asked)], "i long, s double")
    return fit, np.array([r.v for r in fit.apply(df, "s", "v").orderBy("i").collect()])


@pytest.mark.parametrize("kind", ["noisy", "rising", "falling", "ties", "one"])
@pytest.mark.parametrize("buckets", [1, 7, 40])
def test_equals_direct_pooling(spark, kind, buckets):
    rng = np.random.default_rng(3)
    scores = rng.random(3000)
    if kind == "ties":
        scores = np.round(scores, 2)
    share = {"rising": scores > 0.5, "falling": scores < 0.5}.get(kind, rng.random(3000) < scores)
    if kind == "one":
        scores, share = scores[:1], share[:1]
    labels = share.astype(int)
    x, want = direct(scores, labels)
    _, got = fitted(spark, scores, labels, x, buckets=buckets)
    assert got == pytest.approx(want, abs=1e-12)


def test_equals_the_engine_between_and_outside_the_knots(spark):
    rng = np.random.default_rng(5)
    scores = rng.random(500)
    labels = (rng.random(500) < scores**2).astype(int)
    asked = np.concatenate([[-1, 2], rng.random(300)])
    _, got = fitted(spark, scores, labels, asked, buckets=9)
    rows, _ = table(spark, scores, labels)
    engine = IsotonicRegression(labelCol="y", featuresCol="s").fit(rows.withColumn("y", F.col("y").cast("double")))
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(asked)], "i long, s double")
    want = [r.prediction for r in engine.transform(df).orderBy("i").collect()]
    assert got == pytest.approx(np.array(want), abs=1e-9)


def test_many_distinct_scores(spark):
    rng = np.random.default_rng(8)
    scores = rng.random(300_000)
    labels = (rng.random(300_000) < scores).astype(int)
    x, want = direct(scores, labels)
    fit, _ = fitted(spark, scores, labels, [0.5], buckets=30)
    knots = sorted((r.score, r.value) for r in fit.blocks().collect())
    at = np.searchsorted(x, [k for k, _ in knots])
    assert [v for _, v in knots] == pytest.approx(want[at], abs=1e-12)
    inner = np.interp(x, [k for k, _ in knots], [v for _, v in knots])
    assert inner == pytest.approx(want, abs=1e-12)


def test_nulls_saved_fits_and_empty_tables(spark, tmp_path):
    rows = [(0.1, 0), (0.2, 1), (0.3, 0), (None, 1), (float("nan"), 0), (0.9, 1)]
    counts = spark.createDataFrame(rows, "s double, y int").groupBy("s").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q"))
    fit = isotonic.fit(counts, "s", "p", "q", buckets=3)
    fit.save(str(tmp_path / "fit"))
    again = isotonic.IsotonicFit.load(spark, str(tmp_path / "fit"))
    df = spark.createDataFrame([(None, 1), (float("nan"), 2), (0.25, 3), (0.0, 4), (5.0, 5)], "s double, bucket int")
    for f in (fit, again):
        got = {r.bucket: r.v for r in f.apply(df, "s", "v").collect()}
        assert got == {1: None, 2: None, 3: 0.5, 4: 0.0, 5: 1.0}
    none = isotonic.fit(counts.limit(0), "s", "p", "q")
    assert [r.v for r in none.apply(df, "s", "v").collect()] == [None] * 5
