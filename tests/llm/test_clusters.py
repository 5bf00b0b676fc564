"""Dimension-sharded Lloyd rounds against plain ones in whole numbers."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from helpers import SMALL

from riskloom.llm import clustering


def slow_lloyd(rows, k, rounds, dims, scale=256, seed="2"):
    kept = []
    for i, v in rows:
        if v is None or len(v) != dims or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(float(np.float32(x)) * scale) for x in v]))
    if not kept:
        return Counter()
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [list(v) for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(centres)):
            members = [v for (_, v), o in zip(kept, own) if o == j]
            if members:
                centres[j] = [sum(x) // len(members) for x in zip(*members)]
    told = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, j in told:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, j, d, inertia[j], sum(inertia.values()), digest[j]) for i, d, j in told)


def found(df, **more):
    return Counter(map(tuple, clustering.lloyd(df, **more).collect()))


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_awkward_vectors(spark):
    rows = [(1, [0.5, -1.25, 3.0]), (1, [0.5, -1.25, 3.0]), (2, [0.001, -0.001, 0.0]), (2, [9.0, 9.0, 9.0]), (None, [1.0, 1.0, 1.0]), (3, None),
            (4, [1.0, None, 1.0]), (5, [1.0, float("nan"), 1.0]), (6, [float("inf"), 1.0, 1.0]), (7, [1.0]), (8, []), (9, [1000.0, -1000.0, 0.0])]
    for k, block in ((3, 2), (40, 32), (1, 1)):
        df = table(spark, rows).selectExpr("*", "'x' AS chunk", "1 AS cluster", "2 AS block", "3 AS distance")
        assert found(df, k=k, rounds=4, dims=3, block=block) == slow_lloyd(rows, k, 4, 3)
    assert found(table(spark, rows).limit(0), dims=3) == Counter()
    assert found(table(spark, rows), dims=5) == Counter()


def test_ties_go_to_the_smaller_number_and_empty_centroids_stay(spark):
    rows = [(i, [1.0, 2.0]) for i in range(30)] + [(100 + i, [3.0, 2.0]) for i in range(5)]
    got = found(table(spark, rows), k=8, rounds=3, dims=2)
    assert got == slow_lloyd(rows, 8, 3, 2)


@pytest.mark.parametrize("block", [5, 16, 64])
def test_given_vectors(spark, block):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert found(df.repartition(7), block=block) == slow_lloyd(rows, 40, 5, 64)


def test_large_components(spark):
    rows = [(i, [(-1.0) ** i * 500_000.0 + i, float(i * 1000)]) for i in range(40)]
    assert found(table(spark, rows), k=5, rounds=3, dims=2) == slow_lloyd(rows, 5, 3, 2)
    with pytest.raises(Exception, match="no exact squared distance"):
        found(table(spark, [(1, [1e12, 0.0])]), dims=2)
