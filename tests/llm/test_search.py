"""Cover-tree search against all scores."""

import math

import numpy as np
import pytest
from helpers import SMALL

from riskloom.llm import topk


def brute(rows, k=5, every=50):
    vectors = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(256 * float(np.float32(x))) for x in v]
        vectors[i] = min(w, vectors.get(i, w))
    out = []
    for q in vectors:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def found(df, **more):
    return sorted(tuple(r) for r in topk.top_k(df, **more).collect())


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (50, [0.5]), (50, [0.25]), (None, [1.0]), (2, None), (3, [float("nan")]),
            (4, [None]), (100, []), (7, [-3.0, 1.0, 9.0]), (8, [float("inf"), 1.0]), (-50, [1.0, -1.0, 0.001])]
    assert found(table(spark, rows)) == brute(rows)
    assert found(table(spark, rows).limit(0)) == []
    assert found(table(spark, [(0, [1.0])])) == []
    named = table(spark, rows).selectExpr("*", "'x' AS v", "1 AS cell", "2 AS q", "3L AS least")
    assert found(named) == brute(rows)


@pytest.mark.parametrize("sizes", [{}, {"query_rows": 3, "data_rows": 40}])
def test_clusters_ties_and_a_hot_vector(spark, sizes):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 16))
    rows = [(i, [float(x) for x in np.round(centres[i % 6] + rng.normal(scale=0.05, size=16), 2)]) for i in range(700)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)]
    assert found(table(spark, rows), **sizes) == brute(rows)


def test_given_vectors(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert found(df) == brute(rows)


def test_huge_components_stay_exact(spark):
    rows = [(i, [float(3 ** (i % 13)), float(i) * 1e4]) for i in range(0, 200)]
    assert found(table(spark, rows)) == brute(rows)


def test_tree_covers_its_points():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(c, 0.1, size=(400, 4)) for c in (0, 5, 9)])
    root = topk.tree(points)
    stack, leaves = [root], []
    while stack:
        node = stack.pop()
        assert np.linalg.norm(points[node.rows] - node.centre, axis=1).max() <= node.radius + 1e-9
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
            assert all(c.radius <= node.radius for c in node.children)
            stack += node.children
        else:
            leaves.append(node)
    assert len(leaves) > 1
