"""Exact top-k search by inner product with cover trees over queries and data.

A bounded sample of the vectors gives the upper level of the tree: centres by farthest-first traversal. Every row joins its
nearest centre's cell; a cell's covering radius is measured over all its rows. The sample also gives each query a score
that its k-th best must reach. A pair of a query cell and a data cell is followed only if the bound from centres
and radii reaches the worst of those scores in the query cell.

What is left is dealt as blocks of queries against blocks of data, both of bounded size, so a cell with a third of all rows
is many blocks. Each pair of blocks is searched by a cover tree on either side: pairs of nodes are visited best first and
pruned by their covering radii against the worst k-th score in the group of queries; leaves are compared by a matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskloom.llm.arrow import bounded_batches
from riskloom.session import stage

#: Vectors that give the centres and the first bounds, and centres, at most.
SAMPLE, CENTRES = 2048, 64
#: Queries and data rows of a block, about.
QUERY_ROWS, DATA_ROWS = 4096, 16384
_LEAF, _FAN, _SHRINK = 256, 24, 0.6
_AT_ONCE = 1 << 22
_NONE = -(1 << 62)


@dataclass
class Node:
    rows: np.ndarray
    centre: np.ndarray
    radius: float
    children: list[Node]


def cover(points: np.ndarray, rows: np.ndarray, first: int = 0, most: int = _FAN, within: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Farthest-first centres among ``rows`` until all are ``within`` or there are ``most``: centres, nearest, distances."""
    own = points[rows]
    chosen = [first]
    distance = np.sqrt(((own - own[first]) ** 2).sum(axis=1))
    nearest = np.zeros(len(rows), np.int64)
    while len(chosen) < most and len(rows):
        far = int(distance.argmax())
        if distance[far] <= within:
            break
        new = np.sqrt(((own - own[far]) ** 2).sum(axis=1))
        closer = new < distance
        nearest[closer], distance[closer] = len(chosen), new[closer]
        chosen.append(far)
    return np.array(chosen), nearest, distance


def tree(points: np.ndarray, rows: np.ndarray | None = None) -> Node:
    """Cover tree: children lie within a shrinking part of the radius; points too spread for that stay a leaf."""
    rows = np.arange(len(points)) if rows is None else rows
    centre = points[rows[0]]
    distance = np.sqrt(((points[rows] - centre) ** 2).sum(axis=1))
    node = Node(rows, centre, float(distance.max()), [])
    if len(rows) > _LEAF and node.radius > 0:
        chosen, nearest, reach = cover(points, rows, 0, _FAN, node.radius * _SHRINK)
        if len(chosen) > 1 and reach.max() <= node.radius * _SHRINK:
            # each child begins with its centre
            for i, at in enumerate(chosen):
                own = rows[nearest == i]
                node.children.append(tree(points, np.concatenate([rows[at : at + 1], own[own != rows[at]]])))
    return node


def _bound(one: Node, two: Node) -> float:
    a, b = np.linalg.norm(one.centre), np.linalg.norm(two.centre)
    top = float(one.centre @ two.centre) + one.radius * b + two.radius * a + one.radius * two.radius
    return top + 1e-9 * abs(top) + 1e-6


def _exact(one: np.ndarray, two: np.ndarray) -> bool:
    """Whether products of these integers stay exact in doubles."""
    if not len(one) or not len(two):
        return True
    return float(np.abs(one).max(initial=0)) * float(np.abs(two).max(initial=0)) * one.shape[1] < 2**52


def search(queries: np.ndarray, query_ids: np.ndarray, least: np.ndarray, data: np.ndarray, data_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids (queries, k) of the best data rows that are not the query's own; empty places score ``_NONE``."""
    # of equal vectors only the k + 1 smallest ids can be among the best k of any query
    order = np.argsort(data_ids, kind="stable")
    data, data_ids = data[order], data_ids[order]
    _, group = np.unique(data, axis=0, return_inverse=True)
    group = group.ravel()
    by_group = np.argsort(group, kind="stable")
    starts = np.flatnonzero(np.diff(group[by_group], prepend=-1))
    rank = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
    keep = np.sort(by_group[rank <= k])
    data, data_ids = data[keep], data_ids[keep]

    fast = _exact(queries, data)
    q, d = queries.astype(np.float64), data.astype(np.float64)
    norms = np.sqrt((q**2).sum(axis=1))
    scores = np.full((len(q), k), _NONE, np.int64)
    ids = np.full((len(q), k), np.iinfo(np.int64).max, np.int64)
    needed = least.astype(np.float64)

    def compare(one: Node, two: Node) -> None:
        near = q[one.rows] @ two.centre + norms[one.rows] * two.radius
        near += 1e-9 * np.abs(near) + 1e-6
        wanted = one.rows[near >= needed[one.rows]]
        rows = np.sort(two.rows)  # by id
        per = max(1, _AT_ONCE // len(rows))
        for at in range(0, len(wanted), per):
            some = wanted[at : at + per]
            s = (q[some] @ d[rows].T).astype(np.int64) if fast else queries[some] @ data[rows].T
            place = np.searchsorted(data_ids[rows], query_ids[some])
            place[place == len(rows)] = 0
            own = data_ids[rows][place] == query_ids[some]
            s[np.flatnonzero(own), place[own]] = _NONE
            if len(rows) > k:
                if fast:  # ties go to the smaller id, which comes first
                    best = np.argpartition(s * -len(rows) + np.arange(len(rows)), k, axis=1)[:, :k] if abs(int(s[s > _NONE].min(initial=0))) < 2**40 and not own.any() else np.argsort(-s, axis=1, kind="stable")[:, :k]
                else:
                    best = np.argsort(-s, axis=1, kind="stable")[:, :k]
                s = np.take_along_axis(s, best, axis=1)
                new = data_ids[rows][best]
            else:
                new = np.broadcast_to(data_ids[rows], s.shape)
            new = np.where(s == _NONE, np.iinfo(np.int64).max, new)
            s, new = np.hstack([scores[some], s]), np.hstack([ids[some], new])
            best = np.lexsort((new, -s), axis=1)[:, :k]
            scores[some], ids[some] = np.take_along_axis(s, best, axis=1), np.take_along_axis(new, best, axis=1)
            needed[some] = np.maximum(needed[some], scores[some, -1])

    if len(q) and len(d):
        stack = [(tree(q), tree(d))]
        while stack:
            one, two = stack.pop()
            if _bound(one, two) < needed[one.rows].min():
                continue
            if not one.children and not two.children:
                compare(one, two)
            elif two.children and (not one.children or two.radius >= one.radius):
                stack += sorted(((one, c) for c in two.children), key=lambda p: float(p[0].centre @ p[1].centre))
            else:
                stack += [(c, two) for c in one.children]
    return scores, ids


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists as rows of integers, filled up with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def integers(embedding: Column) -> Column:
    """floor(256 x) of every component."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * 256))


def _blocks(sizes: dict[int, int], most: int) -> tuple[dict[int, tuple[int, int]], int]:
    """First block and number of blocks of each cell; small cells share one."""
    at, filled, found = 0, 0, {}
    for cell, size in sorted(sizes.items()):
        if size > most:
            if filled:
                at, filled = at + 1, 0
            parts = -(-size // most)
            found[cell] = (at, parts)
            at += parts
        else:
            if filled + size > most:
                at, filled = at + 1, 0
            found[cell] = (at, 1)
            filled += size
    return found, at + 1


def top_k(
    vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding",
    query_rows: int = QUERY_ROWS, data_rows: int = DATA_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` highest integer inner products of each query, ties to smaller ids.

    Queries are the rows whose id ``every`` divides; all rows but the query's own are candidates. NULL vectors, vectors with
    NULL or non-finite components and rows without an id take no part. Vectors of unequal length are compared over the
    components both have. Scores have to fit a long. Of several rows of one id the one with the smallest vector counts. Queries without
    a candidate, and empty tables, give no rows.
    """
    spark = vectors.sparkSession
    raw = F.col(f"`{vector_col}`")
    usable = raw.isNotNull() & F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = stage(
        bounded_batches(vectors).where(F.coalesce(usable, F.lit(False)) & F.col(f"`{id_col}`").isNotNull())
        .select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), integers(raw).alias("v"))
        .groupBy("vec_id").agg(F.min("v").alias("v"))
    )
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    points = _matrix(sample.column("v"), width)
    ids = sample.column("vec_id").to_numpy()
    centres = points[cover(points.astype(np.float64), np.arange(len(points)), 0, CENTRES)[0]].astype(np.float64)
    # all three are bounded by the two numbers above
    sent = spark.sparkContext.broadcast((points, ids, centres))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, ids, centres = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            own, own_ids = _matrix(batch.column("v"), width), batch.column("vec_id").to_numpy()
            at = own.astype(np.float64)
            cell = ((centres**2).sum(axis=1) - 2 * at @ centres.T).argmin(axis=1)
            distance = np.sqrt(((at - centres[cell]) ** 2).sum(axis=1))
            least = np.full(len(own), _NONE, np.int64)
            asks = np.flatnonzero(own_ids % every == 0)
            if len(asks) and len(points) > k:
                exact = _exact(own[asks], points)
                s = (at[asks] @ points.T.astype(np.float64)).astype(np.int64) if exact else own[asks] @ points.T
                s[own_ids[asks][:, None] == ids[None, :]] = _NONE
                least[asks] = np.partition(s, -k, axis=1)[:, -k]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(cell.astype(np.int32)), pa.array(distance), pa.array(least)],
                ["vec_id", "v", "cell", "distance", "least"])

    assigned = stage(rows.mapInArrow(assign, "vec_id long, v array<long>, cell int, distance double, least long"))
    asks = F.col("vec_id") % every == 0
    # a row for each centre
    cells = assigned.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius"), F.count(F.when(asks, 1)).alias("nq"),
        F.max(F.when(asks, F.col("distance"))).alias("q_radius"), F.min(F.when(asks, F.col("least"))).alias("worst"),
    ).collect()
    data_at, _ = _blocks({c["cell"]: c["n"] for c in cells}, data_rows)
    query_at, _ = _blocks({c["cell"]: c["nq"] for c in cells if c["nq"]}, query_rows)
    pairs = [
        (a["cell"], b["cell"])
        for a in cells if a["nq"]
        for b in cells
        if _bound(Node(ids, centres[a["cell"]], a["q_radius"], []), Node(ids, centres[b["cell"]], b["radius"], [])) >= a["worst"]
    ]

    def spread(own: int, other: int, own_at: dict, other_at: dict, name: str) -> DataFrame:
        found = {(p[own], *own_at[p[own]], *other_at[p[other]]) for p in pairs}
        return F.broadcast(spark.createDataFrame(sorted(found), f"cell int, first long, parts long, {name}_first long, {name}_parts long"))

    def dealt(side: DataFrame, other: str, mine: str) -> DataFrame:
        return side.withColumns({
            mine: F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts")),
            other: F.explode(F.sequence(F.col(f"{other}_first"), F.col(f"{other}_first") + F.col(f"{other}_parts") - 1)),
        })

    if not pairs:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # at most CENTRES squared rows on either side, whatever the data
    queries = dealt(assigned.where(asks).join(spread(0, 1, query_at, data_at, "d"), "cell"), "d", "q").select("q", "d", "vec_id", "v", "least")
    data = dealt(assigned.join(spread(1, 0, data_at, query_at, "q"), "cell"), "q", "d").select(
        F.col("q").alias("to_q"), F.col("d").alias("in_d"), F.col("vec_id").alias("data_id"), F.col("v").alias("data_v"))

    def meet(one: pa.Table, two: pa.Table) -> pa.Table:
        own = one.column("vec_id").to_numpy()
        scores, best = search(
            _matrix(one.column("v"), width), own, one.column("least").to_numpy(),
            _matrix(two.column("data_v"), width), two.column("data_id").to_numpy(), k)
        there = scores > _NONE
        return pa.table({
            "query_id": pa.array(np.repeat(own, k)[there.ravel()]), "vec_id": pa.array(best[there]), "score": pa.array(scores[there])})

    met = queries.groupBy("q", "d").cogroup(data.groupBy("to_q", "in_d")).applyInArrow(meet, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
