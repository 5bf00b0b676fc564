"""Centroid clustering by Lloyd's rounds with the dimensions dealt into shards, exact in integers.

Vectors are stored once as shards: a chunk of rows by a block of columns, in the smallest integer type that holds it. A round has
two halves. Tasks over shards know the slice of the centroids for their own columns only and give partial distances, a
number for each row and centroid; these are added over the blocks of a chunk, and the least sum names the row's centroid.
The assignment then goes back to the shards, which sum their own columns for each centroid, so each block renews its own slice
of the centroids. No task ever holds a whole centroid matrix beside a whole vector, and the driver holds neither rows nor sums.

What is broadcast is the centroid matrix, whose size is fixed by two parameters; all else is keyed by chunk, which is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.arrow import bounded_batches
from riskloom.session import stage

#: Columns of a shard.
BLOCK = 32
#: Components of larger magnitude could give squared distances beyond a long.
LARGEST = 1 << 27

_SHARD_DDL = "chunk long, block int, rows int, width int, cells binary, ids array<long>"
_SHARD = pa.schema([("chunk", pa.int64()), ("block", pa.int32()), ("rows", pa.int32()), ("width", pa.int32()), ("cells", pa.binary()),
                    ("ids", pa.list_(pa.int64()))])
_PART = pa.schema([("chunk", pa.int64()), ("rows", pa.int32()), ("width", pa.int32()), ("cells", pa.binary())])
_PART_DDL = "chunk long, rows int, width int, cells binary"
_LABEL = pa.schema([("chunk", pa.int64()), ("labels", pa.binary()), ("distances", pa.binary())])
_LABEL_DDL = "chunk long, labels binary, distances binary"


def _packed(values: np.ndarray) -> tuple[int, bytes]:
    """Bytes a number, and the numbers in the smallest signed type that holds all of them."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return np.dtype(kind).itemsize, np.ascontiguousarray(values, kind).tobytes()


def _unpacked(width: int, cells: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(cells, f"<i{width}").reshape(rows, -1).astype(np.int64)


def scaled(vector: Column, scale: int) -> Column:
    """Each component as a whole number of 1/scale, rounded down."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vector: Column, dims: int) -> Column:
    """Whether a vector has so many components, all of them finite."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) == dims) & fine, F.lit(False))


def shards(vectors: DataFrame, dims: int, block: int = BLOCK) -> DataFrame:
    """Stored shards of ``vectors (vec_id, cells array<long>)``; the ids of a chunk are with its block 0."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for i, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            whole = batch.column("cells").flatten().to_numpy().reshape(batch.num_rows, dims)
            if max(-int(whole.min()), int(whole.max())) > LARGEST:
                raise ValueError(f"a scaled component beyond {LARGEST} has no exact squared distance")
            ids = batch.column("vec_id").to_pylist()
            rows = []
            for b, at in enumerate(range(0, dims, block)):
                width, cells = _packed(whole[:, at : at + block])
                rows.append({"chunk": (part << 32) + i, "block": b, "rows": len(ids), "width": width, "cells": cells, "ids": None if b else ids})
            yield pa.RecordBatch.from_pylist(rows, schema=_SHARD)

    cut_up = bounded_batches(vectors).select("vec_id", "cells").mapInArrow(cut, _SHARD_DDL)
    # shards of one block lie together, so a task meets few slices
    return stage(cut_up.repartitionByRange("block", "chunk"))


def _partial(cells: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows and centroids over these columns."""
    most = max(int(np.abs(cells).max(initial=0)), int(np.abs(centres).max(initial=0)))
    kind = np.float64 if 4 * most * most * cells.shape[1] < 1 << 52 else np.int64
    a, b = cells.astype(kind), centres.astype(kind)
    return ((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)).astype(np.int64)


def assign(pieces: DataFrame, slices: DataFrame) -> DataFrame:
    """``chunk, labels, distances``: for the rows of each chunk the nearest centroid (the smaller number of equal ones)."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part = _partial(_unpacked(row["width"], row["cells"], row["rows"]), np.array(row["centres"], np.int64))
                width, cells = _packed(part)
                yield pa.RecordBatch.from_pylist([{"chunk": row["chunk"], "rows": row["rows"], "width": width, "cells": cells}], schema=_PART)

    def add(parts: pa.Table) -> pa.Table:
        rows = parts.to_pylist()
        total = sum(_unpacked(r["width"], r["cells"], r["rows"]) for r in rows)
        nearest = total.argmin(axis=1)
        return pa.Table.from_pylist([{
            "chunk": rows[0]["chunk"], "labels": nearest.astype("<i4").tobytes(),
            "distances": total[np.arange(len(total)), nearest].astype("<i8").tobytes()}], schema=_LABEL)

    # the slices hold one number for each centroid and dimension, whatever the data
    matrix = slices.groupBy("block").agg(F.transform(F.array_sort(F.collect_list(F.struct("cluster", "cells"))), lambda s: s["cells"]).alias("centres"))
    measured = pieces.drop("ids").join(F.broadcast(matrix), "block").mapInArrow(measure, _PART_DDL)
    return measured.groupBy("chunk").applyInArrow(add, _LABEL_DDL)


def renew(pieces: DataFrame, labels: DataFrame, slices: DataFrame, block: int = BLOCK) -> DataFrame:
    """The slices with each centroid's own columns replaced by the mean of its rows, rounded down; without rows it stays."""
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                cells = _unpacked(row["width"], row["cells"], row["rows"])
                own = np.frombuffer(row["labels"], "<i4")
                order = np.argsort(own, kind="stable")
                present, starts = np.unique(own[order], return_index=True)
                parts = np.add.reduceat(cells[order], starts, axis=0)
                counts = np.diff(np.append(starts, len(own)))
                for cluster, part, n in zip(present.tolist(), parts, counts.tolist()):
                    held = sums.setdefault((row["block"], cluster), [0, np.zeros(cells.shape[1], np.int64)])
                    held[0] += n
                    held[1] += part
        rows = [{"block": b, "cluster": c, "n": n, "sums": s.tolist()} for (b, c), (n, s) in sums.items()]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                ("block", pa.int32()), ("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]))

    per_task = pieces.drop("ids").join(labels.select("chunk", "labels"), "chunk").mapInArrow(total, "block int, cluster int, n long, sums array<long>")
    added = per_task.groupBy("block", "cluster").agg(
        F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(block)])
    # (s - s mod n) / n in whole numbers is the quotient rounded down
    means = [F.expr(f"(s{i} - pmod(s{i}, n)) div n") for i in range(block)]
    fresh = added.select("block", "cluster", F.filter(F.array(*means), lambda x: x.isNotNull()).alias("fresh"))
    return stage(slices.join(fresh, ["block", "cluster"], "left").select("block", "cluster", F.coalesce("fresh", "cells").alias("cells")))


def lloyd(
    vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2", block: int = BLOCK,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for every usable vector.

    Vectors of another length than ``dims``, and those with a NULL or non-finite component, take no part. The first centroids are
    the ``k`` vectors (all, if fewer) of smallest SHA-256 of ``seed:id``, NULL ids last, ties by components. Repeated ids and equal
    vectors are rows of their own; of equally near centroids the smaller number wins; a centroid without rows stays where it is.
    Other columns are ignored whatever their names; an empty table gives an empty result. Scaled components beyond ``LARGEST`` stop the job.
    """
    vector = F.col(f"`{vector_col}`")
    kept = vectors.where(usable(vector, dims)).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), scaled(vector, scale).alias("cells"))
    pieces = shards(kept, dims, block)
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    # k rows, whatever the data
    first = kept.withColumn("name", name).orderBy(F.col("name").asc_nulls_last(), "cells").limit(k).select("cells").collect()
    spark = vectors.sparkSession
    slices = spark.createDataFrame(
        [(b, c, list(row["cells"][at : at + block])) for c, row in enumerate(first) for b, at in enumerate(range(0, dims, block))],
        "block int, cluster int, cells array<long>")
    for _ in range(rounds):
        slices = renew(pieces, stage(assign(pieces, slices)), slices, block)
    labels = assign(pieces, slices)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(np.frombuffer(row["labels"], "<i4")), pa.array(np.frombuffer(row["distances"], "<i8"))],
                    ["vec_id", "cluster", "distance"])

    rows = stage(pieces.where("block = 0").select("chunk", "ids").join(labels, "chunk").mapInArrow(spread, "vec_id long, cluster int, distance long"))
    centres = slices.groupBy("cluster").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("block", "cells"))), lambda s: s["cells"])).alias("cells"))
    sums = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = rows.agg(F.sum("distance")).first()[0]
    # one row a centroid
    told = centres.join(sums, "cluster").select(
        "cluster", "cluster_inertia", F.lit(whole).cast("long").alias("inertia"),
        F.sha2(F.array_join(F.col("cells").cast("array<string>"), ",").cast("binary"), 256).alias("centroid_sha256"))
    return rows.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
