"""Settings and small helpers for jobs that read whole texts in Arrow batches."""

from __future__ import annotations

import ctypes
import functools
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: A batch holds at most so many rows and, where the engine supports it, about so many bytes.
BATCH_ROWS = "2000"
BATCH_BYTES = "16m"


def bounded_batches(df: DataFrame) -> DataFrame:
    """Bound what one Arrow batch holds, so that long texts do not pile up in a worker.

    Only settings that the session leaves at their defaults are changed.
    """
    conf = df.sparkSession.conf
    for key, value in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        if conf.get(name, None) is None:
            conf.set(name, value)
    return df


def text_columns(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Only the id and the text (NULL as empty), under fixed names, whatever else the table holds."""
    return bounded_batches(df).select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def give_back() -> None:
    """Return freed memory to the system. A worker lives on after its tasks, and would keep what the largest one took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim is not None:  # the C library may have no such call
        trim(0)


def giving_back(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The task, over Arrow batches, with what it took returned to the system at its end."""

    @functools.wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def batches_of(columns: dict[str, pa.DataType], rows: Iterator[tuple], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Tuples in the order of ``columns``, as record batches."""
    schema = pa.schema(list(columns.items()))
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(schema, held)
            held = []
    if held:
        yield _batch(schema, held)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, type=field.type) for column, field in zip(zip(*rows), schema)], schema=schema
    )
