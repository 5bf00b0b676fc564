"""Writing tables, scores and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Rows of a JSON document, at most.
DOCUMENT_ROWS = 100_000


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_scores(scored: DataFrame, path: str, key: str, probability: str = "probability") -> None:
    """Score file: the key and the probability, published as ``TARGET``."""
    write_csv(scored.select(key, F.col(probability).alias("TARGET")), path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """A table as a folder of JSON lines, one object a row."""
    df.write.mode("overwrite").json(path)


def write_json(df: DataFrame, path: str) -> None:
    """Metric tables and run records: a handful of rows, written as one JSON document.

    One row is an object, any other number of rows an array of them, in the frame's order. NULL fields are written as null.
    The rows pass the driver, so more than ``DOCUMENT_ROWS`` of them are refused.
    """
    rows = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("value")).take(DOCUMENT_ROWS + 1)
    if len(rows) > DOCUMENT_ROWS:
        raise ValueError(f"more than {DOCUMENT_ROWS} rows are a table, not a document")
    text = rows[0]["value"] if len(rows) == 1 else "[" + ",".join(r["value"] for r in rows) + "]"
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
