"""Reading tables: explicit schemas, one notion of missing."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskloom.functions.scalars import normalise_missing

_SPARK_TYPES = {"int64": T.LongType(), "float64": T.DoubleType(), "object": T.StringType()}


def schema_of(columns: dict[str, str]) -> T.StructType:
    """All-nullable schema from a ``name -> int64|float64|object`` mapping."""
    return T.StructType([T.StructField(c, _SPARK_TYPES.get(t, T.StringType()), True) for c, t in columns.items()])


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    encoding: str = "UTF-8",
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV with a header row.

    A schema fixes the columns and their order; ``types`` (``name -> int64|float64|object``)
    fixes the types of whatever columns the header names, the others being text. Either
    avoids the extra pass that inference costs, and types that change with the delivery.
    """
    reader = spark.read.option("header", True).option("encoding", encoding)
    if types is not None:
        raw = reader.csv(path)
        typed = {c: _SPARK_TYPES.get(types.get(c, "object"), T.StringType()) for c in raw.columns}
        return normalise_missing(raw.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in typed.items()]))
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return normalise_missing(reader.csv(path))


def read_names(spark: SparkSession, path: str) -> list[str]:
    """A contract kept as a file: one JSON list of column names, such as the features after the history join."""
    names = json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))
    if not isinstance(names, list) or not all(isinstance(n, str) for n in names):
        raise ValueError(f"{path} is not a list of names")
    return names


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_parquet(
    spark: SparkSession, path: str, build_hint: str = "build it first", normalise: bool = False
) -> DataFrame:
    """Parquet table; a missing one names the step that makes it.

    Tables this library wrote hold one notion of missing already, and reading them
    as they are lets filters reach the scan; ``normalise`` is for tables from elsewhere.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no table at {path}: {build_hint}")
    found = spark.read.parquet(path)
    return normalise_missing(found) if normalise else found


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order; absent ones are added as NULL."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])


def column_descriptions(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Rows ``column, description`` of one table from the Latin-1 data dictionary."""
    raw = spark.read.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return raw.where(F.col("Table") == table).select(
        F.trim("Row").alias("column"), F.col("Description").alias("description")
    )
