"""Tables stored by the hash of their key, so that a few keys are found without reading the rest."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskloom.functions.scalars import normalise_missing
from riskloom.sources.sinks import write_json
from riskloom.sources.tables import path_exists

#: Partition column of the stored folders.
FOLDER = "key_folder"


def folder_of(key: Column, folders: int) -> Column:
    """The folder of a key of the stored type; a NULL key has one too."""
    return F.pmod(F.xxhash64(key), F.lit(folders)).cast("int")


@dataclass(frozen=True)
class KeyedTable:
    """A stored table whose rows lie in ``folders`` folders by the hash of ``key``."""

    path: str
    key: str
    folders: int
    schema: T.StructType

    def _rows(self, spark: SparkSession) -> DataFrame:
        # the schema is known, so no file is opened to find it
        return spark.read.schema(T.StructType([*self.schema, T.StructField(FOLDER, T.IntegerType())])).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._rows(spark).drop(FOLDER)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of all folders that hold a key of ``keys``, a table with the key column.

        The driver receives the numbers of these folders, at most ``folders`` integers whatever the tables hold. The
        scan is cut down to them; a table of keys that fill all folders reads everything. Keys are cast to the stored
        type first. NULL keys find nothing, as in a join, and an empty table of keys reads no folder.
        """
        key = F.col(f"`{self.key}`").cast(self.schema[self.key].dataType)
        wanted = keys.where(key.isNotNull()).select(folder_of(key, self.folders).alias(FOLDER)).distinct()
        hit = sorted(r[0] for r in wanted.collect())
        rows = self._rows(keys.sparkSession)
        return (rows if len(hit) == self.folders else rows.where(F.col(FOLDER).isin(hit))).drop(FOLDER)


def write_keyed(df: DataFrame, path: str, key: str, folders: int = 1024) -> KeyedTable:
    """Store ``df`` by the hash of ``key``; missing values of any form become NULL.

    A folder that holds much is written by several tasks, small ones share a task, and the rows of a file are sorted by the
    key. Every build has a folder of its own and the record that names it is written last: a build that fails leaves
    the former one in force, and jobs that read that one go on. Superseded builds are left for the owner to delete.
    """
    if folders < 1:
        raise ValueError("a keyed table needs at least one folder")
    if FOLDER in df.columns:
        raise ValueError(f"the column name {FOLDER!r} is taken by the store")
    plain = normalise_missing(df)
    rows = f"{path.rstrip('/')}/build={uuid.uuid4().hex}"
    (
        plain.withColumn(FOLDER, folder_of(F.col(f"`{key}`"), folders))
        .hint("rebalance", FOLDER)
        .sortWithinPartitions(FOLDER, f"`{key}`")
        .write.partitionBy(FOLDER)
        .parquet(rows)
    )
    spark = df.sparkSession
    record = [(rows, key, folders, plain.schema.json())]
    write_json(spark.createDataFrame(record, "path string, key string, folders int, columns string"), _record(path))
    return open_keyed(spark, path)


def open_keyed(spark: SparkSession, path: str) -> KeyedTable:
    """The latest complete build at ``path``."""
    if not path_exists(spark, _record(path)):
        raise FileNotFoundError(f"no keyed table at {path}: write it first")
    record = json.loads(spark.read.text(_record(path), wholetext=True).first()["value"])
    schema = T.StructType.fromJson(json.loads(record["columns"]))
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    return KeyedTable(record["path"], record["key"], record["folders"], nullable)


def _record(path: str) -> str:
    return f"{path.rstrip('/')}/current.json"
