"""Scoring of records as they arrive: the batch job run once per micro-batch.

Every step is row-wise or a join with the static history table, so the query
keeps no state and a restarted one continues from its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from riskloom.plans.scoring import score_records
from riskloom.plans.training import Scorer
from riskloom.sources import contracts as c


def record_stream(spark: SparkSession, folder: str) -> DataFrame:
    """JSON records dropped into a folder, all fields read as text."""
    fields = StructType([StructField(name, StringType()) for name in c.APPLICATION_TYPES])
    return spark.readStream.schema(fields).json(folder)


def score_stream(records: DataFrame, scorer: Scorer, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Write scores and rejects of each micro-batch under its number.

    A batch that is replayed after a failure overwrites its own folder, so every
    record is published once.
    """

    def publish(batch: DataFrame, number: int) -> None:
        result = score_records(batch, scorer)
        result.scores.write.mode("overwrite").parquet(f"{out}/scores/batch={number}")
        result.rejects.write.mode("overwrite").parquet(f"{out}/rejects/batch={number}")

    writer = records.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
