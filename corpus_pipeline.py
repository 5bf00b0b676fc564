"""The corpus pipeline: documents in, encoded training mixture out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm import bpe_codec, line_dedup, mixing, simhash, toxicity
from riskloom.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _toxicity(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier calls toxic go. It learns from the labelled documents of this stage's input."""
    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return toxicity.without_toxic(docs, model, threshold=0.7)


def _line_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Later repeats of runs of lines are cut out of the texts; no document is dropped."""
    cut = line_dedup.dedup_lines(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def _near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.keep_one(docs, shingle=4, distance=4)


def _mixing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mixture uses them."""
    return mixing.mix(docs)


def _encoding(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids and decoded bytes of every document, as digests."""
    return bpe_codec.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _toxicity),
    ("line_dedup", _line_dedup),
    ("simhash_near_dedup", _near_duplicates),
    ("mixing", _mixing),
    ("bpe_encoding", _encoding),
]

#: A trained classifier and hashes that SQL does not know: the tests compare with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs)
    return docs
