"""A fixed-size filter that tells which rows cannot be in a set of ids, so that only the others are shuffled for a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.session import stage

#: Bits of the filter. A set much larger than this fills it; then all rows are shuffled, and the result is the same.
BITS = 1 << 23
_WORD = 32


def _bit(number: Column) -> Column:
    return F.pmod(F.xxhash64(number), F.lit(BITS)).cast("int")


def with_candidates(df: DataFrame, members: DataFrame, number: str, asked: Column, name: str) -> DataFrame:
    """``df`` with a column that says whether ``asked`` may be one of the numbers in a column of ``members``.

    False is certain; NULL counts as a number. The filter is a table of at most ``BITS / 32`` words with their bits, some
    10 MB, which is why it can always be broadcast.
    """
    at = _bit(F.col(number))
    words = stage(
        members.select((at / _WORD).cast("int").alias("_word"), F.pow(F.lit(2.0), at % _WORD).cast("long").alias("_bits"))
        .groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    )
    where = _bit(asked)
    found = df.withColumns({"_word": (where / _WORD).cast("int"), "_mask": F.pow(F.lit(2.0), where % _WORD).cast("long")})
    return (
        found.join(F.broadcast(words), "_word", "left")
        .withColumn(name, F.coalesce(F.col("_bits").bitwiseAND(F.col("_mask")) != 0, F.lit(False)))
        .drop("_word", "_bits", "_mask")
    )
