"""Surrogate keys without a global sort or a counting pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# monotonically_increasing_id() keeps the row number in the low 33 bits and the
# partition number above them.
BLOCK_BITS = 33


def next_base(current_max: int | None) -> int:
    """First id of a block no earlier write has touched.

    Every write partition takes one block of 2**33 ids, and a BIGINT holds 2**30
    blocks: over 100 PB of 128 MB splits before the sequence runs out.
    """
    base = 1 if current_max is None else ((current_max >> BLOCK_BITS) + 1) << BLOCK_BITS
    if base >= 1 << 62:
        raise OverflowError("the id sequence is nearly used up")
    return base


def sequence_column(base: int) -> Column:
    return F.lit(base).cast("bigint") + F.monotonically_increasing_id()


def with_sequence(df: DataFrame, column: str, base: int) -> DataFrame:
    """Unique ascending ids from ``base``, gaps allowed.

    Ids depend on partition layout, so write the result before using it: only
    the committed attempt of a task counts, and readers then share one answer.
    """
    return df.withColumn(column, sequence_column(base))
