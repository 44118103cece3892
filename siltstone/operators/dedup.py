"""First write wins on a natural key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.operators.membership import without


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The first row of each key in ``order_by``.

    ``row_number() = 1`` lets Spark limit each group in every map task before the
    shuffle, so a key holding a third of all rows sends one row per task.
    """
    w = W.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def insert_if_absent(
    incoming: DataFrame, target: DataFrame, keys: list[str], order_by: list[str]
) -> DataFrame:
    """Rows to add so that each key keeps its first writer; one shuffle on the key
    serves both the dedup and the anti join. The optimizer chooses how to join."""
    return without(first_per_key(incoming, keys, order_by), target, keys)


def absent_values(values: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct new key values."""
    return without(values.select(*keys).distinct(), target, keys)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("occurrence_count"))
        .filter(F.col("occurrence_count") > 1)
    )
