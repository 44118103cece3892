"""Type-2 dimensions: every version of a row with the dates between which it held."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALIDITY = ("valid_from", "valid_to", "is_current", "version")


def _digest(columns: list[str], prefix: str = "") -> Column:
    """Hash of the attributes, NULL apart from text: what changed, in one comparison."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"{prefix}{c}").cast("string").alias(c) for c in columns]),
                            {"ignoreNullFields": "false"}), 256)


def first_versions(incoming: DataFrame, key: str, attributes: list[str], as_of: Column) -> DataFrame:
    return incoming.select(
        key, *attributes, as_of.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"), F.lit(1).alias("version"))


def next_versions(
    current: DataFrame, incoming: DataFrame, key: str, attributes: list[str], as_of: Column
) -> DataFrame:
    """The history after a delivery: a changed row closes its open version the day before
    ``as_of`` and opens the next; an unchanged or absent one stays; a new key starts.

    ``incoming`` holds each key once. One join on the key, whose changed rows give two
    rows each; closed versions pass by without being joined.
    """
    columns = [key, *attributes, *VALIDITY]
    closed = current.filter(~F.col("is_current")).select(*columns)
    o = current.filter("is_current").withColumn("_old", _digest(attributes)).alias("o")
    n = incoming.select(key, *attributes).withColumn("_new", _digest(attributes)).alias("n")
    both = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    known, came = F.col("o._old").isNotNull(), F.col("n._new").isNotNull()
    changed = known & came & (F.col("o._old") != F.col("n._new"))
    old = F.struct(
        F.col(f"o.{key}").alias(key), *[F.col(f"o.{c}").alias(c) for c in attributes],
        F.col("o.valid_from").alias("valid_from"),
        F.when(changed, F.date_sub(as_of, 1)).alias("valid_to"),
        (~changed).alias("is_current"), F.col("o.version").alias("version"))
    new = F.struct(
        F.col(f"n.{key}").alias(key), *[F.col(f"n.{c}").alias(c) for c in attributes],
        as_of.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
        (F.coalesce(F.col("o.version"), F.lit(0)) + 1).alias("version"))
    changed = F.coalesce(changed, F.lit(False))
    rows = F.when(changed, F.array(old, new)).when(known, F.array(old)).otherwise(F.array(new))
    return both.select(F.inline(rows)).select(*columns).unionByName(closed)
