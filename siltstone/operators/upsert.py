"""Keyed upsert as a full outer join that yields the next snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators.keys import next_base, sequence_column


def upsert(
    current: DataFrame | None,
    incoming: DataFrame,
    key: str,
    surrogate: str,
    update: list[str],
    current_max: int | None = None,
) -> DataFrame:
    """Insert new keys; on a known key overwrite only the ``update`` columns.

    Listing every attribute gives a Type-1 dimension, listing a few a partial
    update. Surrogate keys never change. ``incoming`` must be unique on ``key``.
    Without a ``current`` table there is nothing to join; with one, the highest key it
    holds must be given, or new keys would meet old ones.
    """
    if current is not None and current_max is None:
        raise ValueError("an upsert into a table needs the highest surrogate key it holds")
    fresh = sequence_column(next_base(current_max))
    attributes = [c for c in incoming.columns if c != key]
    if current is None:
        return incoming.select(fresh.alias(surrogate), key, *attributes)
    o, n = current.alias("o"), incoming.withColumn("_new", F.lit(True)).alias("n")
    joined = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    is_new, is_old = F.col("n._new").isNotNull(), F.col(f"o.{surrogate}").isNotNull()

    def pick(c: str):
        old, new = F.col(f"o.{c}"), F.col(f"n.{c}")
        if c in update:
            return F.when(is_new, new).otherwise(old).alias(c)
        return F.when(is_old, old).otherwise(new).alias(c)

    return joined.select(
        F.coalesce(F.col(f"o.{surrogate}"), fresh).alias(surrogate),
        F.coalesce(F.col(f"o.{key}"), F.col(f"n.{key}")).alias(key),
        *[pick(c) for c in attributes],
    )
