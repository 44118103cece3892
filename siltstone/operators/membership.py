"""Set membership and anti joins that survive large and skewed key sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def orphan_keys(keys: DataFrame, parents: DataFrame, parent_key: str) -> DataFrame:
    """Distinct keys (one column) without a parent. Only this one column is shuffled,
    and each task sends a key once, however many rows carry it."""
    name = keys.columns[0]
    distinct = keys.filter(F.col(name).isNotNull()).distinct()
    return distinct.join(parents.select(F.col(parent_key).alias(name)), name, "left_anti")


def orphan_keys_of(
    df: DataFrame, keys: dict[str, Column], parents: dict[str, tuple[DataFrame, str]]
) -> DataFrame:
    """``orphan_keys`` of several references at once: reference, key. One pass over the rows
    and one shuffle of their distinct keys, however many references there are."""
    pairs = F.array(*[F.struct(F.lit(n).alias("reference"), k.alias("key")) for n, k in keys.items()])
    distinct = df.select(F.inline(pairs)).filter(F.col("key").isNotNull()).distinct()
    known = reduce(DataFrame.unionByName, [
        parent.select(F.lit(n).alias("reference"), F.col(pk).alias("key")) for n, (parent, pk) in parents.items()])
    return distinct.join(known, ["reference", "key"], "left_anti")


def flag_listed(df: DataFrame, key: str, listed: DataFrame, flag: str) -> DataFrame:
    """Set ``flag`` on rows whose ``key`` is in a written one-column key list. The
    optimizer knows the list's size: it broadcasts it, or else sorts and merges,
    where adaptive execution splits a hot key on the row side."""
    keys = listed.select(F.col(listed.columns[0]).alias("_listed"))
    joined = df.join(keys, F.col(key) == F.col("_listed"), "left")
    return joined.withColumn(flag, F.col("_listed").isNotNull()).drop("_listed")


def without(df: DataFrame, seen: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``seen`` (plain anti join, not NOT IN,
    which would force the key set to be broadcast)."""
    return df.join(seen.select(*on), on, "left_anti")


def orphan_rows(child: DataFrame, fk: list[str], parent: DataFrame, pk: list[str]) -> DataFrame:
    """Child keys without a parent, with how many rows carry each.

    Rows are counted per key before the join, so a hot key crosses the network
    once per task rather than once per row.
    """
    have = F.lit(True)
    for k in fk:
        have = have & F.col(k).isNotNull()
    counted = child.filter(have).groupBy(*fk).agg(F.count(F.lit(1)).alias("row_count"))
    renamed = parent.select(*[F.col(p).alias(f) for p, f in zip(pk, fk)])
    return counted.join(renamed, fk, "left_anti")
