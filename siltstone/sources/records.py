"""Records of text files whose ends cannot be told from one place: a CSV line break may stand
inside quotes, an object of a JSON array inside another or inside a string.

A file is cut at every separator, wherever that stands, and its byte ranges are scanned by many
tasks. What a piece does to the state (outside or inside quotes, and how deep in braces) is
known for either state it may begin in, so each range's running states are kept for both. The
ranges' effects are then put together file by file, which tells every range, and so every
piece, its true state. Pieces that are whole records pass as they are; the others are joined,
first inside their range and then across ranges.

The scan is written down once, so later jobs see the ranges of this one, however the cluster's
size changes meanwhile.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.sources.lake import writing

#: Either state a piece may begin in, and what it leads to.
_STATES = ("a", "z", "r", "t")  # state before and after, depth before and after

_SCANNED = (
    "file string, block long, n long, value string, closing int, "
    + ", ".join(f"{x}{s} {'boolean' if x in 'az' else 'long'}" for s in (0, 1) for x in _STATES))


def pieces(spark: SparkSession, files: list[str], separator: str) -> DataFrame:
    """file, block (where its byte range begins) and value of each piece, in a range's order."""
    return spark.read.option("lineSep", separator).text(files).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), "value")


def opens_quote(line: Column, sep: str = ",") -> Column:
    """Whether a CSV line that begins outside quotes ends inside them. Doubled quotes are no
    ends; a quote inside an unquoted field is a character like any other."""
    other = f"[^\\Q{sep}\\E]"
    pattern = f'^(?:(?:"[^"]*+"{other}*+|[^"\\Q{sep}\\E]{other}*+)?+\\Q{sep}\\E)*+"[^"]*+$'
    return F.contains(line, F.lit('"')) & F.replace(line, F.lit('""'), F.lit("")).rlike(pattern)


def csv_effects(value: Column, sep: str = ",") -> dict[str, Column]:
    """Of a line: the state it ends in from outside (e0) and inside (e1) quotes."""
    return {"e0": opens_quote(value, sep), "e1": opens_quote(F.concat(F.lit('"'), value), sep),
            "p0": F.lit(0), "p1": F.lit(0), "closing": F.lit(0)}


def _count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def json_effects(value: Column) -> dict[str, Column]:
    """Of text up to a closing brace, which itself counts where it is outside a string."""
    plain = F.regexp_replace(value, r"(?s)\\.", "")
    flips = _count(plain, '"') % 2 == 1
    outside = [F.regexp_replace(t, '"[^"]*+(?:"|$)', "") for t in (plain, F.concat(F.lit('"'), plain))]
    closing = F.when(value.rlike(r"^\s*\]\s*$"), 1).when(value.rlike(r"^﻿?\s*\[\s*\]\s*$"), 2).otherwise(0)
    return {"e0": flips, "e1": ~flips,
            "p0": _count(outside[0], "{") - F.when(flips, 0).otherwise(1),
            "p1": _count(outside[1], "{") - F.when(flips, 1).otherwise(0), "closing": closing}


def _states(e0: np.ndarray, e1: np.ndarray, start: bool) -> np.ndarray:
    """The state after each piece: what the last one that decides it by itself says, turned
    by those since that turn it."""
    turned = np.cumsum(e0 & ~e1) % 2 == 1
    fixed = np.where(e0 == e1, np.arange(len(e0)), -1)
    last = np.maximum.accumulate(fixed)
    return np.where(last >= 0, e0[last] ^ turned ^ turned[last], start ^ turned)


def _running(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States before and after each piece, for either state its range may begin in."""
    at, held = None, None
    for batch in batches:
        if not len(batch):
            continue
        names = batch["file"].dictionary_encode()
        place, block = names.indices.to_numpy(), batch["block"].to_numpy()
        e = [batch[c].to_numpy(zero_copy_only=False).astype(bool) for c in ("e0", "e1")]
        p = [batch[c].to_numpy().astype(np.int64) for c in ("p0", "p1")]
        cuts = np.flatnonzero((place[1:] != place[:-1]) | (block[1:] != block[:-1])) + 1
        found: dict[str, list[np.ndarray]] = {}
        for lo, hi in zip([0, *cuts], [*cuts, len(batch)], strict=True):
            key = (names.dictionary[int(place[lo])].as_py(), int(block[lo]))
            if key != at:
                at, held = key, [[False, 0], [True, 0], 0]
            found.setdefault("n", []).append(np.arange(held[2], held[2] + hi - lo))
            held[2] += hi - lo
            for s in (0, 1):
                state, depth = held[s]
                after = _states(e[0][lo:hi], e[1][lo:hi], state)
                before = np.concatenate([[state], after[:-1]])
                change = np.where(before, p[1][lo:hi], p[0][lo:hi])
                down = depth + np.cumsum(change)
                for name, x in zip(_STATES, (before, after, down - change, down), strict=True):
                    found.setdefault(f"{name}{s}", []).append(x)
                held[s] = [bool(after[-1]), int(down[-1])]
        columns = {k: pa.array(np.concatenate(v)) for k, v in found.items()}
        columns |= {c: batch[c] for c in ("file", "block", "value", "closing")}
        order = [c.split()[0] for c in _SCANNED.split(", ")]
        yield pa.RecordBatch.from_arrays([columns[c] for c in order], names=order)


def _starts(ranges: pd.DataFrame) -> pd.DataFrame:
    """What each byte range of a file truly begins in, and the file's end."""
    state, depth, before, out = False, 0, 0, []
    for r in ranges.sort_values("block").itertuples():
        out.append((r.file, r.block, state, depth, before, False, state, depth))
        state, depth = (r.z1, depth + r.t1) if state else (r.z0, depth + r.t0)
        before += r.pieces
    out[-1] = (*out[-1][:5], True, state, depth)
    return pd.DataFrame(out, columns=["file", "block", "state", "depth", "before", "last", "end_state", "end_depth"])


def _written(df: DataFrame, path: str) -> DataFrame:
    with writing(df.sparkSession):
        df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def assembled(
    spark: SparkSession, files: list[str], separator: str, effects: dict[str, Column], scratch: str,
    end_depth: int = 0, what: str = "file",
) -> DataFrame:
    """file, position (of the record's first piece, from 1), text of each record.

    ``effects`` are columns over a piece's ``value``. A file that ends inside quotes, or at a
    depth other than ``end_depth``, raises ValueError before anything is returned.
    """
    folder = f"{scratch.rstrip('/')}/{uuid.uuid4().hex}"
    cut = pieces(spark, files, separator).withColumns(effects)
    scanned = _written(cut.mapInArrow(_running, _SCANNED), f"{folder}/pieces")
    ranges = scanned.groupBy("file", "block").agg(
        F.max_by(F.struct("z0", "z1", "t0", "t1"), "n").alias("e"), F.count(F.lit(1)).alias("pieces"))
    starts = _written(ranges.select("file", "block", "pieces", "e.*").groupBy("file").applyInPandas(
        _starts, "file string, block long, state boolean, depth long, before long, last boolean, "
        "end_state boolean, end_depth long"), f"{folder}/starts")
    broken = starts.where(F.col("last") & (F.col("end_state") | (F.col("end_depth") != end_depth))).first()
    if broken:
        how = "inside quotes" if broken.end_state else "too early or with something left over"
        raise ValueError(f"{what}: {broken.file} ends {how}")

    def true(name: str) -> Column:
        return F.when(F.col("state"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    known = scanned.join(starts.select("file", "block", "state", "depth", "before"), ["file", "block"]).select(
        "file", "block", "n", "value", "closing", (F.col("before") + F.col("n") + 1).alias("position"),
        (~true("a") & (F.col("depth") + true("r") == 0)).alias("begins"),
        (~true("z") & (F.col("depth") + true("t") == 0)).alias("ends"),
        (F.col("depth") + true("t")).alias("down"))
    rest = F.col("begins") & (F.col("down") < 0)
    if end_depth:
        wrong = known.where(rest & (F.col("closing") != F.when(F.col("position") == 1, 2).otherwise(1))).first()
        if wrong:
            raise ValueError(f"{what}: {wrong.file} holds something else at its end or between its records")
    whole = known.where("begins AND ends").select("file", "position", "value")
    parts = known.where(~(F.col("begins") & F.col("ends")) & ~rest)

    # Inside a range the pieces of a record share the number of records ended before.
    order = Window.partitionBy("file", "block").orderBy("n")
    numbered = parts.withColumn("k", F.coalesce(
        F.sum(F.col("ends").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    text = F.concat_ws(separator, F.transform(F.sort_array(F.collect_list(F.struct("n", "value"))), lambda e: e["value"]))
    joined = numbered.groupBy("file", "block", "k").agg(
        F.min("position").alias("position"), text.alias("value"),
        F.min_by("begins", "n").alias("begins"), F.max_by("ends", "n").alias("ends"))
    inside = joined.where("begins AND ends").select("file", "position", "value")
    # At most two parts of a range belong to records that reach beyond it.
    across = joined.where("NOT (begins AND ends)").withColumn("record", F.sum(F.col("begins").cast("long")).over(
        Window.partitionBy("file").orderBy("position")))
    text = F.concat_ws(separator, F.transform(
        F.sort_array(F.collect_list(F.struct("position", "value"))), lambda e: e["value"]))
    across = across.groupBy("file", "record").agg(F.min("position").alias("position"), text.alias("value"))
    return whole.unionByName(inside).unionByName(across.drop("record")).withColumnRenamed("value", "text")
