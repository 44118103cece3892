"""Whitening of embeddings by a covariance over distinct vectors.

Vectors become whole numbers, floor(64 c) + 1,000,000, so that equal ones are found exactly and
sums are exact. Identical vectors are one row of a written table with their count; that table is
the fit list, weighted by the counts or by one. Tasks sum it, then multiply their centred
batches; the d x d sums are merged in Spark and decomposed. Each distinct vector is whitened
once, and the rows get its result back by a 128-bit key.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import written

STEP, SHIFT = 64, 1_000_000
#: Entries beyond this are held at it, so that whole numbers and their sums stay exact.
MOST = float(2**46)
#: Eigenvalues below this part of the largest are rounding, not a direction of the data.
NOISE = 1e-12
LONG = np.iinfo(np.int64).max


def whole(embedding: Column) -> Column:
    """The vector in whole numbers; NULL if it is, or holds, NULL or no finite number."""
    good = F.forall(embedding, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(embedding, lambda c: (
        F.floor(F.greatest(F.lit(-MOST), F.least(F.lit(MOST), c.cast("double") * STEP))).cast("long") + SHIFT))
    return F.when(good, x)


@dataclass(frozen=True)
class Fit:
    """Of one number of dimensions: vectors, total weight, sums, components by columns."""

    n: int
    weight: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        # Whole and fractional part apart: the quotient of large sums would lose digits.
        return np.array([s // self.weight + (s % self.weight) / self.weight for s in self.sums])


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row places and matrix of each number of dimensions in a batch."""
    sizes = np.diff(batch["x"].offsets.to_numpy())
    flat = batch["x"].flatten().to_numpy()
    start = np.cumsum(sizes) - sizes
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        yield int(d), at, flat[start[at][:, None] + np.arange(d)]


def _sum_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n, weight and the exact sums of a task's vectors, in two halves of 32 bits."""
    total: dict[int, list] = {}
    for batch in batches:
        w = batch["w"].to_numpy()
        for d, at, x in _matrices(batch):
            held = total.setdefault(d, [0, 0, np.zeros(d, object)])
            held[0] += len(at)
            held[1] += int(w[at].sum())
            held[2] = held[2] + _exact(x, w[at])
    if total:
        yield pa.RecordBatch.from_pydict({
            "d": list(total), "n": [t[0] for t in total.values()], "weight": [t[1] for t in total.values()],
            "sums": [[str(s) for s in t[2]] for t in total.values()]}, schema=_SUMS)


_SUMS = pa.schema([("d", pa.int32()), ("n", pa.int64()), ("weight", pa.int64()), ("sums", pa.list_(pa.string()))])


def _exact(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weighted sums by dimension as Python integers."""
    most = int(np.abs(x).max(initial=0)) * int(w.max(initial=0)) * len(x)
    if most <= LONG:
        return (w @ x).astype(object)
    return w.astype(object) @ x.astype(object)


def _products(batches: Iterable[pa.RecordBatch], means: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows of the weighted products of a task's centred vectors."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        w = batch["w"].to_numpy()
        for d, at, x in _matrices(batch):
            if d in means:
                c = x - means[d]
                total[d] = total.get(d, 0) + (c * w[at][:, None]).T @ c
    for d, m in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array(m.tolist())], names=["d", "i", "row"])


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"d": rows["d"][:1], "i": rows["i"][:1], "row": [np.sum(np.stack(rows["row"]), axis=0)]})


def fit(distinct: DataFrame) -> dict[int, Fit]:
    """Means and principal axes by number of dimensions, from rows of x and weight w.

    What comes to the driver grows with the dimensions only: sums of tasks are added up in Spark.
    """
    sums: dict[int, tuple[int, int, list[int]]] = {}
    parts = distinct.mapInArrow(_sum_rows, "d int, n long, weight long, sums array<string>")
    merged = parts.select("d", "n", "weight", F.posexplode("sums").alias("i", "s")).groupBy("d", "i").agg(
        F.sum("n").alias("n"), F.sum("weight").alias("weight"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    for r in merged.orderBy("d", "i").collect():
        sums.setdefault(r.d, (r.n, r.weight, []))[2].append(int(r.s))
    means = {d: Fit(n, w, s, None, None, 0.0).mean for d, (n, w, s) in sums.items()}
    products = (
        distinct.mapInArrow(lambda batches: _products(batches, means), "d int, i int, row array<double>")
        .groupBy("d", "i").applyInPandas(_added, "d int, i int, row array<double>")
    )
    covariance: dict[int, np.ndarray] = {d: np.zeros((d, d)) for d in sums}
    for r in products.collect():
        covariance[r.d][r.i] = np.array(r.row) / sums[r.d][1]
    out = {}
    for d, (n, weight, s) in sums.items():
        v = (covariance[d] + covariance[d].T) / 2
        values, axes = np.linalg.eigh(v)
        values, axes = values[::-1], axes[:, ::-1]
        real = values > max(values[0], 0.0) * NOISE
        values, axes = values[real], axes[:, real]
        largest = np.abs(axes).argmax(axis=0)
        axes = axes * np.sign(axes[largest, np.arange(axes.shape[1])])
        out[d] = Fit(n, weight, s, axes, values, float(np.trace(v)))
    return out


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """sum((n x - sums)^2) of each row, exactly; None where it is no long."""
    most = max([n * max(abs(int(x.max())), abs(int(x.min()))), *map(abs, sums)]) * 2 if x.size else 0
    if most <= LONG:
        c = n * x - np.array(sums, np.int64)
        if int(np.abs(c).max(initial=0)) ** 2 * max(1, x.shape[1]) <= LONG:
            return (c * c).sum(axis=1).tolist()
        exact = c.astype(object)
    else:
        exact = n * x.astype(object) - np.array(sums, object)
    return [v if v <= LONG else None for v in map(int, (exact * exact).sum(axis=1))]


_WHITE = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("d", pa.int32()), ("w", pa.int64()),
                    ("deviation", pa.int64()), ("white", pa.list_(pa.float64()))])


def _white_rows(batches: Iterable[pa.RecordBatch], fits: dict[int, Fit], k: int) -> Iterator[pa.RecordBatch]:
    scaled = {d: f.axes[:, :k] / np.sqrt(f.values[:k]) for d, f in fits.items()}
    for batch in batches:
        for d, at, x in _matrices(batch):
            f = fits[d]
            white = (x - f.mean) @ scaled[d]
            part = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [part["k1"], part["k2"], pa.array([d] * len(at), pa.int32()), part["w"],
                 pa.array(deviations(x, f.weight, f.sums), pa.int64()), pa.array(white.tolist(), pa.list_(pa.float64()))],
                schema=_WHITE)


def _moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted sums and products of a task's whitened vectors, by dimensions."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        dims, w = batch["d"].to_numpy(), batch["w"].to_numpy()
        sizes = np.diff(batch["white"].offsets.to_numpy())
        flat = batch["white"].flatten().to_numpy()
        start = np.cumsum(sizes) - sizes
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            x = flat[start[at][:, None] + np.arange(sizes[at[0]])]
            x = np.hstack([np.ones((len(x), 1)), x])
            total[d] = total.get(d, 0) + (x * w[at][:, None]).T @ x
    for d, m in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([d] * len(m), pa.int32()), pa.array(range(len(m)), pa.int32()), pa.array(m.tolist())],
            names=["d", "i", "row"])


def identity_errors(white: DataFrame) -> dict[int, float]:
    """Largest difference between the whitened vectors' covariance and the identity."""
    rows: dict[int, dict[int, list[float]]] = {}
    found = white.mapInArrow(_moments, "d int, i int, row array<double>").groupBy("d", "i").applyInPandas(
        _added, "d int, i int, row array<double>")
    for r in found.collect():
        rows.setdefault(r.d, {})[r.i] = r.row
    out = {}
    for d, by in rows.items():
        m = np.array([by[i] for i in range(len(by))])
        m = m / m[0, 0]
        c = m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:])
        out[d] = float(np.abs(c - np.eye(len(c))).max(initial=0.0))
    return out


def whiten(embeddings: DataFrame, k: int = 16, weights: str = "one") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: up to ``k`` rows
    for each vector.

    ``weights`` gives each distinct vector the weight one or its ``count``; n is the number of
    distinct vectors by the first and of all by the second. Components go by falling
    eigenvalue, the largest entry of each positive. Directions without variance have no
    component, so one vector alone, equal vectors and empty vectors give no rows. Vectors that
    are NULL or hold NULL or a non-finite entry are left out; zero vectors take part. Vectors
    of another number of dimensions are whitened among themselves. Repeated rows each have
    their result; entries beyond 2^40 are held at it; a deviation beyond a long is NULL; a NULL
    vec_id stays; other columns are ignored; an empty table gives no rows.
    """
    if weights not in ("one", "count"):
        raise ValueError(f"weights must be 'one' or 'count', not '{weights}'")
    rows = embeddings.select("vec_id", whole(F.col("embedding")).alias("x")).where("x IS NOT NULL AND size(x) > 0")
    key = [F.xxhash64("x").alias("k1"), F.xxhash64(F.lit("second"), "x").alias("k2")]
    distinct = rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies"))
    weight = F.lit(1).cast("long") if weights == "one" else F.col("copies")
    distinct = written(distinct.select(*key, "x", weight.alias("w")))
    fits = fit(distinct)
    white = written(distinct.mapInArrow(
        lambda batches: _white_rows(batches, fits, k),
        "k1 long, k2 long, d int, w long, deviation long, white array<double>"))
    errors = identity_errors(white)
    told = F.create_map(*[c for d, f in fits.items() for c in (
        F.lit(d), F.struct(
            F.lit(f.weight).cast("long").alias("n"), F.lit(errors.get(d, 0.0)).alias("identity_error"),
            F.array(*[F.lit(float(v / f.trace)) for v in f.values[:k]]).cast("array<double>").alias("explained")))]
    ) if fits else F.lit(None).cast("map<int,struct<n:bigint,identity_error:double,explained:array<double>>>")
    found = rows.select("vec_id", *key).join(white, ["k1", "k2"]).select(
        "vec_id", "deviation", told[F.col("d")].alias("fit"), F.posexplode("white").alias("place", "whitened"))
    return found.select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), "fit.n", "deviation", "whitened",
        F.col("fit.explained")[F.col("place")].alias("explained"), "fit.identity_error")
