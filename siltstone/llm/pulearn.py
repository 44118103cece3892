"""Text quality by positive-unlabelled learning.

Trusted positives and unlabelled web text train a logistic model that minimises the
non-negative unbiased risk: with class prior pi, the negatives' risk is that of the unlabelled
minus pi times that of the positives, and never counts below zero. The prior is estimated from
the same data by the best-bin rule. Features are statistics of the text alone.

Every unlabelled row has its part in the risk: tasks add up its loss, gradient and curvature
over their rows, Spark adds up the tasks, and the driver makes Newton steps with sums whose size
is that of the features.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import crc_part, written

#: Bound of the sample of labelled rows that is fitted; everything else covers all documents.
MAX_POSITIVE = 20_000
#: Byte classes whose share of the text is a feature.
CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&|<>",
           "!?", ".,;:", " \t\n\x0b\x0c\r", "@/\\=+_~^{}[]()-'\"`")
N_FEATURES = len(CLASSES) + 1 + 8
#: Newton steps at most, weight decay of the fit and of the prior's model (which has to rank rows
#: it has not seen), and the slope at which a fit ends; standardised features are clipped at CLIP.
STEPS, DECAY, PRIOR_DECAY, FLAT, CLIP = 30, 1e-2, 1e-2, 1e-5, 6.0
#: Thresholds at which tails are compared for the prior.
CUTS = 200

_CLASS_OF = np.full(256, len(CLASSES), np.int64)  # the last class: bytes beyond ASCII and controls
for _k, _chars in enumerate(CLASSES):
    for _c in _chars.encode():
        _CLASS_OF[_c] = _k


def features(text: str) -> list[float]:
    """Statistics of a whole text: shares of byte classes, word and line repetition, sizes."""
    raw = text.encode()
    w = raw.split()  # on ASCII white space: the words of the contract
    n = len(w)
    share = np.bincount(_CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=len(CLASSES) + 1) / max(1, len(raw))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    grams = max(0, n - 2)
    return [
        *share.tolist(),
        np.log1p(n),
        sum(map(len, w)) / max(1, n),
        np.log1p(len(set(w))) / np.log1p(max(1, n)),
        Counter(w).most_common(1)[0][1] / (n + 10) if n else 0.0,
        sum(map(eq, w, w[1:])) / (n + 10),
        (grams - len(set(zip(w, w[1:], w[2:], strict=False)))) / (grams + 30),
        (len(lines) - len(set(lines))) / (len(lines) + 4),
        1.0 / (1 + n),
    ]


def feature_table(docs: DataFrame) -> DataFrame:
    """doc_id and the features of each row's whole text (NULL as empty)."""

    def run(batches):
        for b in batches:
            x = [features(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(x, pa.list_(pa.float32()))], ["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, x array<float>")


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Unlabelled:
    """The unlabelled rows, of which only sums over all of them ever leave their tasks."""

    def __init__(self, rows: DataFrame):
        """rows: x and half (0 or 1)."""
        self.rows = rows

    def total(self, work, half: int | None = None) -> np.ndarray:
        """The sum of ``work`` (a matrix of features to a vector) over batches of all rows or of
        one half; empty if there are none."""

        def run(batches):
            out = None
            for b in batches:
                if b.num_rows:
                    part = work(b.column("x").flatten().to_numpy().astype(np.float64).reshape(b.num_rows, -1))
                    out = part if out is None else out + part
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array([out.tolist()])], ["sums"])

        rows = self.rows if half is None else self.rows.where(F.col("half") == half)
        parts = rows.select("x").mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("i", "v"))
        found = parts.groupBy("i").agg(F.sum("v").alias("v")).collect()  # a row per feature and pair of them
        return np.array([r.v for r in sorted(found, key=lambda r: r.i)])

    def quantiles(self) -> np.ndarray:
        """The 0.1, 0.5 and 0.9 quantile of every feature, by columns; zeros without rows."""
        got = self.rows.agg(*[F.percentile_approx(F.col("x")[i], [0.1, 0.5, 0.9], 10_000).alias(f"q{i}")
                              for i in range(N_FEATURES)]).first()
        return np.zeros((3, N_FEATURES)) if got[0] is None else np.array(got, np.float64).T


def _softplus(f: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, f)


def _slopes(model: dict, w: np.ndarray):
    """Of a matrix of features: rows, loss as negatives, its gradient and curvature."""

    def work(x: np.ndarray) -> np.ndarray:
        z = expand(model, x)
        f = z @ w
        s = _sigmoid(f)
        return np.concatenate([[len(z), _softplus(f).sum()], s @ z, ((z * (s * (1 - s))[:, None]).T @ z).ravel()])

    return work


def _newton(model: dict, unlabelled, half: int | None, positive, decay: float,
            allowed=lambda loss, w: True) -> np.ndarray:
    """Weights that minimise the positives' loss plus the unlabelled rows' mean loss as negatives.

    ``positive`` gives loss, gradient and curvature of the positives at some weights. A step
    that does not lower the whole, or leads where the loss is not ``allowed``, is halved.
    """
    d = 2 * N_FEATURES + 1

    def at(w: np.ndarray):
        sums = unlabelled.total(_slopes(model, w), half)
        if not len(sums):
            sums = np.zeros(2 + d + d * d)
        sums = sums / max(1.0, sums[0])
        loss, g, h = positive(w)
        return (loss + sums[1] + decay / 2 * w @ w, g + sums[2:2 + d] + decay * w,
                h + sums[2 + d:].reshape(d, d) + decay * np.eye(d), sums[1])

    w = np.zeros(d)
    now = at(w)
    for _ in range(STEPS):
        if np.abs(now[1]).max() < FLAT:
            break
        step = np.linalg.solve(now[2], now[1])
        for _ in range(8):
            new = at(w - step)
            if new[0] <= now[0] and allowed(new[3], w - step):
                break
            step = step / 2
        else:
            break
        w, before, now = w - step, now, new
        if before[0] - now[0] < 1e-9:
            break
    return w


def estimate_prior(model: dict, pos: np.ndarray, unlabelled, least: float = 0.1) -> float:
    """Share of positives among the unlabelled: over all thresholds, the least ratio of tails.

    A model that tells positives from unlabelled is fitted on half of each; on the other half,
    above any threshold the unlabelled hold at least prior * (positives' share there).
    """
    p1, p2 = pos[::2], pos[1::2]

    def positive(w):
        s = _sigmoid(-p1 @ w)
        return (_softplus(-p1 @ w).mean(), -(s @ p1) / len(p1), (p1 * (s * (1 - s))[:, None]).T @ p1 / len(p1))

    if not len(p2):
        return 0.5
    w = _newton(model, unlabelled, 0, positive, PRIOR_DECAY)
    sp = np.sort(p2 @ w)
    cuts = np.quantile(sp, np.linspace(0, 1 - least, CUTS))

    def tails(x: np.ndarray) -> np.ndarray:
        f = np.sort(expand(model, x) @ w)
        return np.append(len(f) - np.searchsorted(f, cuts, side="left"), len(f)).astype(np.float64)

    found = unlabelled.total(tails, 1)
    if not len(found) or not found[-1]:
        return 0.5
    n, tail_u = found[-1], found[:-1] / found[-1]
    tail_p = 1 - np.searchsorted(sp, cuts, side="left") / len(sp)
    slack = np.sqrt(np.log(40) / 2 / n) + np.sqrt(np.log(40) / 2 / len(sp))
    best = int(np.argmin((tail_u + slack) / np.maximum(tail_p, 1e-9)))
    return float(np.clip(tail_u[best] / tail_p[best], 0.05, 0.99))


def fit(pos: np.ndarray, unlabelled) -> dict:
    """Weights, scaling and prior of the non-negative risk minimiser.

    The unbiased risk of a linear logistic model is convex: the positives' two losses differ by
    the score itself. Steps end where the negatives' risk would fall below zero.
    """
    low, mid, high = unlabelled.quantiles()
    model = {"mid": mid, "spread": np.maximum(high - low, 0.01), "w": np.zeros(2 * N_FEATURES + 1), "prior": 0.5}
    if not len(pos):
        return model
    p = expand(model, pos)
    pi = model["prior"] = estimate_prior(model, p, unlabelled)
    mean = p.mean(0)
    model["w"] = _newton(
        model, unlabelled, None, lambda w: (-pi * mean @ w, -pi * mean, np.zeros((len(mean), len(mean)))), DECAY,
        allowed=lambda loss, w: loss - pi * _softplus(p @ w).mean() >= 0)
    return model


def expand(model: dict, x: np.ndarray) -> np.ndarray:
    """Standardised, clipped features, their absolute values, and one."""
    z = np.clip((x - model["mid"]) / model["spread"], -CLIP, CLIP)
    return np.concatenate([z, np.abs(z), np.ones((len(x), 1))], axis=1)


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    return _sigmoid(expand(model, x) @ model["w"])


def sample(rows: DataFrame, bound: int, seed: int) -> np.ndarray:
    """Features of at most ``bound`` rows, those of the least hashes of their doc_id."""
    h = F.xxhash64(F.lit(seed), "doc_id")
    got = rows.select(h.alias("h"), "doc_id", "x").orderBy("h", "doc_id", "x").limit(bound).select("x").toArrow()
    return np.array(got.column("x").to_pylist(), np.float64).reshape(got.num_rows, N_FEATURES)


def learn(table: DataFrame, labels: DataFrame, held: int = 2, parts: int = 4) -> dict:
    """Fits on rows whose crc part is not ``held``; a positive has no label but 1."""
    train = table.where(crc_part(F.col("doc_id"), parts) != held)
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")
    positives = sample(train.join(good, "doc_id", "left_semi"), MAX_POSITIVE, 11)
    half = F.pmod(F.xxhash64(F.lit(13), "doc_id"), F.lit(2)).cast("int")
    return fit(positives, Unlabelled(written(train.select("x", half.alias("half")))))


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, held: int = 2, parts: int = 4) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (score >= threshold) for every row.

    NULL and empty texts are scored from the features of an empty text. Without positives
    every score is 0.5. Repeated rows score alike; an empty table gives an empty result.
    """
    table = written(feature_table(docs))
    model = learn(table, labels, held, parts)

    def run(batches):
        for b in batches:
            x = np.array(b.column("x").to_pylist(), np.float64).reshape(b.num_rows, N_FEATURES)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(predict(model, x), pa.float64())], ["doc_id", "score"])

    return table.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", (crc_part(F.col("doc_id"), parts) == held).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
