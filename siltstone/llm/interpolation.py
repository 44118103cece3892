"""Language-model scores by deleted interpolation of n-gram estimates.

The probability of a token mixes the maximum-likelihood estimates of its bigram, its unigram
and the uniform distribution. The mixture weights depend on how often the context was seen
(buckets of powers of two) and are learned by expectation-maximisation: a part of the training
documents is deleted from the counts and its own counts are what the weights are fitted to.

Counting and looking up both go by chunks of documents. A chunk sends its distinct n-grams,
as sorted 64-bit hashes with counts, to the partitions of the hash space; there the chunks'
counts are summed and sent back in the order asked. N-grams are hashed, so no word or context
weighs on one partition, and every chunk has summed its own before anything moves.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import shingles
from siltstone.llm.common import batches_by_size, written

#: Tokens of a chunk; n-grams (over all chunks) that meet in one partition of the hash space.
CHUNK, MEETING = 1_000_000, 1_000_000
#: Documents' crc parts: the test part, and the training part whose counts fit the weights.
PARTS, TEST, TUNE = 10, 0, 1
#: Buckets of context frequency; histogram steps per decade; EM rounds.
BUCKETS, STEP, ROUNDS = 24, 10, 60
END, START = np.uint64(0xE1D0000000000001), np.uint64(0x57A2700000000001)


def deflate(a: np.ndarray) -> bytes:
    return zlib.compress(a.tobytes(), 1)


def inflate(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zlib.decompress(b), kind)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending distinct 64-bit numbers as differences of six bytes, or eight if one is larger."""
    d = np.diff(keys, prepend=np.uint64(0)) if len(keys) else keys
    short = not len(d) or int(d[1:].max(initial=0)) < 1 << 48
    if not short:
        return b"8" + d.astype("<u8").tobytes()
    head = d[:1].astype("<u8").tobytes()
    return b"6" + head + d[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack_sorted(b: bytes) -> np.ndarray:
    if b[:1] == b"8":
        return np.cumsum(np.frombuffer(b, "<u8", offset=1), dtype=np.uint64)
    rest = np.frombuffer(b, np.uint8, offset=min(9, len(b))).reshape(-1, 6)
    d = np.zeros((len(rest) + (len(b) > 1), 8), np.uint8)
    if len(d):
        d[0] = np.frombuffer(b, np.uint8, 8, offset=1)
        d[1:, :6] = rest
    return np.cumsum(d.reshape(-1).view("<u8"), dtype=np.uint64)


def bigrams(tokens: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Hash of every token with the one before it (START at the head of a document)."""
    before = np.concatenate([[START], tokens[:-1]]) if len(tokens) else tokens
    before[np.cumsum(lens) - lens] = START
    return shingles.mix(before * np.uint64(0x9E3779B97F4A7C15) + tokens)


CHUNKS = ("chunk string, tuning boolean, doc_ids array<long>, parts array<int>, lens array<int>, "
          "vocabulary binary, tokens binary, n_tokens long")


def chunk_table(docs: DataFrame) -> DataFrame:
    """Documents as chunks of token numbers; tuning documents in chunks of their own.

    Words are runs of anything but ASCII white space with A-Z in lower case; every document
    ends in one end token. NULL counts as an empty text. A document is never split.
    """

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        held = {t: [] for t in (False, True)}
        size = {t: 0 for t in (False, True)}

        def close(tuning):
            nonlocal seq
            rows, held[tuning], size[tuning] = held[tuning], [], 0
            if not rows:
                return
            tokens = np.concatenate([r[2] for r in rows])
            vocabulary, at = np.unique(tokens, return_inverse=True)
            seq += 1
            yield pa.RecordBatch.from_arrays([
                pa.array([f"{part}-{seq}"]), pa.array([tuning]), pa.array([[r[0] for r in rows]], pa.list_(pa.int64())),
                pa.array([[r[1] for r in rows]], pa.list_(pa.int32())), pa.array([[len(r[2]) for r in rows]], pa.list_(pa.int32())),
                pa.array([pack_sorted(vocabulary)], pa.binary()), pa.array([deflate(at.astype("<u4"))], pa.binary()),
                pa.array([len(tokens)], pa.int64())], CHUNK_NAMES)

        for b in batches:
            ids, parts = b.column("doc_id").to_pylist(), b.column("part").to_pylist()
            texts = [t or "" for t in b.column("text").to_pylist()]
            for lo, hi in batches_by_size(texts, 1 << 20):
                h, counts = shingles.words(texts[lo:hi], lower=True)
                ends = np.cumsum(counts)
                for k, (a, z) in enumerate(zip((ends - counts).tolist(), ends.tolist(), strict=True)):
                    tuning = parts[lo + k] == TUNE
                    held[tuning].append((ids[lo + k], parts[lo + k], np.append(h[a:z], END)))
                    size[tuning] += z - a + 1
                    if size[tuning] >= CHUNK:
                        yield from close(tuning)
        for tuning in (False, True):
            yield from close(tuning)

    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return docs.select("doc_id", (crc % PARTS).cast("int").alias("part"), "text").mapInArrow(run, CHUNKS)


CHUNK_NAMES = [c.split()[0] for c in CHUNKS.split(", ")]


def _tokens(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vocabulary, token numbers and document lengths of a chunk."""
    return unpack_sorted(row["vocabulary"]), inflate(row["tokens"], "<u4"), np.array(row["lens"], np.int64)


def requests(chunks: DataFrame, bits: int) -> DataFrame:
    """Rows p, order, chunk, keys, counts: a chunk's distinct n-grams in one range of the hash space.

    counts: of training documents without the tuning part, then of the tuning part.
    """

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                vocabulary, at, lens = _tokens(row)
                trained = np.repeat(np.array(row["parts"]) != TEST, lens)
                pairs, pair_at = np.unique(bigrams(vocabulary[at], lens), return_inverse=True)
                for order, keys, where in ((1, vocabulary, at), (2, pairs, pair_at)):
                    counts = np.bincount(where[trained], minlength=len(keys)).astype("<u4")
                    cuts = np.searchsorted(keys >> np.uint64(64 - bits) if bits else keys * np.uint64(0), np.arange((1 << bits) + 1))
                    parts = [(p, a, z) for p, (a, z) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if z > a]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([p for p, _, _ in parts], pa.int32()), pa.array([order] * len(parts), pa.int32()),
                        pa.array([row["chunk"]] * len(parts), pa.string()), pa.array([row["tuning"]] * len(parts)),
                        pa.array([pack_sorted(keys[a:z]) for _, a, z in parts], pa.binary()),
                        pa.array([deflate(counts[a:z]) for _, a, z in parts], pa.binary())],
                        ["p", "order", "chunk", "tuning", "keys", "counts"])

    return chunks.select("chunk", "tuning", "parts", "lens", "vocabulary", "tokens").mapInArrow(
        run, "p int, order int, chunk string, tuning boolean, keys binary, counts binary")


ANSWERS = "order int, p int, chunk string, tuning boolean, rest binary, tuned binary, types long, rest_types long, tokens long, rest_tokens long"


def answers(asked: DataFrame) -> DataFrame:
    """The summed counts (without, and of, the tuning part) of every request, in its key order.

    One row per partition and order, without chunk, has the number of types and tokens.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_sorted(k) for k in pdf["keys"]]
        counts = [inflate(c, "<u4") for c in pdf["counts"]]
        sizes = np.array([len(k) for k in keys])
        found, at = np.unique(np.concatenate(keys), return_inverse=True)
        tuning = np.repeat(pdf["tuning"].to_numpy(bool), sizes)
        weight = np.concatenate(counts)
        tuned = np.bincount(at[tuning], weight[tuning], len(found)).astype(np.int64)
        rest = np.bincount(at[~tuning], weight[~tuning], len(found)).astype(np.int64)
        cuts = np.cumsum(sizes)[:-1]
        order, p = int(pdf["order"].iloc[0]), int(pdf["p"].iloc[0])
        rows = [(order, p, c, t, deflate(rest[a].astype("<u8")), deflate(tuned[a].astype("<u8")), 0, 0, 0, 0)
                for c, t, a in zip(pdf["chunk"], pdf["tuning"], np.split(at, cuts), strict=True)]
        rows.append((order, p, None, None, None, None, int((rest + tuned > 0).sum()), int((rest > 0).sum()),
                     int((rest + tuned).sum()), int(rest.sum())))
        return pd.DataFrame(rows, columns=ANSWER_NAMES)

    return asked.groupBy("order", "p").applyInPandas(run, ANSWERS)


ANSWER_NAMES = [c.split()[0] for c in ANSWERS.split(", ")]


def _looked_up(chunk: pd.DataFrame, answer: pd.DataFrame):
    """Per token: tuning-free and tuning counts of token, context and bigram; lengths, row."""
    row = chunk.iloc[0]
    vocabulary, at, lens = _tokens(row)
    pairs, pair_at = np.unique(bigrams(vocabulary[at], lens), return_inverse=True)
    out = []
    for order, size in ((1, len(vocabulary)), (2, len(pairs))):
        mine = answer[answer["order"] == order].sort_values("p")
        both = [np.concatenate([inflate(x, "<u8") for x in mine[c]] or [np.zeros(0)]).astype(np.float64) for c in ("rest", "tuned")]
        assert len(both[0]) == size
        out.append(both)
    (u_rest, u_tuned), (b_rest, b_tuned) = out
    return row, lens, at, (u_rest, u_tuned), (b_rest[pair_at], b_tuned[pair_at])


def _context(unigram: np.ndarray, at: np.ndarray, lens: np.ndarray, documents: float) -> np.ndarray:
    """How often each token's context was seen: the token before, or the start of a document."""
    c = np.concatenate([[0.0], unigram[at[:-1]]]) if len(at) else np.zeros(0)
    c[np.cumsum(lens) - lens] = documents
    return c


def bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(np.log2(np.maximum(context, 0.5))) + 1, BUCKETS - 1).astype(np.int64)


def tuning_counts(chunks: DataFrame, answer: DataFrame, stats: dict) -> DataFrame:
    """How many tuning tokens have which bucket and (in steps of their logarithm) estimates.

    Bounded: BUCKETS x steps x steps rows, -1 standing for an estimate of zero.
    """

    def run(chunk: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        row, lens, at, (unigram, _), (pair, _) = _looked_up(chunk, answer)
        context = _context(unigram, at, lens, stats["rest_documents"])
        p2 = np.where(context > 0, pair / np.maximum(context, 1), 0)
        p1 = unigram[at] / max(1, stats["rest_tokens"])
        grid = lambda p: np.where(p > 0, np.round(-STEP * np.log10(np.maximum(p, 1e-30))), -1).astype(np.int64)
        table = pd.DataFrame({"bucket": bucket(context), "q2": grid(p2), "q1": grid(p1)})
        return table.value_counts().rename("n").reset_index()

    part = chunks.where("tuning").groupBy("chunk").cogroup(answer.where("tuning").groupBy("chunk")).applyInPandas(
        run, "bucket long, q2 long, q1 long, n long")
    return part.groupBy("bucket", "q2", "q1").agg(F.sum("n").alias("n"))


def weights(rows: list, types: int) -> np.ndarray:
    """Mixture weights (bigram, unigram, uniform) of every bucket, by EM on held-out counts."""
    out = np.tile([0.4, 0.5, 0.1], (BUCKETS, 1))
    out[0] = [0.0, 0.9, 0.1]
    for b in range(BUCKETS):
        mine = [r for r in rows if r["bucket"] == b]
        if not mine:
            continue
        n = np.array([r["n"] for r in mine], float)
        value = lambda c: np.array([0.0 if r[c] < 0 else 10 ** (-r[c] / STEP) for r in mine])  # noqa: B023, E731
        p = np.stack([value("q2"), value("q1"), np.full(len(mine), 1 / (types + 1))], axis=1)
        w = out[b]
        for _ in range(ROUNDS):
            share = p * w
            share /= share.sum(1, keepdims=True)
            w = (n[:, None] * share).sum(0) + [0.0 if b == 0 else 0.1, 0.1, 0.1]  # a pinch of each
            w = w / w.sum()
        out[b] = w
    return out


def score(docs: DataFrame) -> DataFrame:
    """Per row: held_out, n_tokens, n_known, train_tokens, base_score and the model's score.

    base_score: additive smoothing (0.1) of unigrams; score: log10 probability under the
    interpolated model. Documents whose crc part is TEST are not learned from. NULL and empty
    texts have just the end token. Repeated rows count as often as they occur; an empty table
    gives an empty result. Without training tokens every token has the uniform chance.
    """
    chunks = written(chunk_table(docs))
    total = chunks.agg(F.sum("n_tokens").alias("n")).first()["n"] or 0
    bits = max(0, int(np.ceil(np.log2(max(1, total / MEETING)))))
    answer = written(answers(requests(chunks, bits)))
    s = answer.where("chunk is null and order = 1").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (
        "types", "rest_types", "tokens", "rest_tokens")]).first().asDict()
    count = lambda yes: F.coalesce(F.sum(F.size(F.filter("parts", yes))), F.lit(0))
    d = chunks.agg(count(lambda p: p != TEST).alias("documents"),
                   count(lambda p: (p != TEST) & (p != TUNE)).alias("rest_documents")).first()
    stats = s | d.asDict()
    answer = answer.where("chunk is not null")
    mixture = weights([r.asDict() for r in tuning_counts(chunks, answer, stats).collect()], stats["rest_types"])
    n, v = stats["tokens"], stats["types"]

    def run(chunk: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        row, lens, at, (u_rest, u_tuned), (b_rest, b_tuned) = _looked_up(chunk, answer)
        unigram, pair = u_rest + u_tuned, b_rest + b_tuned
        context, c = _context(unigram, at, lens, stats["documents"]), unigram[at]
        w = mixture[bucket(context)]
        p2 = np.where(context > 0, pair / np.maximum(context, 1), 0)
        model = np.log10(w[:, 0] * p2 + w[:, 1] * c / max(1, n) + np.where(n > 0, w[:, 2], 1.0) / (v + 1))
        base = np.log10((c + 0.1) / (n + 0.1 * (v + 1)))
        starts = np.cumsum(lens) - lens
        return pd.DataFrame({
            "doc_id": pd.array(row["doc_ids"], "Int64"), "held_out": np.array(row["parts"]) == TEST, "n_tokens": lens,
            "n_known": np.add.reduceat((c > 0).astype(np.int64), starts), "train_tokens": n,
            "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(model, starts)})

    return chunks.groupBy("chunk").cogroup(answer.groupBy("chunk")).applyInPandas(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
