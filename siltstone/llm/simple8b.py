"""Token ids as word-aligned Simple-8b files, in ascending document order.

A 64-bit word is a 4-bit selector and 60 bits of payload; the selector says how many ids of
which width the payload packs. Blocks of BLOCK ids start on a word of their own, and the word
offset of every block is kept, so blocks decode independently and a whole segment decodes in a
few vector operations. Ids of 2^60 and more are escaped to a side list.

A segment is a row of a Parquet table: Spark's committer makes the files appear whole, in any
store that Spark writes, however many executors are lost on the way.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import ChunkTable, batches_by_size, before_white, utf8, written

#: Ids of a block; ids after which a segment is closed (a document stays in one segment).
BLOCK, SEGMENT = 1024, 1 << 20
#: Ids per word and their width, by selector. 0: escape, 1: a run of zeros.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])

SEGMENTS = ("part int, seq int, n_ids long, doc_ids array<long>, doc_tokens array<int>, "
            "words binary, offsets array<int>, escapes binary")


def _selectors(bits: np.ndarray) -> np.ndarray:
    """The densest selector at each place of each block (a row), 0 where none fits.

    The widest of the next k ids, for every k that a selector packs, is a running maximum;
    whoever packs more ids also needs smaller ones, so the selectors that fit are counted.
    """
    fits = np.zeros(bits.shape, np.uint8)
    widest = {1: bits}

    def ahead(a: np.ndarray, by: int) -> np.ndarray:
        return np.pad(a[:, by:], ((0, 0), (0, min(by, a.shape[1]))))

    for s in range(15, 0, -1):
        k = int(COUNTS[s])
        if k not in widest:
            if k <= 15:
                for j in range(max(x for x in widest if x < k) + 1, k + 1):
                    widest[j] = np.maximum(widest[j - 1], ahead(bits, j - 1))
            else:
                widest[k] = np.maximum(widest[k // 2], ahead(widest[k // 2], k // 2))
        now = widest[k] <= WIDTHS[s]
        fits += now
        if not now.any():
            break
    return np.where(fits > 0, 16 - fits.astype(np.int8), 0).astype(np.int8)


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, word offset of each block, and escaped ids of unsigned 64-bit ids.

    Greedy: at each id the selector that packs most; a block's last word may be padded.
    """
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.uint64)
    blocks = -(-n // block)
    bits = np.zeros(blocks * block, np.uint8)
    bits[:n] = np.frexp(ids.astype(np.float64))[1]  # at least the width of the id
    best = _selectors(bits.reshape(blocks, block)).reshape(-1)
    step = COUNTS[best]
    at, ends = np.arange(0, n, block), np.minimum(np.arange(1, blocks + 1) * block, n)
    walk = []
    while (at < ends).any():  # all blocks together, a word at a time
        walk.append(np.where(at < ends, at, -1))
        at = at + step[np.minimum(at, n - 1)]
    walk = np.array(walk).T
    starts = walk[walk >= 0]
    ends = ends.repeat((walk >= 0).sum(1))
    sel = best[starts]
    out = sel.astype(np.uint64) << np.uint64(60)
    escaped = starts[sel == 0]
    out[sel == 0] |= np.arange(len(escaped), dtype=np.uint64)
    padded = np.append(ids, np.zeros(COUNTS.max(), np.uint64))
    for s in np.unique(sel):
        if s < 2:
            continue
        mine = np.flatnonzero(sel == s)
        first = starts[mine]
        value = np.zeros(len(mine), np.uint64)
        left = ends[mine] - first
        for j in range(COUNTS[s]):
            v = padded[first + j] << np.uint64(j * WIDTHS[s])
            value |= v if (left > j).all() else np.where(left > j, v, np.uint64(0))
        out[mine] |= value
    offsets = np.searchsorted(starts, np.arange(0, n, block)).astype(np.int32)
    return out, offsets, ids[escaped]


def unpack(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ids of ``pack``, all words of a selector at once."""
    out = np.zeros(n, np.uint64)
    if n == 0:
        return out
    sel = (words >> np.uint64(60)).astype(np.int64)
    low = words & np.uint64((1 << 60) - 1)
    before = np.cumsum(COUNTS[sel]) - COUNTS[sel]
    of = np.searchsorted(offsets, np.arange(len(words)), side="right") - 1
    start = of * block + before - before[offsets[of]]
    end = np.minimum((of + 1) * block, n)
    for s in np.unique(sel):
        mine = np.flatnonzero(sel == s)
        if s == 0:
            out[start[mine]] = escapes[low[mine].astype(np.int64)]
        elif s > 1:
            places = start[mine, None] + np.arange(COUNTS[s])
            shifts = (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64)
            values = (low[mine, None] >> shifts) & np.uint64((1 << int(WIDTHS[s])) - 1)
            fits = places < end[mine, None]
            out[places[fits]] = values[fits]
    return out


@lru_cache(maxsize=2)
def _table(path: str) -> ChunkTable:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def encode(chunks: list[str]) -> list[list[int]]:
        out = []
        for a, b in batches_by_size(chunks, 1 << 19):
            out += [e.ids for e in tokenizer.encode_batch_fast(chunks[a:b], add_special_tokens=False)]
        return out

    return ChunkTable(before_white, encode, encode)


def _segment(part: int, seq: int, doc_ids: list, ids: list[np.ndarray]) -> dict:
    flat = np.concatenate(ids)
    words, offsets, escapes = pack(flat)
    return {"part": part, "seq": seq, "n_ids": len(flat), "doc_ids": doc_ids, "doc_tokens": [len(x) for x in ids],
            "words": words.astype("<u8").tobytes(), "offsets": offsets, "escapes": escapes.astype("<u8").tobytes()}


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Segments of all documents' ids (schema SEGMENTS), ascending by (part, seq).

    Documents are range-partitioned by doc_id (NULL first) and, among equal ids, by a hash of
    the text, so equal ids of different texts may lie apart and a repeated row is kept as often
    as it occurs. NULL and empty texts give just the end id. Each distinct chunk of a text
    between white space (which the byte-level pre-tokenizer never joins) is encoded once per
    worker; only the text is shuffled.
    """
    schema = SEGMENTS
    arrow = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_ids", pa.int64()),
                       ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int32())),
                       ("words", pa.binary()), ("offsets", pa.list_(pa.int32())), ("escapes", pa.binary())])

    def run(batches):
        table, part, seq = _table(tokenizer_path), TaskContext.get().partitionId(), 0
        doc_ids, ids, size = [], [], 0
        for batch in batches:
            keys, texts = batch.column("doc_id").to_pylist(), utf8(batch.column("text"))
            for a, b in batches_by_size(texts, 1 << 21):
                flat, at = table.ids(texts[a:b])
                for k in range(b - a):
                    doc_ids.append(keys[a + k])
                    ids.append(np.append(flat[at[k]:at[k + 1]], np.uint32(end_id)))
                    size += len(ids[-1])
                    if size >= SEGMENT:
                        yield pa.RecordBatch.from_pylist([_segment(part, seq, doc_ids, ids)], arrow)
                        doc_ids, ids, size, seq = [], [], 0, seq + 1
        if ids:
            yield pa.RecordBatch.from_pylist([_segment(part, seq, doc_ids, ids)], arrow)

    ordered = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).repartitionByRange("doc_id", "h")
    return ordered.sortWithinPartitions("doc_id", "h").select("doc_id", "text").mapInArrow(run, schema)


def starts(segments: DataFrame) -> DataFrame:
    """part, seq and the number of ids in all earlier segments: totals of parts, then of segments."""
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    s = segments.select("part", "seq", "n_ids")
    parts = s.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(
        F.sum("n").over(before(Window.orderBy("part"))), F.lit(0)).alias("ahead"))
    inner = F.coalesce(F.sum("n_ids").over(before(Window.partitionBy("part").orderBy("seq"))), F.lit(0))
    return s.withColumn("inner", inner).join(parts, "part").select(
        "part", "seq", (F.col("ahead") + F.col("inner")).alias("base"))


def decode_documents(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    schema = "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long"

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(np.frombuffer(row["words"], "<u8"), np.array(row["offsets"], np.int64),
                             np.frombuffer(row["escapes"], "<u8"), row["n_ids"]).astype("<u4")
                lens = np.array(row["doc_tokens"], np.int64)
                at = np.cumsum(lens) - lens
                crc = [zlib.crc32(ids[a:a + k].tobytes()) for a, k in zip(at.tolist(), lens.tolist(), strict=True)]
                n = len(lens)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([row["part"]] * n, pa.int32()), "seq": pa.array([row["seq"]] * n, pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()), "at": pa.array(at, pa.int64()),
                    "n_tokens": pa.array(lens, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    return segments.mapInArrow(run, schema).join(starts(segments), ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Writes the files and reads them back; see ``encode_documents`` for the edge cases."""
    return decode_documents(written(encode_documents(docs, tokenizer_path, end_id)))
