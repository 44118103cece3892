"""Token counts of huge documents from overlapping chunks.

A huge text is cut into chunks that overlap. Each is encoded on its own, with the offsets of
its tokens; near a cut the tokens may be wrong. Neighbours are spliced at a boundary that both
encodings have in the overlap and that is proven stable: the place where white space follows
something else. The byte-level pre-tokenizer ends a piece there whatever stands around it and
merges never cross pieces, so left of it the left chunk is right and right of it the right
chunk. Where the overlap has no such place, it is doubled and both are encoded again.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siltstone.llm.common import WHITE_SPACE, batches_by_size

#: Characters of a chunk (longer texts are huge) and of the first overlap on either side.
CHUNK, OVERLAP = 16_384, 64


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _encode(tokenizer, texts: list[str]):
    return tokenizer.encode_batch(texts, add_special_tokens=False)


def _common(text: str, left: np.ndarray, right: np.ndarray, lo: int, hi: int) -> int:
    """A proven stable boundary in lo < p < hi at which both have a token start, or -1."""
    both = np.intersect1d(left[(left > lo) & (left < hi)], right[(right > lo) & (right < hi)])
    middle = (lo + hi) / 2
    for p in both[np.argsort(np.abs(both - middle), kind="stable")].tolist():
        if text[p] in WHITE_SPACE and text[p - 1] not in WHITE_SPACE:
            return p
    return -1


def splice(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[list[int], int]:
    """Ids of the whole text, and how often an overlap was widened."""
    n = len(text)
    cuts = list(range(chunk, n, chunk))
    spans = [(max(0, a - overlap), min(n, b + overlap)) for a, b in zip([0, *cuts], [*cuts, n], strict=True)]
    parts = [_offsets(e, a) for e, (a, _) in zip(_encode(tokenizer, [text[a:b] for a, b in spans]), spans, strict=True)]
    out: list[int] = []
    ids, begins, span = *parts[0], spans[0]
    done, widened = 0, 0
    for k, cut in enumerate(cuts):
        nxt, width = (*parts[k + 1], spans[k + 1]), overlap
        while True:
            p = _common(text, begins, nxt[1], nxt[2][0], span[1])
            if p > done:
                break
            # Widen: the left one reaches further right, the right one further left.
            width, widened = width * 2, widened + 1
            span = (span[0], min(n, cut + width))
            wide = (max(done, cut - width), max(nxt[2][1], span[1]))
            if span[1] == n:  # the left chunk now reaches the end: nothing left to splice
                ids, begins = _offsets(_encode(tokenizer, [text[span[0]:]])[0], span[0])
                return out + ids[np.searchsorted(begins, done):].tolist(), widened
            e = _encode(tokenizer, [text[span[0]:span[1]], text[wide[0]:wide[1]]])
            ids, begins = _offsets(e[0], span[0])
            nxt = (*_offsets(e[1], wide[0]), wide)
        out += ids[np.searchsorted(begins, done):np.searchsorted(begins, p)].tolist()
        ids, begins, span = nxt
        done = p
    return out + ids[np.searchsorted(begins, done):].tolist(), widened


def _offsets(encoding, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and character offsets of their starts in the whole text."""
    starts = np.array([s for s, _ in encoding.offsets], np.int64) + base
    return np.array(encoding.ids, np.int64), starts


def count(docs: DataFrame, tokenizer_path: str, limit: int = 1024, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit), chunks, widened per row.

    NULL and empty texts have no bytes and no tokens. Rows are independent; an empty table
    gives an empty result. A text without any stable boundary ends up encoded whole.
    """
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, chunks int, widened int"

    def run(batches):
        tokenizer = _tokenizer(tokenizer_path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            tokens, chunks, widened = ([0] * len(texts) for _ in range(3))
            usual = [i for i, t in enumerate(texts) if len(t) <= chunk]
            for a, b in batches_by_size([texts[i] for i in usual], 1 << 20):
                of = usual[a:b]
                for i, e in zip(of, tokenizer.encode_batch_fast([texts[i] for i in of], add_special_tokens=False), strict=True):
                    tokens[i], chunks[i] = len(e), 1
            for i, t in enumerate(texts):
                if len(t) > chunk:
                    ids, widened[i] = splice(tokenizer, t, chunk, overlap)
                    tokens[i], chunks[i] = len(ids), -(-len(t) // chunk)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array(tokens, pa.int64()), pa.array([k > limit for k in tokens], pa.bool_()),
                pa.array(chunks, pa.int32()), pa.array(widened, pa.int32())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "chunks", "widened"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)
