"""SentencePiece ids by a table of distinct chunks.

Where no piece of the model has a white-space marker after another character, no merge crosses
the place where a run of markers begins. A text then falls into marked words (markers and what
follows them) that are segmented independently: each distinct one is segmented once per worker
and its ids are joined back by position. Doing that by a shuffled table of all occurrences
would move every word of the corpus; the table lives in the worker instead, bounded in size.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siltstone.llm.common import ChunkTable, batches_by_size, before_marker, utf8

MARKER = "▁"


@lru_cache(maxsize=2)
def _model(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    table = ChunkTable(before_marker, lambda chunks: _segment(model, chunks),
                       lambda texts: model.encode([t[1:] for t in texts], num_threads=1))
    return model, table if _separable(model) else None


def _separable(model) -> bool:
    """Whether marked words can be segmented apart: by its pieces and its normaliser.

    A marker may stand in a piece only before all other characters, or alone. The normaliser
    must leave texts as they are but for the marker put before them: a probe of white space,
    compatibility characters and controls decodes to itself.
    """
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    probe = " a  b 　ﬁ\tÅ​①\x01 c "
    return (all(MARKER not in p.lstrip(MARKER) for p in pieces) and model.decode(model.encode(probe)) == probe
            and model.encode_as_pieces("a b")[0].startswith(MARKER))


def _segment(model, chunks: list[str]) -> list[list[int]]:
    """Ids of chunks that begin with a marker: the model puts that first marker back itself.

    It does not for an empty text, so a lone marker is looked up.
    """
    ids = model.encode([c[1:] for c in chunks], num_threads=1)
    return [x if len(c) > 1 else [model.piece_to_id(MARKER)] for c, x in zip(chunks, ids, strict=True)]


def encode_texts(path: str, texts: list[bytes]) -> list[np.ndarray]:
    """Ids of each text (UTF-8) without begin and end ids."""
    model, table = _model(path)
    if table is None:
        return [np.array(x, np.uint32) for x in model.encode([t.decode() for t in texts], num_threads=1)]
    flat, at = table.ids([b" " + t if t else b"" for t in texts])
    return [flat[at[k]:at[k + 1]] for k in range(len(texts))]


def encode(docs: DataFrame, model_path: str, bos: int = 1, eos: int = 2, keep: list[str] | None = None,
           digests: bool = True) -> DataFrame:
    """Per row: ``keep`` columns (doc_id by default) and the ids with begin and end ids.

    ``digests``: n_tokens, ids_sha256 and decoded_sha256 (of the library's decode); otherwise
    n_tokens, ids and decoded. NULL counts as an empty text: the two special ids, decoded to
    nothing. Rows are independent; repeats and extra columns change nothing, an empty table
    gives an empty result. Long texts are taken one at a time.
    """
    keep = keep or ["doc_id"]
    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    result = {"n_tokens": ("long", pa.int64()), **(
        {"ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())} if digests else
        {"ids": ("array<int>", pa.list_(pa.int32())), "decoded": ("string", pa.string())})}
    schema = f"{kept}, " + ", ".join(f"{k} {v[0]}" for k, v in result.items())

    def run(batches):
        model, _ = _model(model_path)
        for batch in batches:
            texts = utf8(batch.column(batch.num_columns - 1))
            for a, b in batches_by_size(texts, 1 << 21):
                n, first, second = [], [], []
                for ids in encode_texts(model_path, texts[a:b]):
                    full = np.concatenate([[bos], ids, [eos]]).astype("<u4")
                    plain = model.decode(full.tolist())
                    n.append(len(full))
                    first.append(hashlib.sha256(full.tobytes()).hexdigest() if digests else full.astype(np.int32))
                    second.append(hashlib.sha256(plain.encode()).hexdigest() if digests else plain)
                columns = [batch.column(i).slice(a, b - a) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, *(pa.array(v, t) for v, (_, t) in zip((n, first, second), result.values(), strict=True))],
                    [*keep, *result])

    return docs.select(*keep, "text").mapInArrow(run, schema)
