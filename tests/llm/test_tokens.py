"""Token operators against the libraries themselves."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from siltstone.llm import pieces, resync, shingles, simple8b
from siltstone.llm.common import WHITE_SPACE, ChunkTable, before_marker, before_white, written

from .conftest import TEXTS, by_id

BPE, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "\n", "a", "of", " the", "é", "'s", "!", "1", "▁", "\xa0", "<|endoftext|>", "\x1c", "😀", "<s>",
         "\t", "　", "ﬁ", "\r\n"]


@pytest.fixture(scope="module")
def bpe():
    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def odd_texts(n: int) -> list[str]:
    rng = random.Random(3)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(n)] + [t or "" for t in TEXTS]


def test_bytes_by_chunk_equal_the_library(bpe):
    texts = odd_texts(800)
    flat, at = simple8b._table(BPE).ids([t.encode() for t in texts])
    for k, e in enumerate(bpe.encode_batch(texts, add_special_tokens=False)):
        assert flat[at[k]:at[k + 1]].tolist() == e.ids, repr(texts[k])


def test_pieces_by_chunk_equal_the_library(model):
    texts = odd_texts(800)
    assert pieces._model(MODEL)[1] is not None  # the model's pieces stay within words
    for t, ids in zip(texts, pieces.encode_texts(MODEL, [t.encode() for t in texts]), strict=True):
        assert ids.tolist() == model.encode(t), repr(t)


def test_chunk_table_starts_afresh_when_full():
    table = ChunkTable(before_white, lambda chunks: [[len(c)] for c in chunks], None, limit=3)
    for texts in ([b"a bb", b"ccc"], [b"dddd a"], [b"e" * 9, b""], [b""], [b" x  y", b"", b"z"]):
        flat, at = table.ids(texts)
        want = [[len(c) for c in re.findall(rb" *[^ ]+", t)] for t in texts]
        assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want


def test_chunks_of_one_hash_are_encoded_whole(monkeypatch):
    monkeypatch.setattr(shingles, "spans", lambda data, begin, end, second=False: (
        end - begin if second else begin * 0).astype(np.uint64))
    table = ChunkTable(before_white, lambda chunks: [[7]] * len(chunks), lambda texts: [[len(t)] for t in texts])
    flat, at = table.ids([b"a bcd", b"ef"])
    assert flat.tolist() == [5, 2] and at.tolist() == [0, 1, 2]


def test_white_space_beyond_ascii_is_not_cut():
    wide = "\x85\xa0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000"
    assert set(wide) <= set(WHITE_SPACE)
    for c in wide:
        assert before_white(np.frombuffer(f"é b{c} d".encode(), np.uint8)).tolist() == [2]
    assert before_white(np.frombuffer("東 é\tß".encode(), np.uint8)).tolist() == [3, 6]
    assert before_marker(np.frombuffer("a▁ b ▁c ▂▁".encode(), np.uint8)).tolist() == [1, 6, 11, 15]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_256), st.integers(0, 2**64 - 1)), max_size=400),
       st.sampled_from([1, 7, 64, 1024]))
def test_simple8b_round_trip(ids, block):
    x = np.array(ids, np.uint64)
    words, offsets, escapes = simple8b.pack(x, block)
    assert (simple8b.unpack(words, offsets, escapes, len(x), block) == x).all()
    assert len(offsets) == -(-len(x) // block)


def test_simple8b_packs_runs_and_blocks_decode_alone():
    x = np.concatenate([np.zeros(240, np.uint64), np.arange(2000, dtype=np.uint64)])
    words, offsets, escapes = simple8b.pack(x, 120)
    assert (np.diff(offsets)[:2] == 1).all() and len(escapes) == 0  # 120 zeros are one word
    one = simple8b.unpack(words[offsets[5]:offsets[6]], np.zeros(1, np.int64), escapes, 120, 120)
    assert (one == x[600:720]).all()


def test_files_round_trip(spark, awkward, nothing, bpe):
    got = sorted(simple8b.round_trip(awkward, BPE).collect(), key=lambda r: r.start)
    rows = sorted((r.doc_id, r.text or "") for r in awkward.collect())
    at = 0
    assert [r.doc_id for r in got] == [i for i, _ in rows]  # ascending, repeats kept
    for r, (_, text) in zip(got, rows, strict=True):
        ids = np.array([*bpe.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert simple8b.round_trip(nothing, BPE).count() == 0


def test_segments_split_between_documents(spark, awkward, monkeypatch):
    monkeypatch.setattr(simple8b, "SEGMENT", 50)
    files = written(simple8b.encode_documents(awkward, BPE, 2))
    s = files.collect()
    assert all(r.n_ids == sum(r.doc_tokens) and len(r.doc_ids) == len(r.doc_tokens) for r in s)
    got = sorted(simple8b.decode_documents(files).collect(), key=lambda r: r.start)
    assert [a.start + a.n_tokens for a in got[:-1]] == [b.start for b in got[1:]]


def test_sentencepiece_digests(spark, awkward, nothing, model):
    got = by_id(pieces.encode(awkward, MODEL))
    for r in awkward.collect():
        ids = model.encode(r.text or "", add_bos=True, add_eos=True)
        raw = np.array(ids, "<u4").tobytes()
        want = (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest())
        assert all((g.n_tokens, g.ids_sha256, g.decoded_sha256) == want for g in got[r.doc_id])
    assert sum(map(len, got.values())) == awkward.count()
    assert pieces.encode(nothing, MODEL).count() == 0


def test_sentencepiece_ids_and_kept_columns(spark, awkward, model):
    got = pieces.encode(awkward, MODEL, keep=["doc_id", "key"], digests=False).where("doc_id = 27").first()
    assert got.key == "k" and got.ids == model.encode(TEXTS[9], add_bos=True, add_eos=True)
    assert got.decoded == TEXTS[9]


@pytest.mark.parametrize("chunk, overlap", [(40, 2), (200, 16), (1000, 64)])
def test_splicing_equals_encoding_whole(bpe, chunk, overlap):
    rng = random.Random(5)
    texts = ["".join(rng.choices(odd_texts(50), k=40)) for _ in range(25)]
    texts += ["a" * 3000 + " b " * 50 + "c" * 2000, " " * 3000 + "x", "<|endoftext|>" * 200, "word " * 2000]
    widened = 0
    for t in texts:
        ids, w = resync.splice(resync._tokenizer(BPE), t, chunk, overlap)
        widened += w
        assert ids == bpe.encode(t, add_special_tokens=False).ids, repr(t[:80])
    assert widened > 0  # alignment did fail at first, and the wider overlap mended it


def test_token_counts(spark, awkward, nothing, bpe):
    got = by_id(resync.count(awkward, BPE, limit=100, chunk=1000, overlap=16))
    for r in awkward.collect():
        n = len(bpe.encode(r.text or "", add_special_tokens=False).ids)
        assert all((g.n_bytes, g.n_tokens, g.over_limit) == (len((r.text or "").encode()), n, n > 100)
                   for g in got[r.doc_id])
    assert len(got[9]) == len(got[24]) == 2
    assert resync.count(nothing, BPE).count() == 0
