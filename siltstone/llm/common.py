"""Helpers shared by the training-data operators."""

from __future__ import annotations

import io
import uuid
import zipfile
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import shingles

#: A word is a run of anything but blank, tab, line feed, VT, FF and CR.
WORD_GAP = r"[\x20\x09-\x0D]+"

#: Unicode White_Space, as the byte-level tokenizers' ``\s`` reads it (fixed values).
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0 " + "".join(map(chr, range(0x2000, 0x200B))) + (
    "    　")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the workers this package, once per application, from the shared folder.

    Workers started elsewhere than in the repository cannot import it otherwise.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent).as_posix())
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/siltstone.zip")
    out = place.getFileSystem(context._jsc.hadoopConfiguration()).create(place)
    out.write(bytearray(packed.getvalue()))
    out.close()
    context.addPyFile(place.toString())
    _shipped.add(context.applicationId)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for NULL."""
    return F.coalesce(F.array_remove(F.split(text, WORD_GAP), ""), F.array().cast("array<string>"))


def column(name: str) -> Column:
    """A column by its whole name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def content(docs: DataFrame, *but: str) -> Column:
    """Hash of all columns but those named, to tell rows apart that agree in them."""
    others = [column(c) for c in docs.columns if c not in but]
    return F.xxhash64(F.to_json(F.struct(*others)) if others else F.lit(0))


def crc_part(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo ``parts`` (an id of NULL counts as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def shared_folder(spark: SparkSession) -> str:
    """A new folder all executors see: under spark.checkpoint.dir, else under the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or (
        spark.conf.get("spark.sql.warehouse.dir") + "/_work")
    return f"{base.rstrip('/')}/siltstone-llm/{uuid.uuid4().hex}"


def written(df: DataFrame, *partition_by: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts lineage, outlives executors."""
    ship(df.sparkSession)
    path = shared_folder(df.sparkSession)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class ChunkTable:
    """Ids of each distinct chunk, encoded once and looked up by every later occurrence.

    ``cuts`` gives the places in a run of bytes at which a new chunk begins, ``encode`` the
    ids of distinct chunks, ``whole`` those of whole texts. Chunks are known by two 64-bit
    hashes: the first finds them, the second must agree, or the texts are encoded whole. At
    most about ``limit`` chunks are kept; a full table starts afresh, which costs time but
    changes no result.
    """

    def __init__(self, cuts, encode, whole, limit: int = 1_500_000):
        self.cuts, self.encode, self.whole, self.limit = cuts, encode, whole, limit
        self._clear()

    def _clear(self) -> None:
        self.key, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.uint32)

    def _add(self, key: np.ndarray, check: np.ndarray, chunks: list[str]) -> None:
        """Encodes new chunks, given in ascending order of their keys."""
        found = self.encode(chunks)
        size = np.fromiter(map(len, found), np.int32, len(found))
        start = (len(self.flat) + np.cumsum(size) - size).astype(np.int32)
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum()))
        at = np.searchsorted(self.key, key)
        self.flat = np.concatenate([self.flat, flat])
        self.key, self.check = np.insert(self.key, at, key), np.insert(self.check, at, check)
        self.start, self.size = np.insert(self.start, at, start), np.insert(self.size, at, size)

    def ids(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids in one array, and where each text's ids start (and the end)."""
        if len(self.key) > self.limit:
            self._clear()
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(sizes)
        joined = b"".join(raw)
        data = np.frombuffer(joined, np.uint8)
        first = np.zeros(len(data) + 1, bool)
        first[(ends - sizes)[sizes > 0]] = True
        first[self.cuts(data)] = True
        begin = np.flatnonzero(first[:-1])
        end = np.append(begin[1:], len(data))[:len(begin)]
        check = shingles.spans(data, begin, end, second=True)
        key, at, inverse = np.unique(shingles.spans(data, begin, end), return_index=True, return_inverse=True)
        place = np.searchsorted(self.key, key)
        known = place < len(self.key)
        known[known] = self.key[place[known]] == key[known]
        new = at[~known]
        if len(new):
            self._add(key[~known], check[new], [joined[a:b].decode() for a, b in zip(begin[new], end[new], strict=True)])
            place = np.searchsorted(self.key, key)
        if not (self.check[place] == check[at]).all() or not (check[at][inverse] == check).all():
            found = self.whole([r.decode() for r in raw])  # two chunks of one hash
            lens = [len(x) for x in found]
            return np.fromiter(chain.from_iterable(found), np.uint32, sum(lens)), np.cumsum([0, *lens])
        place = place[inverse]
        size = self.size[place].astype(np.int64)
        total = np.cumsum(size)
        n = int(total[-1]) if len(total) else 0
        out = self.flat[np.repeat(self.start[place] - (total - size), size) + np.arange(n)]
        texts = np.searchsorted(begin, np.append(ends - sizes, len(data)))
        return out, np.concatenate([[0], total])[texts]


#: UTF-8 of the white space beyond ASCII, the last byte as a range.
_WIDE_WHITE = ((b"\xc2", 0x85, 0x85), (b"\xc2", 0xA0, 0xA0), (b"\xe1\x9a", 0x80, 0x80), (b"\xe2\x80", 0x80, 0x8A),
               (b"\xe2\x80", 0xA8, 0xA9), (b"\xe2\x80", 0xAF, 0xAF), (b"\xe2\x81", 0x9F, 0x9F), (b"\xe3\x80", 0x80, 0x80))
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LEADS = np.zeros(256, bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def before_white(data: np.ndarray) -> np.ndarray:
    """Where ASCII white space follows a character that is no white space of any kind."""
    white = _WHITE[data]
    at = np.flatnonzero(white[1:] & ~white[:-1]) + 1
    if not _LEADS[data].any():
        return at
    inner = np.zeros(len(at), bool)
    for lead, low, high in _WIDE_WHITE:
        hit = (at > len(lead)) & (data[at - 1] >= low) & (data[at - 1] <= high)
        for k, byte in enumerate(reversed(lead)):
            hit[hit] = data[at[hit] - 2 - k] == byte
        inner |= hit
    return at[~inner]


def before_marker(data: np.ndarray) -> np.ndarray:
    """Where a run of blanks and markers (U+2581) begins."""
    opens, closes = data == 0x20, data == 0x20
    lead = np.flatnonzero(data[:-2] == 0xE2)
    lead = lead[(data[lead + 1] == 0x96) & (data[lead + 2] == 0x81)]
    opens[lead] = True
    closes[lead + 2] = True
    return np.flatnonzero(opens[1:] & ~closes[:-1]) + 1


def utf8(column) -> list[bytes]:
    """A string column's values as UTF-8, NULL as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def batches_by_size(texts: list, limit: int = 1 << 22):
    """Consecutive index ranges of at least one text and about ``limit`` length."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, len(texts)
