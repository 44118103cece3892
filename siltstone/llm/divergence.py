"""How far the sources of a language differ in their words, by in-mapper stripes.

Map tasks fold whole documents into stripes, one hash entry per language and term holding its
document frequency and its count in each source, and spill them when the table is full. The
spilled stripes are sorted by key and merged as a stream. Each merged stripe then gives its own
share of every divergence: stripes are dealt to blocks, a block adds up its terms' differences
for each pair of sources and keeps each source's most typical terms, and blocks are summed.

Shares are whole numbers, p = 1 + floor(10^9 (count + 5) / (N + 5 V)), so sums are exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import utf8, written

#: Entries (a term, or a term's source) in a map task's table before it is spilled.
SPILL = 600_000
#: Entries of a block of merged stripes; sources whose pairs one task adds up.
BLOCK, LEFT = 65_536, 256
#: Cells of the term-by-source matrix worked on at once.
CELLS = 1 << 20
SMOOTH = 5

_STRIPE = "lang string, term string, documents long, sources array<string>, counts array<long>"
_STRIPE_TYPE = pa.schema([("lang", pa.string()), ("term", pa.string()), ("documents", pa.int64()),
                          ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])

#: Bytes of a term stay (A to Z in lower case); all others part terms.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_FOLD).split()


def _rows(keys: list[tuple[bytes, bytes]], documents: list[int], by: list[dict[bytes, int]]) -> pa.RecordBatch:
    start = np.cumsum([0, *map(len, by)]).astype(np.int32)
    sources = pa.array(chain.from_iterable(by), pa.binary()).cast(pa.string())
    counts = pa.array(chain.from_iterable(b.values() for b in by), pa.int64())
    return pa.RecordBatch.from_arrays([
        pa.array([k[0] for k in keys], pa.binary()).cast(pa.string()),
        pa.array([k[1] for k in keys], pa.binary()).cast(pa.string()),
        pa.array(documents, pa.int64()),
        pa.ListArray.from_arrays(start, sources),
        pa.ListArray.from_arrays(start, counts)], schema=_STRIPE_TYPE)


def _spilled(table: dict[bytes, dict[bytes, list]], rows: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    for lang, stripes in table.items():
        held = list(stripes.items())
        for at in range(0, len(held), rows):
            part = held[at:at + rows]
            yield _rows([(lang, t) for t, _ in part], [s[0] for _, s in part], [s[1] for _, s in part])


def _fold(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Stripes of whole documents. The empty term, which no text holds, counts documents, so
    that sources without terms are known too."""
    table: dict[bytes, dict[bytes, list]] = {}
    entries = 0
    for batch in batches:
        for text, lang, source in zip(*(utf8(batch[c]) for c in ("text", "lang", "source")), strict=True):
            stripes = table.setdefault(lang, {})
            found = Counter(terms(text))
            found[b""] = 1
            for term, n in found.items():
                stripe = stripes.get(term)
                if stripe is None:
                    stripes[term] = [1, {source: n}]
                    entries += 2
                    continue
                stripe[0] += 1
                by = stripe[1]
                if source in by:
                    by[source] += n
                else:
                    by[source] = n
                    entries += 1
            if entries > limit:
                yield from _spilled(table)
                table, entries = {}, 0
    yield from _spilled(table)


def _merge(batches: Iterable[pa.RecordBatch], least: int, rows: int = 1 << 13) -> Iterator[pa.RecordBatch]:
    """Adds up the stripes of each key, which come in a row; the rare ones are left out.

    Keys that begin and end inside a batch and are rare are told by their summed frequencies
    alone; only the frequent ones, and those at a batch's ends, have their counts added up.
    """
    key, documents, by = None, 0, {}
    out: tuple[list, list, list] = ([], [], [])

    def close() -> None:
        if key is not None and (documents >= least or not key[1]):
            for held, value in zip(out, (key, documents, by), strict=True):
                held.append(value)

    for batch in batches:
        n = len(batch)
        if not n:
            continue
        lang, term = batch["lang"].cast(pa.binary()), batch["term"].cast(pa.binary())
        begins = np.ones(n, bool)
        begins[1:] = pc.or_(pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(term[1:], term[:-1])).to_numpy(zero_copy_only=False)
        first = np.flatnonzero(begins)
        found = np.add.reduceat(batch["documents"].to_numpy(), first)
        wanted = (found >= least) | (pc.binary_length(term).to_numpy()[first] == 0)
        wanted[[0, -1]] = True
        start = batch["counts"].offsets.to_numpy()
        start = start - start[0]
        sources, counts = batch["sources"].flatten().cast(pa.binary()), batch["counts"].flatten()
        after = np.append(first[1:], n)
        for g in np.flatnonzero(wanted):
            i = int(first[g])
            its = (lang[i].as_py(), term[i].as_py())
            if its != key:
                close()
                key, documents, by = its, 0, {}
            documents += int(found[g])
            at, to = int(start[i]), int(start[after[g]])
            for source, count in zip(sources[at:to].to_pylist(), counts[at:to].to_pylist(), strict=True):
                by[source] = by.get(source, 0) + count
        if len(out[0]) >= rows:
            yield _rows(*out)
            out = ([], [], [])
    close()
    if out[0]:
        yield _rows(*out)


def stripes(docs: DataFrame, least: int = 30, spill: int = SPILL) -> DataFrame:
    """lang, term, documents, sources, counts: the terms of each language found in at least
    ``least`` of its documents, and its empty term, which counts documents."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                          for c in ("text", "lang", "source")])
    parts = texts.mapInArrow(lambda batches: _fold(batches, spill), _STRIPE)
    return (
        parts.repartition("lang", "term")
        .sortWithinPartitions("lang", "term")
        .mapInArrow(lambda batches: _merge(batches, least), _STRIPE)
    )


def shares(counts: np.ndarray, divisor: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 5) / divisor), in steps of 1000 so that nothing overflows."""
    whole, rest = np.divmod(counts + SMOOTH, divisor)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, divisor)
        whole = whole * 1000 + digit
    return whole + 1


def _differences(groups: pd.DataFrame, merged: pd.DataFrame, mine: slice, top: int) -> pd.DataFrame:
    """A block's part of each divergence of the sources ``mine``, by their order.

    ``groups`` holds every source of the language (source, n) with the language's v and
    lang_n; ``merged`` the block's stripes.
    """
    groups = groups.sort_values("source")
    names = groups["source"].tolist()
    mine = range(len(names))[mine]
    pair = np.zeros((len(mine), len(names)), np.int64)
    typical = []
    if len(merged):
        place = {s: i for i, s in enumerate(names)}
        divisor = groups["n"].to_numpy(np.int64) + SMOOTH * int(groups["v"].iloc[0])
        all_divisor = np.int64(groups["lang_n"].iloc[0] + SMOOTH * groups["v"].iloc[0])
        words = merged["term"].to_numpy(object)
        step = max(1, CELLS // len(names))
        for at in range(0, len(merged), step):
            part = merged.iloc[at:at + step]
            sizes = part["sources"].map(len).to_numpy()
            row = np.repeat(np.arange(len(part)), sizes)
            column = np.fromiter(map(place.__getitem__, chain.from_iterable(part["sources"])), np.int64, len(row))
            counts = np.zeros((len(part), len(names)), np.int64)
            counts[row, column] = np.concatenate(part["counts"].tolist())
            p = shares(counts, divisor)
            for k, i in enumerate(mine):
                pair[k] += np.abs(p - p[:, i:i + 1]).sum(axis=0)
            q = shares(counts.sum(axis=1), all_divisor)
            own = slice(mine.start, mine.stop)
            above = (counts[:, own] > 0) & (p[:, own] > q[:, None])
            t, s = np.nonzero(above)
            typical.append(pd.DataFrame({"source": s + mine.start, "item": words[at + t],
                                         "value": (p[:, own] - q[:, None])[t, s]}))
    k, i = np.nonzero(np.arange(len(names)) != np.array(mine)[:, None])
    out = [pd.DataFrame({"source": k + mine.start, "part": "pair", "item": [names[x] for x in i],
                         "value": pair[k, i]})]
    if typical:
        best = pd.concat(typical).sort_values(["source", "value", "item"], ascending=[True, False, True])
        out.append(best.groupby("source").head(top).assign(part="term"))
    found = pd.concat(out)
    found["source"] = [names[x] for x in found["source"]]
    return found[["source", "part", "item", "value"]]


def audit(docs: DataFrame, least: int = 30, top: int = 50, spill: int = SPILL, block_entries: int = BLOCK,
          left_sources: int = LEFT) -> DataFrame:
    """lang, source, part, item, value, rank: divergences of each source of a language.

    ``pair`` rows give the summed difference of shares to each other source, ``term`` rows the
    ``top`` terms whose share most exceeds the language's. NULL text, lang or source is ''; an
    empty text adds its source only; a language without frequent terms has pairs of value 0;
    ties go by item; a repeated row is a document of its own; other columns are ignored; an
    empty table gives no rows.
    """
    merged = written(stripes(docs, least, spill))
    entry = merged.select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("e"))
    held = F.col("term") != ""
    groups = entry.groupBy("lang", F.col("e.sources").alias("source")).agg(
        F.sum(F.when(held, F.col("e.counts")).otherwise(0)).alias("n"),
        F.count_if(held).alias("entries"))
    per_lang = groups.groupBy("lang").agg(
        F.sum("n").alias("lang_n"),
        (1 + F.floor(F.sum("entries") / block_entries)).alias("blocks"),
        F.ceil(F.count(F.lit(1)) / left_sources).alias("lefts"))
    kept = merged.where(held).groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    per_lang = per_lang.join(kept, "lang", "left").na.fill(0, ["v"])
    lefts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("lefts") - 1)).alias("left")
    known = groups.join(per_lang, "lang").select(
        "lang", "source", "n", "v", "lang_n", "lefts",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    ).select("lang", "source", "n", "v", "lang_n", "block", lefts)
    dealt = merged.where(held).join(per_lang.select("lang", "blocks", "lefts"), "lang").select(
        "lang", "term", "sources", "counts",
        F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), lefts
    ).withColumnsRenamed({"lang": "its_lang", "block": "its_block", "left": "its_left"})

    def block(key: tuple, mine: pd.DataFrame, its: pd.DataFrame) -> pd.DataFrame:
        run = slice(int(key[2]) * left_sources, (int(key[2]) + 1) * left_sources)
        return _differences(mine, its, run, top).assign(lang=key[0])[
            ["lang", "source", "part", "item", "value"]]

    found = known.groupBy("lang", "block", "left").cogroup(dealt.groupBy("its_lang", "its_block", "its_left")).applyInPandas(
        block, "lang string, source string, part string, item string, value long")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return (
        found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
        .withColumn("rank", F.row_number().over(order))
        .where((F.col("part") == "pair") | (F.col("rank") <= top))
    )
