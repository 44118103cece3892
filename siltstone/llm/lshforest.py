"""Near-duplicate texts by a MinHash LSH forest, verified exactly.

Every text gets a MinHash signature, cut into one label per tree; a tree is the trie of its
sorted labels. Texts first meet under their full labels, then under prefixes shortened step by
step. What has met and agrees in its signature is joined, and a node all of whose texts are
joined by then is closed: nothing in it is compared again, nor moved. Shortening ends, text by
text, where a pair at the similarity asked for meets in some tree with the target recall (a text
too short to be like any other set of shingles ends at the full label), or before, where a
text's nodes hold nobody else or are closed. A closed node loses nothing, as all pairs of a
joined component are compared afterwards on their whole shingle sets.

Texts with the same words are one class from the start, so copies are never paired. Crowded
nodes and large components are cut into blocks, by number and by bytes, and pairs of blocks are
tasks of bounded size that return link counts and a spanning forest, never the pairs themselves.
Nodes are found by a hash of tree and prefix, counted in the map tasks first, so that a crowded
one is no partition of a sort.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from siltstone.llm import shingles
from siltstone.llm.common import batches_by_size, content, written

#: Words of a shingle; trees and label length; chance to be found that a pair at the threshold has.
WIDTH, TREES, LABEL, RECALL = 5, 16, 8, 0.9995
#: MinHashes that a prefix loses from one exchange to the next (within one, it loses them one by one).
STEP = 2
#: Trees whose full labels are exchanged before the others': they join close copies, which closes the others' nodes.
FIRST_TREES = 3
#: Rounds of stars between exchanges; components are only completed after the last one.
ROUNDS = 1
#: Texts of a block of signatures; texts and bytes of a block of shingle sets.
NODE_BLOCK, SET_BLOCK, SET_BYTES = 1024, 256, 32 << 20

_rng = np.random.default_rng(128)
_A = (_rng.integers(0, 1 << 63, TREES * LABEL).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_B = _rng.integers(0, 1 << 63, TREES * LABEL).astype(np.uint64)


def least_agreement(threshold: float, recall: float = RECALL, n: int = TREES * LABEL) -> int:
    """How many of n MinHashes must agree: pairs at the threshold fall below with a hundredth of the loss allowed."""
    below, k = 0.0, 0
    while (below := below + math.comb(n, k) * threshold**k * (1 - threshold)**(n - k)) <= (1 - recall) / 100:
        k += 1
    return k


def shortest_prefix(threshold: float, recall: float = RECALL, trees: int = TREES, label: int = LABEL) -> int:
    """The longest prefix at which pairs at the threshold meet in some tree with the recall."""
    for depth in range(label, 1, -1):
        if 1 - (1 - threshold**depth) ** trees >= recall + (1 - recall) / 100:
            return depth
    return 1


def steps(threshold: float) -> list[int]:
    """Prefix lengths of the exchanges: the full label, then shorter by STEP down to the shortest."""
    last = shortest_prefix(threshold)
    return [*range(LABEL, last, -STEP), last]


def signatures(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """MinHash values (texts x TREES * LABEL); texts without windows get zeros."""
    out = np.zeros((len(counts), len(_A)), np.uint32)
    full = counts > 0
    if full.any():
        starts = (np.cumsum(counts) - counts)[full]
        for k in range(len(_A)):
            out[full, k] = np.minimum.reduceat(((hashes * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def sign(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, h (hash of the text), key (128 bits of its words), sig, windows (0 without words)."""

    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            for lo, hi in batches_by_size(texts, 1 << 21):
                w, counts = shingles.words(texts[lo:hi])
                keys = shingles.sequences(w, counts)
                hashes, n = shingles.windows(w, counts, WIDTH)
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").slice(lo, hi - lo), b.column("h").slice(lo, hi - lo),
                    pa.array([k.tobytes() for k in keys], pa.binary()),
                    pa.array([s.tobytes() for s in signatures(hashes, n)], pa.binary()), pa.array(n, pa.int64())],
                    ["doc_id", "h", "key", "sig", "windows"])

    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(
        run, "doc_id long, h long, key binary, sig binary, windows long")


def forest(adjacent: np.ndarray) -> list[tuple[int, int]]:
    """Edges that span the components of a square boolean matrix."""
    n = len(adjacent)
    seen, out = np.zeros(n, bool), []
    for root in range(n):
        if seen[root]:
            continue
        seen[root], todo = True, [root]
        while todo:
            at = todo.pop()
            new = np.flatnonzero(adjacent[at] & ~seen)
            seen[new] = True
            todo += new.tolist()
            out += [(at, int(x)) for x in new]
    return out


def paired_blocks(members: DataFrame, group: str, blocks: Column, wanted: Column) -> DataFrame:
    """Members of the wanted groups, dealt to pairs of blocks (columns bi <= bj, b).

    ``blocks`` (into how many a group is cut, by a hash of the member) and ``wanted`` are
    aggregates of the group. Each member goes to one pair per block; every two members meet once.
    """
    counts = members.groupBy(group).agg(F.ceil(blocks).cast("int").alias("_n"), wanted.alias("_wanted"))
    counts = counts.where("_wanted").select(F.col(group).alias("_g"), "_n")
    d = members.join(counts, F.col(group) == F.col("_g")).drop("_g")
    d = d.withColumn("b", F.pmod(F.xxhash64(F.lit(7), "key"), F.col("_n")).cast("int"))
    d = d.withColumn("_x", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return d.withColumns({"bi": F.least("b", "_x"), "bj": F.greatest("b", "_x")}).drop("_n", "_x")


def _across(pdf: pd.DataFrame, agree: np.ndarray) -> np.ndarray:
    """Only what this pair of blocks has to compare: all of one block, or across two."""
    np.fill_diagonal(agree, False)
    if pdf["bi"].iloc[0] != pdf["bj"].iloc[0]:
        b = pdf["b"].to_numpy()
        agree &= b[:, None] != b[None, :]
    return agree


def entries(classes: DataFrame, threshold: float) -> DataFrame:
    """key, tree and a node per exchange (n8, n6, ...), of texts that meet somebody under the shortest prefix.

    Who is alone in a node is so under every longer prefix. A text of n windows is at most n / (n + 1)
    like another set; where that is under the threshold, only equal sets count, which agree in
    whole labels: its shorter prefixes are NULL.
    """
    depths = steps(threshold)
    last = f"n{depths[-1]}"
    nodes = F.array(*[F.struct(F.lit(t).alias("tree"), *[
        F.xxhash64(F.lit(t), F.substring("sig", 1 + 4 * LABEL * t, 4 * d)).alias(f"n{d}") for d in depths])
        for t in range(TREES)])
    whole = F.col("windows") < threshold * (F.col("windows") + 1) - 1e-9
    e = classes.where("windows > 0").select("key", whole.alias("whole"), F.explode(nodes).alias("_e")).select(
        "key", "whole", "_e.*")
    shared = e.groupBy(last).agg(F.count(F.lit(1)).alias("_m")).where("_m > 1").select(F.col(last).alias("_g"))
    e = e.join(shared, F.col(last) == F.col("_g"), "left_semi")
    return e.select("key", "tree", F.col(f"n{LABEL}"), *[
        F.when(~F.col("whole"), F.col(f"n{d}")).alias(f"n{d}") for d in depths if d < LABEL])


def agreement(sig: np.ndarray) -> np.ndarray:
    """How many values every two signatures have in common."""
    if len(sig) <= 32:  # small enough to be compared at once
        return (sig[:, None] == sig[None, :]).sum(2, dtype=np.uint8)
    same = np.zeros((len(sig), len(sig)), np.uint8)
    for column in np.ascontiguousarray(sig.T):
        same += column[:, None] == column[None, :]
    return same


def descend(sig: np.ndarray, joined: np.ndarray, block: np.ndarray | None, tree: int, depths: range, least: int):
    """Edges (i, j, depth) that join texts of one node, prefix by prefix.

    ``joined`` numbers what is joined before, ``block`` tells (across two blocks) who has been
    compared elsewhere. Labels are sorted, so a prefix is a run; a run that is joined is left alone.
    """
    labels = sig.reshape(len(sig), TREES, LABEL)[:, tree]
    order = np.lexsort(labels.T[::-1])
    labels, joined, out = labels[order], joined[order].copy(), []
    for depth in depths:
        new = np.flatnonzero((labels[1:, :depth] != labels[:-1, :depth]).any(1)) + 1
        for lo, hi in zip([0, *new], [*new, len(order)], strict=True):
            if (joined[lo:hi] == joined[lo]).all():
                continue
            at = order[lo:hi]
            near = agreement(sig[at]) >= least
            if block is not None:
                near &= block[at][:, None] != block[at][None, :]
            apart = joined[lo:hi][:, None] != joined[lo:hi][None, :]
            for i, j in forest(near & apart | ~apart):
                if joined[lo + i] != joined[lo + j]:
                    out.append((int(at[i]), int(at[j]), depth))
                    joined[joined == joined[lo + j]] = joined[lo + i]  # also outside of this run
    return out


def candidate_edges(nodes: DataFrame, classes: DataFrame, threshold: float, depths: range) -> DataFrame:
    """Edges (a, b, depth) between texts of one node (key, tree, node, comp) that were not joined before."""
    comp = F.xxhash64("comp")
    met = paired_blocks(nodes, "node", F.count(F.lit(1)) / NODE_BLOCK, F.min(comp) < F.max(comp)).join(
        classes.select("key", "sig"), "key")
    least = least_agreement(threshold)

    def run(table: pa.Table) -> pa.Table:
        sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint32).reshape(table.num_rows, -1)
        across = table["bi"][0] != table["bj"][0]
        numbers: dict[bytes, int] = {}
        joined = np.array([numbers.setdefault(c, len(numbers)) for c in table["comp"].to_pylist()])
        edges = descend(sig, joined, table["b"].to_numpy() if across else None, table["tree"][0].as_py(), depths, least)
        keys = table["key"].to_pylist()
        return pa.table([pa.array([keys[i] for i, _, _ in edges], pa.binary()),
                         pa.array([keys[j] for _, j, _ in edges], pa.binary()),
                         pa.array([d for _, _, d in edges], pa.int32())], ["a", "b", "depth"])

    return met.select("node", "tree", "bi", "bj", "b", "key", "comp", "sig").groupBy("node", "bi", "bj").applyInArrow(
        run, "a binary, b binary, depth int")


def candidates(classes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Components (key, label) of what meets and agrees, and the edges (a, b, depth) that join them."""
    e = written(entries(classes, threshold))
    edges = tied = labels = None
    longer = LABEL + 1
    first = F.col("tree") < FIRST_TREES
    for depth, trees in [(LABEL, first), (LABEL, ~first), *[(d, F.lit(True)) for d in steps(threshold)[1:]]]:
        nodes = e.where(trees & F.col(f"n{depth}").isNotNull()).select("key", "tree", F.col(f"n{depth}").alias("node"))
        nodes = nodes.withColumn("comp", F.col("key")) if labels is None else nodes.join(
            labels.withColumnRenamed("label", "comp"), "key", "left").withColumn("comp", F.coalesce("comp", "key"))
        new = written(candidate_edges(nodes, classes, threshold, range(max(longer - 1, depth), depth - 1, -1)))
        longer = depth
        edges = new if edges is None else edges.union(new)
        met = new.select("a", "b")
        if tied is not None:
            met = met.union(tied.select(F.col("u").alias("a"), F.col("v").alias("b")))
        if depth > shortest_prefix(threshold):  # labels may lag behind: a node is then closed later, none too early
            tied = contracted(met, ROUNDS)
            labels = least_keys(tied)
    return written(components(met)), edges


def contracted(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """Edges (u < v) of the same components, drawn towards their least keys; stars at the end.

    Large-star and small-star steps by turns, until nothing changes or for some rounds; a round
    is written to the shared folder, and whether it changed anything is observed on that write.
    The stars are min-aggregates and joins on the vertex, so a hub's edges are never gathered.
    """
    h = F.xxhash64("u", "v")

    def kept(e: DataFrame) -> tuple[DataFrame, dict]:
        seen = Observation()
        e = written(e.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"),
                              F.sum(F.shiftright(h, 20)).alias("s")))
        return e, seen.get

    e = edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u < v").distinct()
    before, done = None, 0
    while done != rounds:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, F.col("u") == F.col("w")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # every edge now points from the larger to the smaller key
        small = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        e, at = kept(large.join(small, F.col("u") == F.col("w")).select(
            F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("m").alias("y")),
                              F.struct(F.col("v").alias("x"), F.col("m").alias("y")))).alias("p")).select(
            F.least("p.x", "p.y").alias("u"), F.greatest("p.x", "p.y").alias("v")).where("u < v").distinct())
        if at == before or not at["n"]:  # the same set of edges, known by its size and two sums of hashes
            break
        before, done = at, done + 1
    return e


def least_keys(e: DataFrame) -> DataFrame:
    """key, label: the least key that an edge (u < v) ties it to, itself included."""
    return e.select(F.col("v").alias("key"), F.col("u").alias("label")).union(
        e.select(F.col("u").alias("key"), F.col("u").alias("label"))).groupBy("key").agg(F.min("label").alias("label"))


def components(edges: DataFrame) -> DataFrame:
    """key, label (the least key of its component) of every key that has an edge."""
    return least_keys(contracted(edges))


def similar(sets: list[np.ndarray], threshold: float, chunk: int = 8192) -> np.ndarray:
    """Which sets have at least the threshold's Jaccard similarity (exact, in whole numbers)."""
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    value, at, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(many > 1) - 1  # elements of one set alone need no column
    keep = many[at] > 1
    row, col = np.repeat(np.arange(n), sizes)[keep], shared[at[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    common = np.zeros((n, n))
    last = int(col[-1]) + 1 if len(col) else 0
    for lo in range(0, last, chunk):
        a, b = np.searchsorted(col, [lo, lo + chunk])
        part = np.zeros((n, min(chunk, last - lo)), np.float32)
        part[row[a:b], col[a:b] - lo] = 1
        common += part @ part.T
    common = np.rint(common).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    return common * 1_000_000 >= int(round(threshold * 1_000_000)) * union


def verified(docs: DataFrame, classes: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """Rows key, links (texts linked to it, from one task) and key, other (a spanning edge)."""
    wanted = classes.join(labels, "key").select("key", "label", "size", F.col("rep.doc_id").alias("_id"), F.col("rep.h").alias("_h"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("h"), "text").join(
        wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h"))).dropDuplicates(["key"])

    def sets(batches):
        for b in batches:
            t = [x or "" for x in b.column("text").to_pylist()]
            out = []
            for lo, hi in batches_by_size(t, 1 << 21):
                hashes, n = shingles.windows(*shingles.words(t[lo:hi]), WIDTH)
                out += [np.unique(x).tobytes() for x in np.split(hashes, np.cumsum(n)[:-1])]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.binary())], ["key", "label", "size", "set"])

    held = texts.select("key", "label", "size", "text").mapInArrow(sets, "key binary, label binary, size long, set binary")
    # two blocks' sets and what comparing them takes must fit a task: few texts, few bytes
    blocks = paired_blocks(held, "label", F.greatest(F.count(F.lit(1)) / SET_BLOCK, F.sum(F.length("set")) / SET_BYTES),
                           F.count(F.lit(1)) > 1)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        near = _across(pdf, similar([np.frombuffer(s, np.uint64) for s in pdf["set"]], threshold))
        keys, size = pdf["key"].tolist(), pdf["size"].to_numpy()
        links = (near * size[None, :]).sum(1)
        edges = forest(near)
        hit = np.flatnonzero(links)
        return pd.DataFrame({"key": [keys[i] for i in hit] + [keys[i] for i, _ in edges],
                             "links": links[hit].tolist() + [0] * len(edges),
                             "other": [None] * len(hit) + [keys[j] for _, j in edges]}, columns=["key", "links", "other"])

    return blocks.select("label", "bi", "bj", "b", "key", "size", "set").groupBy("label", "bi", "bj").applyInPandas(
        run, "key binary, links long, other binary")


def classify(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row per input row: doc_id, h, key, class_id, class_h, n_links, n_copies.

    class_id: the least doc_id of the near-duplicate group (linked directly or by others);
    (class_id, class_h) names one document of it. n_links: how many other rows have a Jaccard
    similarity of the threshold or more, copies included; n_copies: rows with the same words.
    A text of under five words is one shingle; NULL and empty texts have no words and are
    copies of each other. A doc_id given to several texts counts for each. Empty table: empty
    result.
    """
    signed = written(sign(docs))
    classes = written(signed.groupBy("key").agg(
        F.min(F.struct("doc_id", "h")).alias("rep"), F.count(F.lit(1)).alias("size"),
        F.first("sig").alias("sig"), F.first("windows").alias("windows")))  # equal words, equal signature
    labels, _ = candidates(classes, threshold)
    found = written(verified(docs, classes, labels, threshold))
    links = found.where("other is null").groupBy("key").agg(F.sum("links").alias("links"))
    groups = components(found.where("other is not null").select(F.col("key").alias("a"), F.col("other").alias("b")))
    groups = written(groups)
    first = groups.join(classes.select("key", "rep"), "key").groupBy("label").agg(F.min("rep").alias("first"))
    info = classes.select("key", "rep", "size").join(groups, "key", "left").join(first, "label", "left").join(links, "key", "left")
    info = info.select("key", F.coalesce("first", "rep").alias("class"), F.col("size").alias("n_copies"),
                       (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    return signed.select("doc_id", "h", "key").join(info, "key").select(
        "doc_id", "h", "key", F.col("class.doc_id").alias("class_id"), F.col("class.h").alias("class_h"), "n_links", "n_copies")


def keep_one(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The documents, one of each near-duplicate group: the one with the least doc_id.

    Columns and their values are kept as they are. NULL, empty and white texts are copies of each
    other, so one of them stays, as does one of repeated rows; of rows that agree in doc_id and
    text, the one whose other columns have the least hash. Empty table: empty result.
    """
    kept = classify(docs, threshold).select(F.col("class_id").alias("_id"), F.col("class_h").alias("_h")).distinct()
    d = docs.select(F.struct("*").alias("_row"), "doc_id", F.xxhash64("text").alias("_t"),
                    content(docs, "doc_id", "text").alias("_o"))
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_h"))
    return d.join(kept, on, "left_semi").groupBy("doc_id", "_t").agg(F.min_by("_row", "_o").alias("_row")).select("_row.*")
