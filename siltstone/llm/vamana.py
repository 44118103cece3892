"""Approximate nearest neighbours by robust-pruned directed graphs.

The distinct vectors are dealt to shards of a fixed size. In each shard a directed graph is
built: a greedy search for the point proposes neighbours, and pruning keeps a candidate only if
no kept neighbour is closer to it by the factor ``alpha`` (so edges are diverse and long ones
survive); edges are mirrored and full lists pruned again. Blocks of queries go to every shard,
where a beam search walks the graph; the shards' answers are merged by exact distance.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import written

#: Vectors of a shard, out-edges, beam width of building and of searching, relaxed pruning.
SHARD, DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA = 8192, 32, 64, 96, 1.2
#: Points inserted together; bytes of the queries of a block, against which a shard's copy is small.
BATCH, QUERY_BYTES = 256, 1 << 25
#: Entry points spread over a shard, and edges of each point that no pruning takes away.
ENTRIES, FIXED = 64, 2


def _sq(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of each row of x to its own rows of y (b, m, d)."""
    d = y - x[:, None, :]
    return np.einsum("bmd,bmd->bm", d, d)


def beam_search(vectors: np.ndarray, graph: np.ndarray, entry: np.ndarray, queries: np.ndarray,
                beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest points met by each query, nearest first: ids (-1: none) and squared distances.

    graph: out-neighbours of each point, -1 where there are fewer. All queries of the call
    expand their nearest unexpanded beam entry in the same step, until none has one.
    """
    b, n = len(queries), len(vectors)
    ids = np.full((b, beam), -1, np.int64)
    dist = np.full((b, beam), np.inf, vectors.dtype)
    done = np.ones((b, beam), bool)
    seen = np.zeros((b, n), bool)
    m = len(entry)
    d0 = _sq(queries, np.broadcast_to(vectors[entry], (b, m, vectors.shape[1])))
    order = np.argsort(d0, axis=1, kind="stable")[:, :beam]
    k = order.shape[1]
    ids[:, :k], dist[:, :k], done[:, :k] = entry[order], np.take_along_axis(d0, order, 1), False
    seen[:, entry] = True
    live = np.arange(b)
    while len(live):
        first = np.argmin(done[live], axis=1)  # the beam is sorted: the nearest not expanded
        open_ = ~done[live, first]
        live, first = live[open_], first[open_]
        if not len(live):
            break
        done[live, first] = True
        near = graph[ids[live, first]]
        new = (near >= 0) & ~seen[live[:, None], near]
        seen[np.repeat(live, new.sum(1)), near[new]] = True
        d = np.where(new, _sq(queries[live], vectors[near]), np.inf).astype(vectors.dtype)
        all_d = np.concatenate([dist[live], d], axis=1)
        all_i = np.concatenate([ids[live], near], axis=1)
        all_k = np.concatenate([done[live], ~new], axis=1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        dist[live] = np.take_along_axis(all_d, order, 1)
        ids[live] = np.take_along_axis(all_i, order, 1)
        done[live] = np.take_along_axis(all_k, order, 1) | ~np.isfinite(dist[live])
    ids[~np.isfinite(dist)] = -1
    return ids, dist


def robust_prune(vectors: np.ndarray, points: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to ``degree`` diverse neighbours of each point from its candidates (-1: none).

    The nearest candidate left is kept, and those are dropped that are closer to it, by the
    factor alpha, than to the point.
    """
    b, m = cand.shape
    valid = (cand >= 0) & (cand != points[:, None])
    s = np.sort(np.where(valid, cand, -1), axis=1)
    s[:, 1:][s[:, 1:] == s[:, :-1]] = -1
    c = vectors[s] - vectors[points][:, None, :]  # from the point: no cancellation among close points
    d = np.where(s >= 0, np.einsum("bmd,bmd->bm", c, c), np.inf)
    order = np.argsort(d, axis=1, kind="stable")
    s, d = np.take_along_axis(s, order, 1), np.take_along_axis(d, order, 1)
    c = np.take_along_axis(c, order[:, :, None], 1)
    norm = np.einsum("bmd,bmd->bm", c, c)
    between = norm[:, :, None] + norm[:, None, :] - 2 * np.matmul(c, c.transpose(0, 2, 1))
    alive = np.isfinite(d)
    out = np.full((b, degree), -1, np.int64)
    rows = np.arange(b)
    for k in range(degree):
        pick = np.argmax(alive, axis=1)
        has = alive[rows, pick]
        if not has.any():
            break
        out[has, k] = s[has, pick[has]]
        alive[rows, pick] = False
        alive &= ~((alpha * alpha * between[rows, pick] <= d) & has[:, None])
    return out


def scaled(vectors: np.ndarray) -> tuple[np.ndarray, float]:
    """The vectors times a power of two that brings the largest component near one, and that
    power: in single precision, or in double if the smallest vectors would vanish there."""
    size = np.abs(vectors).max(axis=1)
    power = 2.0 ** -np.floor(np.log2(size.max()))
    out = vectors * power
    return (out if size.min() * power < 2.0**-40 else out.astype(np.float32)), power


def spread_points(vectors: np.ndarray, count: int) -> np.ndarray:
    """The point nearest the middle, then each time the one farthest from those taken: every
    well separated group gets one."""
    at = int(np.argmin(((vectors - vectors.mean(0)) ** 2).sum(1)))
    far, out = np.full(len(vectors), np.inf), []
    while len(out) < min(count, len(vectors)) and far[at] > 0:
        out.append(at)
        far = np.minimum(far, ((vectors - vectors[at]) ** 2).sum(1))
        at = int(np.argmax(far))
    return np.array(out)


def reached_from(graph: np.ndarray, start: np.ndarray, reached: np.ndarray) -> np.ndarray:
    """Marks what can be walked to from the start in ``reached``, and returns it."""
    todo = start[~reached[start]]
    reached[todo] = True
    while len(todo):
        near = graph[todo]
        near = np.unique(near[near >= 0])
        todo = near[~reached[near]]
        reached[todo] = True
    return reached


def with_all_reached(vectors: np.ndarray, graph: np.ndarray, entry: np.ndarray, least: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Entries and edges added until every point can be walked to from an entry: a part of
    ``least`` points or more gets an entry of its own, a smaller one an edge from the nearest
    reached point."""
    reached = reached_from(graph, entry, np.zeros(len(graph), bool))
    while not reached.all():
        u = int(np.argmin(reached))
        part = reached_from(graph, np.array([u]), reached.copy()) & ~reached
        if part.sum() >= least:
            entry = np.append(entry, u)
        else:
            known = np.flatnonzero(reached)
            from_ = known[np.argmin(((vectors[known] - vectors[u]) ** 2).sum(1))]
            free = np.flatnonzero(graph[from_] < 0)
            if not len(free):
                graph = np.hstack([graph, np.full((len(graph), 1), -1, np.int64)])
                free = [graph.shape[1] - 1]
            graph[from_, free[0]] = u
        reached |= part
    return graph, np.sort(entry)


def build_graph(vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA,
                batch: int = BATCH, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Out-neighbours of every point and the entry points of a search.

    Two passes over the points in random order, the first with alpha 1; points of a batch are
    searched in the graph as it stood before the batch. Entries are spread over the shard, and
    besides its pruned edges each point keeps ``FIXED`` random ones, so that groups far apart
    are found while building and in a search. At the end nothing is left that the pruned edges
    alone do not reach.
    """
    n = len(vectors)
    rng = np.random.default_rng(seed)
    entry = spread_points(vectors, ENTRIES)
    graph = np.full((n, degree), -1, np.int64)
    start = rng.permutation(n)
    fixed = np.full((n, min(FIXED, n - 1)), -1, np.int64)
    for k in range(fixed.shape[1]):
        fixed[start, k] = np.roll(start, k + 1)
    for k in range(min(4, degree, n - 1)):  # a sparse random start
        graph[start, k] = np.roll(start, k + 1)
    for a in (1.0, alpha):
        order = rng.permutation(n)
        for i in range(0, n, batch):
            p = order[i:i + batch]
            found, _ = beam_search(vectors, np.hstack([graph, fixed]), entry, vectors[p], beam)
            graph[p] = robust_prune(vectors, p, np.concatenate([found, graph[p]], axis=1), degree, a)
            _mirror(vectors, graph, p, degree, a)
    graph, entry = with_all_reached(vectors, graph, entry)
    return np.hstack([graph, fixed]), entry


def _mirror(vectors: np.ndarray, graph: np.ndarray, points: np.ndarray, degree: int, alpha: float) -> None:
    """Adds q -> p for every new edge p -> q; lists that overflow are pruned again."""
    to = graph[points]
    ok = to >= 0
    src, dst = np.repeat(points, ok.sum(1)), to[ok]
    order = np.argsort(dst, kind="stable")
    src, dst = src[order], dst[order]
    heads = np.flatnonzero(np.append(True, dst[1:] != dst[:-1])) if len(dst) else np.zeros(0, int)
    q, counts = dst[heads], np.diff(np.append(heads, len(dst)))
    for lo in range(0, len(q), 512):
        part, many = q[lo:lo + 512], counts[lo:lo + 512]
        extra = np.full((len(part), many.max()), -1, np.int64)
        place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        begin = heads[lo]
        extra[np.repeat(np.arange(len(part)), many), place] = src[begin:begin + many.sum()]
        have = graph[part]
        known = (extra[:, :, None] == have[:, None, :]).any(2)
        extra[known] = -1
        both = np.concatenate([have, extra], axis=1)
        room = (both >= 0).sum(1) <= degree
        packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, :degree]
        graph[part[room]] = packed[room]
        if (~room).any():
            graph[part[~room]] = robust_prune(vectors, part[~room], both[~room], degree, alpha)


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id and its vector, once each, without vectors that are null, zero or not finite."""
    v = F.col(vector)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return df.select(F.col(key).cast("long").alias("vec_id"), v.cast("array<double>").alias("vector")).where(
        F.col(key).isNotNull() & v.isNotNull() & good).distinct()


def build_index(df: DataFrame, key: str = "vec_id", vector: str = "embedding", keep: int = 11,
                shard: int = SHARD) -> DataFrame:
    """The index, one row per distinct vector: shard, node, vec_ids, vector, edges, entry.

    Equal vectors are one node; of its vec_ids the ``keep`` smallest are kept (a search for
    ``keep - 1`` neighbours cannot need more), chosen before anything is gathered. Vectors of
    different length never meet: a shard holds one length.
    """
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    node = usable(df, key, vector).withColumn("_n", F.row_number().over(smallest)).where(F.col("_n") <= keep).groupBy(
        "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("vec_ids"))
    nodes = written(node)
    lengths = nodes.groupBy(F.size("vector").alias("dim")).agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / shard)).alias("shards"))
    dealt = nodes.withColumn("dim", F.size("vector")).join(lengths, "dim").withColumn(
        "shard", F.pmod(F.xxhash64("vector"), F.col("shards")))
    # A shard is little data but much work: a partition each, which must not be merged by size.
    parts = 2 * max(1, -(-nodes.count() // shard))
    schema = "dim int, shard long, node int, vec_ids array<long>, vector array<double>, edges array<int>, entry boolean"

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("vec_ids", key=lambda s: s.map(lambda x: x[0]), ignore_index=True)
        graph, entry = build_graph(scaled(np.stack(group["vector"].to_numpy()))[0])
        return pd.DataFrame({"dim": group["dim"], "shard": group["shard"], "node": np.arange(len(group)),
                             "vec_ids": group["vec_ids"], "vector": group["vector"],
                             "edges": [np.unique(e[e >= 0]).astype(np.int32) for e in graph],
                             "entry": np.isin(np.arange(len(group)), entry)})

    return dealt.select("dim", "shard", "vec_ids", "vector").repartition(parts, "dim", "shard").groupBy(
        "dim", "shard").applyInPandas(run, schema)


def search(index: DataFrame, queries: DataFrame, k: int = 10, beam: int = SEARCH_BEAM,
           block_bytes: int = QUERY_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest found, but for its own vec_id.

    queries: vec_id and vector; a vec_id with several vectors asks with the smallest. Distance
    is Euclidean in double precision on the original vectors; ties go to the smaller vec_id.
    The index is given to each block of queries, so a task holds one shard and one block; a
    block's queries are many times a shard's bytes, so the queries are what moves.
    """
    asked = queries.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    size = asked.agg(F.sum(8 * F.size("vector"))).first()[0] or 0
    asked = asked.withColumn("block", F.pmod(F.xxhash64(F.lit(3), F.col("vec_id")), F.lit(max(1, -(-size // block_bytes)))))
    shards = index.select("dim", "shard").distinct()
    places = shards.groupBy("dim").agg(F.max("shard").alias("last"))
    blocks = asked.select("block", F.size("vector").alias("dim")).distinct()
    to = asked.withColumn("dim", F.size("vector")).join(places, "dim").withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
    held = index.join(blocks, "dim")
    to = to.select(F.col("dim").alias("q_dim"), F.col("shard").alias("q_shard"), F.col("block").alias("q_block"),
                   "vec_id", "vector")
    schema = "query_id long, vec_id long, d2 double"

    def run(nodes: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if not len(nodes) or not len(asks):
            return pd.DataFrame({"query_id": [], "vec_id": [], "d2": []})
        nodes = nodes.sort_values("node", ignore_index=True)
        vectors = np.stack(nodes["vector"].to_numpy())
        graph = np.full((len(nodes), max(1, int(nodes["edges"].map(len).max()))), -1, np.int64)
        for i, e in enumerate(nodes["edges"]):
            graph[i, :len(e)] = e
        entry = np.flatnonzero(nodes["entry"].to_numpy())
        held, power = scaled(vectors)
        out = []
        for lo in range(0, len(asks), BATCH):
            part = asks.iloc[lo:lo + BATCH]
            wanted = np.stack(part["vector"].to_numpy())
            # Queries of quite another size than the shard's vectors walk in double precision.
            far = np.abs(wanted).max() * power > 2.0**40
            walked = vectors * power if far and held.dtype == np.float32 else held
            found, _ = beam_search(walked, graph, entry, (wanted * power).astype(walked.dtype), beam)
            found = found[:, :3 * (k + 1)]
            exact = _sq(wanted.astype(np.float64), vectors[found].astype(np.float64))
            for q, ids, d in zip(part["vec_id"], found, exact, strict=True):
                own = [(float(x), int(v)) for i, x in zip(ids, d, strict=True) if i >= 0 for v in nodes["vec_ids"][i] if v != q]
                out += [(q, v, x) for x, v in sorted(own)[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "d2"])

    found = held.groupBy("dim", "shard", "block").cogroup(to.groupBy("q_dim", "q_shard", "q_block")).applyInPandas(run, schema)
    found = found.groupBy("query_id", "vec_id").agg(F.min("d2").alias("d2"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("d2", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", F.sqrt("d2").alias("score"))


def nearest(df: DataFrame, every: int = 100, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest of each vector whose id is divisible by ``every``, among all others.

    Vectors null, zero or with null or non-finite components neither ask nor answer; equal
    rows count once; an empty table gives an empty result; other columns are ignored.
    """
    index = written(build_index(df, key, vector, k + 1))
    queries = usable(df.where(F.col(key) % every == 0), key, vector)
    return search(index, written(queries), k)
