"""Approximate nearest neighbours by inner product over robust-pruned directed graphs.

Vectors are dealt into bands of nearly equal length (up to the factor BAND), and those over shards of bounded
size by a hash. Each shard is one graph over the directions of its vectors: greedy searches from the entry point
propose neighbours for a batch of new nodes, pruning keeps a neighbour only if no kept one is closer to it by
the factor ALPHA, and edges back are pruned the same way. Searches walk a beam through every shard for whole blocks
of queries at once; what the beams find is ranked by exact products. Data and queries lie on the same sphere, and in a
band the order by direction is nearly that by product, so walks are as good for vectors of unequal
lengths as for unit vectors.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.llm.common import stored

SHARD_ROWS = 16_384
SHARD_BYTES = 64 << 20
DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA = 32, 64, 128, 1.2
#: Longest by shortest vector of a band. Doubles have some ten thousand bands.
BAND = 1.15
#: Tasks that build shards at most; fewer shards have a task each.
BUILDERS = 10_000
BATCH = 512
QUERY_BLOCK = 512  # queries that walk in step
QUERY_ROWS = 16_384  # queries that one task holds


def directions(x: np.ndarray) -> np.ndarray:
    """Vectors of length one; none of the given ones is zero."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


@F.arrow_udf(T.IntegerType())
def band_of(vectors: pa.Array) -> pa.Array:
    """Number of the band that a vector's length lies in; vectors are not empty and not zero."""
    if not len(vectors):
        return pa.array([], pa.int32())
    sizes = np.diff(vectors.offsets.to_numpy())
    flat, starts = vectors.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes
    largest = np.maximum.reduceat(np.abs(flat), starts)
    ratio = np.sqrt(np.add.reduceat((flat / np.repeat(largest, sizes)) ** 2, starts))
    return pa.array(np.floor((np.log(largest) + np.log(ratio)) / np.log(BAND) + 0.5).astype(np.int32))


def beam_search(x: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, distances) [queries, beam] nearest found by greedy walks, all queries in step; -1 where fewer."""
    q = len(queries)
    nodes = np.full((q, beam), -1, np.int32)
    dist = np.full((q, beam), np.inf, np.float32)
    done = np.ones((q, beam), bool)
    nodes[:, 0], done[:, 0] = entry, False
    dist[:, 0] = ((x[entry] - queries) ** 2).sum(1)
    seen = np.zeros((q, len(x)), bool)
    seen[:, entry] = True
    active = np.arange(q)
    while len(active):
        open_dist = np.where(done[active], np.inf, dist[active])
        pick = open_dist.argmin(1)
        going = np.isfinite(open_dist[np.arange(len(active)), pick])
        active, pick = active[going], pick[going]
        if not len(active):
            break
        done[active, pick] = True
        near = graph[nodes[active, pick]]  # [active, degree]
        fresh = (near >= 0) & ~seen[active[:, None], np.maximum(near, 0)]
        who, col = np.nonzero(fresh)
        found = near[who, col]
        seen[active[who], found] = True
        d = np.full(near.shape, np.inf, np.float32)
        gap = x[found] - queries[active[who]]
        d[who, col] = np.einsum("ij,ij->i", gap, gap)
        all_d = np.concatenate([dist[active], d], axis=1)
        all_n = np.concatenate([nodes[active], np.where(np.isfinite(d), near, -1)], axis=1)
        all_done = np.concatenate([done[active], ~np.isfinite(d)], axis=1)
        best = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        dist[active] = np.take_along_axis(all_d, best, 1)
        nodes[active] = np.take_along_axis(all_n, best, 1)
        done[active] = np.take_along_axis(all_done, best, 1)
    return nodes, dist


def robust_prune(x: np.ndarray, points: np.ndarray, cands: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """[points, degree] neighbours kept of the candidates (-1: none): the nearest first, and then only
    those to which no kept one is nearer by the factor `alpha`."""
    safe = np.maximum(cands, 0)
    vec = x[safe]
    gap = vec - x[points][:, None]
    d = np.einsum("ijk,ijk->ij", gap, gap)
    d[(cands < 0) | (cands == points[:, None])] = np.inf
    out = np.full((len(points), degree), -1, np.int32)
    rows = np.arange(len(points))
    norm = np.einsum("ijk,ijk->ij", vec, vec)
    for k in range(degree):
        pick = d.argmin(1)
        some = np.isfinite(d[rows, pick])
        if not some.any():
            break
        out[rows[some], k] = cands[rows[some], pick[some]]
        star = vec[rows, pick]
        to_star = norm + norm[rows, pick][:, None] - 2 * np.einsum("ijk,ik->ij", vec, star)
        d[(alpha * alpha * to_star <= d) & some[:, None]] = np.inf
        d[rows, pick] = np.inf
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 5) -> tuple[np.ndarray, int]:
    """(graph [nodes, degree], entry): batches of doubling size up to BATCH are inserted into what stands."""
    n = len(x)
    graph = np.full((n, degree), -1, np.int32)
    entry = int(((x - x.mean(0)) ** 2).sum(1).argmin()) if n else 0
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[entry], order[order != entry]]).astype(np.int32) if n else order
    at, size = 1, 1
    while at < n:
        new = order[at : at + size]
        nodes, _ = beam_search(x, graph, entry, x[new], beam)
        if len(new) > 1:  # nodes of one batch may be each other's neighbours
            peers = np.broadcast_to(new[np.random.default_rng(at).integers(0, len(new), (len(new), 8))], (len(new), 8))
            nodes = np.concatenate([nodes, peers], axis=1)
        graph[new] = robust_prune(x, new, nodes, degree, alpha)
        add_back(x, graph, new, degree, alpha)
        at += len(new)
        size = min(BATCH, size * 2)
    return graph, entry


def add_back(x: np.ndarray, graph: np.ndarray, new: np.ndarray, degree: int, alpha: float) -> None:
    """Edges back from the neighbours of new nodes; a node that then has too many is pruned."""
    src = np.repeat(new, degree)
    dst = graph[new].ravel()
    src, dst = src[dst >= 0], dst[dst >= 0]
    order = np.argsort(dst, kind="stable")
    src, dst = src[order], dst[order]
    targets, first, count = np.unique(dst, return_index=True, return_counts=True)
    for lo in range(0, len(targets), BATCH):
        t, f, c = targets[lo : lo + BATCH], first[lo : lo + BATCH], count[lo : lo + BATCH]
        width = int(c.max())
        take = np.minimum(f[:, None] + np.arange(width), len(src) - 1)
        extra = np.where(np.arange(width) < c[:, None], src[take], -1)
        extra = np.where((graph[t][:, :, None] == extra[:, None, :]).any(1), -1, extra)
        free = (graph[t] >= 0).sum(1) + (extra >= 0).sum(1) <= degree
        for i in np.flatnonzero(free):
            got = graph[t[i]]
            add = extra[i][extra[i] >= 0]
            k = int((got >= 0).sum())
            got[k : k + len(add)] = add
        over = np.flatnonzero(~free)
        if len(over):
            cands = np.concatenate([graph[t[over]], extra[over]], axis=1)
            for a in range(0, len(over), 64):  # candidate rows of one hub may be wide
                graph[t[over[a : a + 64]]] = robust_prune(x, t[over[a : a + 64]], cands[a : a + 64], degree, alpha)


def pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as z:
        return {k: z[k] for k in z.files}


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, v): rows with an id whose vector is not null or empty, has no null or non-finite component and is not zero."""
    v = F.col("v")
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
    return rows.where(~F.exists(v, bad) & F.exists(v, lambda c: c != 0))


def build_index(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(dim, band, shard, data): one stored row per shard, every usable vector in exactly one of them.

    Vectors of different dimensions are indexed apart: their product is not defined. Rows that repeat
    both id and vector count once.
    """
    rows = usable(vectors, vec_id, embedding).withColumn("dim", F.size("v"))
    rows = rows.withColumn("band", band_of("v"))
    per = F.greatest(F.lit(256), F.least(F.lit(shard_rows), F.floor(F.lit(SHARD_BYTES) / (F.col("dim") * 8))))
    groups = rows.groupBy("dim", "band").agg(F.count(F.lit(1)).alias("n"))
    groups = stored(groups.select("dim", "band", F.ceil(F.col("n") / per).alias("shards")), "ann-bands")  # a row per dimension and band
    rows = rows.join(F.broadcast(groups), ["dim", "band"]).withColumn("shard", F.pmod(F.xxhash64("id", "v"), "shards"))
    builders = max(1, min(BUILDERS, groups.agg(F.sum("shards")).first()[0] or 0))
    keys = ["dim", "band", "shard"]

    def build(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        v = np.stack(p["v"].to_numpy()).astype(np.float64)
        ids = p["id"].to_numpy(np.int64)
        order = np.lexsort((ids,))
        v, ids = v[order], ids[order]
        nodes, node_of = np.unique(v, axis=0, return_inverse=True)  # equal vectors are one node
        node_of = node_of.ravel()
        by_node = np.argsort(node_of, kind="stable")  # the ids of a node in ascending order
        starts = np.searchsorted(node_of[by_node], np.arange(len(nodes) + 1))
        keep = np.ones(len(ids), bool)
        grouped = ids[by_node]
        keep[1:] = (grouped[1:] != grouped[:-1]) | (node_of[by_node][1:] != node_of[by_node][:-1])
        starts = np.concatenate([[0], np.cumsum(keep)])[starts]
        graph, entry = build_graph(directions(nodes))
        data = pack(nodes=nodes, ids=grouped[keep], starts=starts, graph=graph, entry=np.array(entry))
        return pd.DataFrame({"dim": [key[0]], "band": [key[1]], "shard": [key[2]], "data": [data]})

    # a number of partitions of one's own, which adaptive execution doesn't merge: each shard is long work
    dealt = rows.select(*keys, "id", "v").repartition(builders, *keys)
    return stored(dealt.groupBy(*keys).applyInPandas(build, "dim int, band int, shard long, data binary"), "ann-index")


def search(index: DataFrame, queries: DataFrame, k: int = 20, beam: int = SEARCH_BEAM, query_id: str = "vec_id",
           embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found, never the id of the query itself.

    Scores are inner products in double precision of the original vectors; ties go to the smaller id.
    A query finds vectors of its own length only; queries without a usable vector are left out.
    Repeated queries with one id and vector count once.
    """
    asked = usable(queries, query_id, embedding).dropDuplicates(["id", "v"]).withColumn("dim", F.size("v"))
    blocks = max(1, -(-asked.count() // QUERY_ROWS))  # a shard goes once to each block: some seconds of walks for its bytes
    shards = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    fresh = index.select(F.col("dim").alias("dim"), F.col("band").alias("band"), "shard")  # the index is on both sides
    bands = fresh.groupBy("dim", "band").agg((F.max("shard") + 1).alias("shards"))  # a row per dimension and band
    asked = asked.join(F.broadcast(bands), "dim").withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))

    def walk(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})]
        if len(left) and len(right):
            s = unpack(right["data"].iat[0])
            x = directions(s["nodes"])
            for at in range(0, len(left), QUERY_BLOCK):
                part = left.iloc[at : at + QUERY_BLOCK]
                q = np.stack(part["v"].to_numpy()).astype(np.float64)
                nodes, _ = beam_search(x, s["graph"], int(s["entry"]), directions(q), max(beam, k + 1))
                out.append(best_of(s, part["id"].to_numpy(np.int64), q, nodes, k))
        return pd.concat(out, ignore_index=True)

    keys = ["dim", "band", "shard", "block"]
    found = asked.select(*keys, "id", "v").groupBy(*keys).cogroup(shards.groupBy(*keys)).applyInPandas(walk, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def best_of(s: dict, ids: np.ndarray, q: np.ndarray, nodes: np.ndarray, k: int) -> pd.DataFrame:
    """The k best vectors behind the nodes found for each query, by exact products."""
    out_q, out_id, out_s = [], [], []
    for i in range(len(q)):
        found = nodes[i][nodes[i] >= 0]
        scores = (s["nodes"][found] * q[i]).sum(1)
        order = np.argsort(-scores, kind="stable")
        got, score = [], []
        level = None
        for o in order:
            if len(got) > k and scores[o] != level:  # one more than k: the query itself may be among them
                break
            own = s["ids"][s["starts"][found[o]] : s["starts"][found[o] + 1]][: k + 1]
            got.extend(own.tolist())
            score.extend([scores[o]] * len(own))
            level = scores[o]
        got, score = np.array(got, np.int64), np.array(score)
        other = got != ids[i]
        got, score = got[other], score[other]
        top = np.lexsort((got, -score))[:k]
        out_q.append(np.full(len(top), ids[i]))
        out_id.append(got[top])
        out_s.append(score[top])
    return pd.DataFrame({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_id), "score": np.concatenate(out_s)})
