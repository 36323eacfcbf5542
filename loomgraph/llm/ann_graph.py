"""Approximate nearest neighbours by robustly pruned directed graphs.

Vectors are cut into shards of bounded size by id hash. In each shard a
directed graph is built by inserting vectors in growing batches: a greedy beam
search over the graph so far proposes neighbours, and pruning keeps, nearest
first, those that no kept neighbour is ``alpha`` times closer to (the relaxed
rule that leaves some long edges). Edges are added backwards too, and a list
that overflows is pruned again. A query runs a beam search in every shard; the
best of all shards, scored in double precision on the original vectors, win.

The query set is stated by the caller. Queries go to the shards as plain rows,
sorted behind the shard's stored graph, and stream past it; the graph is sent
once for every ``ASKS`` queries. Queries advance ``TOGETHER``, so a step of the
search is a few array operations.

Equal vectors are indexed once and carry their smallest ids, as many as a
result can need: of equal vectors only those can be among the nearest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgraph.session import materialize

TOGETHER = 256  # searches that advance together
EXPAND = 4      # beam entries expanded in a step
ASKS = 1 << 16  # queries that meet a shard in one task, about


def beam_search(x: np.ndarray, graph: np.ndarray, start: int, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Node numbers and similarities of the ``beam`` best nodes found for each
    row of ``q``, best first (-1 where fewer were reached)."""
    n = len(q)
    rows = np.arange(n)[:, None]
    seen = np.zeros((n, len(x) + 1), bool)  # the last column stands for "no node"
    seen[:, [start, len(x)]] = True
    node = np.full((n, beam), -1, np.int32)
    sim = np.full((n, beam), -np.inf, np.float32)
    done = np.ones((n, beam), bool)
    node[:, 0], sim[:, 0], done[:, 0] = start, q @ x[start], False
    while True:
        open_ = np.where(done, -np.inf, sim)
        best = np.argpartition(-open_, min(EXPAND, beam) - 1, axis=1)[:, :EXPAND]
        able = np.take_along_axis(open_, best, 1) > -np.inf
        live = np.flatnonzero(able.any(axis=1))
        if not len(live):
            return node, sim
        r = rows[:len(live)]
        best, able = best[live], able[live]
        done[live[:, None], best] |= able
        near = np.where(able[:, :, None], graph[node[live[:, None], best]], -1).reshape(len(live), -1)
        near = np.where(near < 0, len(x), near)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = len(x)
        near = np.where(seen[live[:, None], near], len(x), near)
        seen[live[:, None], near] = True
        fresh = near < len(x)
        s = np.einsum("bmd,bd->bm", x[np.where(fresh, near, 0)], q[live], optimize=False)
        s = np.where(fresh, s, -np.inf).astype(np.float32)
        all_s = np.concatenate([sim[live], s], axis=1)
        all_n = np.concatenate([node[live], np.where(fresh, near, -1).astype(np.int32)], axis=1)
        all_d = np.concatenate([done[live], ~fresh], axis=1)
        top = np.argsort(-all_s, axis=1, kind="stable")[:, :beam]
        node[live], sim[live], done[live] = all_n[r, top], all_s[r, top], all_d[r, top]


def robust_prune(x: np.ndarray, own: np.ndarray, near: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to ``degree`` diverse neighbours of each node of ``own`` from its
    candidates ``near`` (-1: none)."""
    near = np.where(near == own[:, None], -1, near)
    near = np.sort(near, axis=1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
    vec = x[np.maximum(near, 0)]
    dist = np.where(near >= 0, 2 - 2 * np.einsum("bmd,bd->bm", vec, x[own]), np.inf)
    out = np.full((len(own), degree), -1, np.int32)
    rows = np.arange(len(own))
    for k in range(degree):
        best = dist.argmin(axis=1)
        able = dist[rows, best] < np.inf
        if not able.any():
            break
        out[able, k] = near[rows, best][able]
        to_best = 2 - 2 * np.einsum("bmd,bd->bm", vec, vec[rows, best])
        covered = alpha * alpha * to_best <= dist
        covered[rows, best] = True
        dist = np.where(covered & able[:, None], np.inf, dist)
    return out


def build(x: np.ndarray, degree: int, beam: int, alpha: float) -> tuple[np.ndarray, int]:
    """Graph (neighbour lists padded by -1) over unit vectors, and its entry."""
    n = len(x)
    start = int((x @ x.mean(axis=0)).argmax())
    graph = np.full((n, degree), -1, np.int32)
    order = np.random.default_rng(1).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    at = 1
    while at < n:
        batch = order[at:at + min(max(1, at), TOGETHER)]
        at += len(batch)
        found, _ = beam_search(x, graph, start, x[batch], beam)
        graph[batch] = robust_prune(x, batch, found, degree, alpha)
        to = graph[batch].ravel()
        back = np.repeat(batch, degree)[to >= 0]
        to = to[to >= 0]
        by = np.argsort(to, kind="stable")
        to, back = to[by], back[by]
        target, first, count = np.unique(to, return_index=True, return_counts=True)
        new = np.full((len(target), int(count.max(initial=0))), -1, np.int32)
        new[np.repeat(np.arange(len(target)), count), np.arange(len(to)) - np.repeat(first, count)] = back
        both = np.concatenate([graph[target], new], axis=1)
        room = (both >= 0).sum(axis=1) <= degree
        packed = np.sort(both, axis=1)[:, ::-1][:, :degree]
        graph[target[room]] = packed[room]
        full = np.flatnonzero(~room)
        for i in range(0, len(full), TOGETHER):
            some = full[i:i + TOGETHER]
            graph[target[some]] = robust_prune(x, target[some], both[some], degree, alpha)
    return graph, start


def usable(v: Column) -> Column:
    """Vectors without nulls and non-finite values that are not all zero."""
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return v.isNotNull() & ~bad & F.exists(v, lambda e: e != 0)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, shard_rows: int = 16_384, degree: int = 40,
            build_beam: int = 80, beam: int = 192, alpha: float = 1.2,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` nearest by cosine found for
    each query, all candidates if fewer; ties go to the smaller id.

    Vectors that are null, zero, or hold a null or a non-finite component and
    rows with a null id take no part. Vectors of different lengths are not
    compared. Rows repeated with the same id and vector count once; of
    different vectors under one id the smallest asks, all answer others, and
    none answers its own id. Extra columns are ignored; an empty table gives
    no rows. Every row is indexed, at any size; recall depends on ``beam``.
    """
    wide = F.transform(F.col(vec_col), lambda e: e.cast("double"))
    rows = (vectors.where(usable(wide) & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), wide.alias("v"), is_query.alias("q")).distinct())
    rows = materialize(rows, "ann-rows")
    w = W.partitionBy("v").orderBy("id")
    named = (rows.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1)
             .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    named = materialize(named.withColumn("dim", F.size("v")), "ann-vectors")
    shards = {r.dim: -(-r.n // shard_rows) for r in named.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    count = F.coalesce(*(F.when(F.col("dim") == d, F.lit(s)) for d, s in shards.items()), F.lit(1))
    placed = named.withColumn("shard", F.pmod(F.xxhash64(F.element_at("ids", 1)), count).cast("int"))

    def index(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        v = np.array(part.column("v").to_pylist(), dtype=np.float64)
        x = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
        graph, start = build(x, degree, build_beam, alpha)
        ids = part.column("ids").combine_chunks()
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()),
                         pa.array([start], pa.int32()), pa.array([v.tobytes()], pa.binary()),
                         pa.array([graph.tobytes()], pa.binary()),
                         pa.array([ids.to_pylist()], pa.list_(pa.list_(pa.int64())))],
                        ["dim", "shard", "start", "v", "graph", "ids"])

    graphs = materialize(
        placed.groupBy("dim", "shard")
        .applyInArrow(index, "dim int, shard int, start int, v binary, graph binary, ids array<array<long>>"), "ann-graphs")

    asked = rows.where("q").groupBy("id").agg(F.min("v").alias("q")).withColumn("dim", F.size("q"))
    copies = max(1, -(-asked.count() // ASKS))
    part = F.pmod(F.xxhash64("id"), F.lit(copies)).cast("int")
    none = {"start": "int", "v": "binary", "graph": "binary", "ids": "array<array<long>>", "id": "long", "q": "array<double>"}

    def shaped(df: DataFrame, asks: bool) -> DataFrame:
        return df.select("dim", "shard", "part", F.lit(asks).alias("asks"),
                         *[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in none.items()])

    met = shaped(graphs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))), False).unionByName(
        shaped(asked.withColumn("shard", F.explode(F.sequence(F.lit(0), count - 1))).withColumn("part", part), True))

    def answers(shard: dict, qid: list[int], q: np.ndarray) -> Iterator[tuple]:
        unit = (q / np.linalg.norm(q, axis=1, keepdims=True)).astype(np.float32)
        found, _ = beam_search(shard["x"], shard["graph"], shard["start"], unit, beam)
        for j, near in enumerate(found):
            near = near[near >= 0]
            score = (shard["v"][near] * q[j]).sum(axis=1) / (shard["norm"][near] * np.linalg.norm(q[j]))
            if len(near) > k:  # the query's own node may be one of them; ties of the last all count
                some = score >= np.partition(score, len(score) - k - 1)[len(score) - k - 1]
                near, score = near[some], score[some]
            best = sorted((-s, c) for s, m in zip(score.tolist(), near.tolist())
                          for c in shard["ids"][m] if c != qid[j])[:k]
            yield from ((qid[j], c, -s) for s, c in best)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, shard = None, {}
        for batch in batches:
            place = list(zip(*(batch.column(c).to_pylist() for c in ("dim", "shard", "part", "asks"))))
            edges = [0, *(i for i in range(1, len(place)) if place[i] != place[i - 1]), len(place)]
            out: list[tuple] = []
            for a, b in zip(edges, edges[1:]):
                if a < b and not place[a][3]:  # the shard's graph
                    v = np.frombuffer(batch.column("v")[a].as_py(), np.float64).reshape(-1, place[a][0])
                    norm = np.linalg.norm(v, axis=1)
                    key, shard = place[a][:3], {
                        "v": v, "norm": norm, "x": (v / norm[:, None]).astype(np.float32),
                        "graph": np.frombuffer(batch.column("graph")[a].as_py(), np.int32).reshape(len(v), degree),
                        "ids": batch.column("ids")[a].as_py(), "start": batch.column("start")[a].as_py()}
                elif a < b and place[a][:3] == key:  # without vectors to find there is no graph
                    for i in range(a, b, TOGETHER):
                        some = batch.slice(i, min(TOGETHER, b - i))
                        q = some.column("q").flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, -1)
                        out += answers(shard, some.column("id").to_pylist(), q)
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())],
                ["query_id", "id", "score"])

    place = ["dim", "shard", "part"]
    found = (met.repartition(*place).sortWithinPartitions(*place, "asks", "id")
             .mapInArrow(search, "query_id long, id long, score double"))
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    # an id with several vectors answers once, by its nearest
    found = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
