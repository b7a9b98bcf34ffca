"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard.

Vectors are dealt to shards of bounded size by a hash of their id. A shard's graph is
kept as flat arrays: vectors, ids, and for each layer its nodes and a table of neighbour
numbers (-1 where there is none). Layers are built from the top. Nodes join a layer in a random
order, some at a time: each finds its way down the layers above and then through the layer as it
stands by beam search, is linked to near, diverse nodes of those it found (or that join with it),
and these link back; so early nodes have the long links and late ones the short. A search
descends the layers with a beam; all queries of a block move in step. Shards' results are
merged by score.

For largest inner products the graph is built on vectors with one more component that
makes all norms equal, scaled so that neither large nor small components are lost in single
precision. Equal vectors of a shard are one node that carries all their ids, each once,
so groups of copies and repeated rows neither crowd the graph nor push others out. Scores are computed anew on
the original vectors, in double precision, adding components in order.

Defined results: rows with a null id, and vectors that are null, empty, zero or hold null
or non-finite components take no part; vectors of different length are never compared; a
query's own id is no candidate for it; fewer candidates than ``k`` give fewer rows; ids
that repeat count once if their vectors are equal; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import materialise

SHARD_ROWS = 16_384
LINKS = 16
CANDIDATES = 64
#: Nodes that join a layer at a time at most.
JOIN = 1024
#: Nodes of a layer from which every search in it starts besides those found above.
ENTRIES = 8
BEAM = 128
QUERY_BLOCK = 256
INDEX = "dim int, shard int, n int, ids binary, owner binary, vectors binary, layers array<struct<nodes: binary, links: binary, width: int>>"


def clean(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v, dim) of the vectors that take part."""
    own = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists("v", lambda x: x != 0)
    return own.where("vec_id is not null and v is not null").where(~bad & ~zero).withColumn("dim", F.size("v"))


def _select(near: np.ndarray, sims: np.ndarray, x: np.ndarray, width: int) -> np.ndarray:
    """Of candidates by falling nearness (-1: none), those that are nearer to their node than to one chosen before, then the nearest of the rest."""
    n, c = near.shape
    out = np.full((n, width), -1, np.int32)
    for at in range(0, n, 256):
        ids, own = near[at : at + 256], sims[at : at + 256]
        v = x[np.maximum(ids, 0)]
        pair = v @ v.transpose(0, 2, 1)
        chosen = np.zeros(ids.shape, bool)
        for j in range(c):
            blocked = (chosen & (pair[:, j] > own[:, j, None])).any(1)
            chosen[:, j] = (ids[:, j] >= 0) & ~blocked & (chosen.sum(1) < width)
        order = np.argsort(np.where(chosen, 0, np.where(ids >= 0, 1, 2)), axis=1, kind="stable")[:, :width]
        picked = np.take_along_axis(ids, order, 1)
        out[at : at + 256, : picked.shape[1]] = picked
    return out


def _beam(x: np.ndarray, q: np.ndarray, table: np.ndarray, row: np.ndarray | None, start: np.ndarray, width: int, wave: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nearest nodes found from ``start`` (queries, any) and their nearness, by falling nearness, -1 where fewer.

    ``table``: links of each node, at its number or at ``row`` of it.
    """
    n, size = len(q), len(x) + 1
    # The place in its wave at which a node was last met, from 1; nodes of earlier waves are not met again.
    met = np.zeros(n * size, np.int32)
    best, score = np.full((n, width), -1, np.int32), np.full((n, width), -np.inf, np.float32)
    closed = np.ones((n, width), bool)
    live, fresh = np.arange(n), start.astype(np.int32)
    while True:
        r, c = np.nonzero(fresh >= 0)
        node = fresh[r, c]
        key = live[r].astype(np.int64) * size + node
        new = met[key] == 0
        r, node, key = r[new], node[new], key[new]
        number = np.arange(1, len(r) + 1, dtype=np.int32)
        met[key] = number
        once = met[key] == number
        r, node = r[once], node[once]
        # What is new for each query, side by side.
        place = np.arange(len(r)) - np.searchsorted(r, r)
        wide = int(place.max(initial=-1)) + 1
        f, s = np.full((len(live), wide), -1, np.int32), np.full((len(live), wide), -np.inf, np.float32)
        f[r, place], s[r, place] = node, np.einsum("ij,ij->i", x[node], q[live[r]])
        allv, alls = np.concatenate([best[live], f], axis=1), np.concatenate([score[live], s], axis=1)
        allo = np.concatenate([closed[live], f < 0], axis=1)
        if wide:
            top = np.argpartition(-alls, width - 1, axis=1)[:, :width]
            allv, alls, allo = (np.take_along_axis(y, top, 1) for y in (allv, alls, allo))
        rest = np.where(allo, -np.inf, alls)
        pick = np.argpartition(-rest, wave - 1, axis=1)[:, :wave] if wave < width else np.tile(np.arange(width), (len(live), 1))
        go = np.isfinite(np.take_along_axis(rest, pick, 1))
        chosen = np.where(go, np.take_along_axis(allv, pick, 1), -1)
        np.put_along_axis(allo, pick, True, 1)
        best[live], score[live], closed[live] = allv, alls, allo
        some = go.any(1)
        if not some.any():
            order = np.argsort(-score, axis=1, kind="stable")
            return np.take_along_axis(best, order, 1), np.take_along_axis(score, order, 1)
        chosen, live = chosen[some], live[some]
        known = np.maximum(chosen, 0)
        fresh = np.where(chosen[:, :, None] >= 0, table[known if row is None else row[known]], -1).reshape(len(live), -1)


def _layer(x: np.ndarray, width: int, start: np.ndarray) -> np.ndarray:
    """Links of a layer whose nodes join in row order: (rows, 2 * width) row numbers. ``start``: rows near each node, from the layers above."""
    n, table, done = len(x), np.full((len(x), 2 * width), -1, np.int32), 0
    while done < n:
        size = min(n - done, JOIN, max(64, done))
        new = np.arange(done, done + size)
        near = x[new] @ x[new].T
        near[np.triu_indices(size)] = -np.inf
        cand, sims = np.tile(new, (size, 1)), near
        if done:
            for at in range(0, size, QUERY_BLOCK):
                some = new[at : at + QUERY_BLOCK]
                begin = np.concatenate([np.where(start[some] < done, start[some], -1), np.tile(np.arange(min(ENTRIES, done)), (len(some), 1))], axis=1)
                f, v = _beam(x[:done], x[some], table[:done], None, begin, CANDIDATES)
                if not at:
                    found, score = np.full((size, CANDIDATES), -1, np.int32), np.full((size, CANDIDATES), -np.inf, np.float32)
                found[at : at + len(some)], score[at : at + len(some)] = f, v
            cand, sims = np.concatenate([found, cand], axis=1), np.concatenate([score, sims], axis=1)
        order = np.argsort(-sims, axis=1, kind="stable")[:, :CANDIDATES]
        cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
        forward = _select(np.where(np.isfinite(sims), cand, -1), sims, x, width)
        table[new, :width] = forward
        # Links back; where they are too many, the near and diverse ones stay.
        a, j = np.nonzero(forward >= 0)
        src, dst = forward[a, j], new[a]
        touched = np.unique(src)
        old_r, old_c = np.nonzero(table[touched] >= 0)
        src, dst = np.concatenate([touched[old_r], src]), np.concatenate([table[touched][old_r, old_c], dst])
        pair = np.unique(src.astype(np.int64) * n + dst)
        src, dst = pair // n, pair % n
        val = np.einsum("ij,ij->i", x[src], x[dst])
        order = np.lexsort((-val, src))
        src, dst, val = src[order], dst[order], val[order]
        place = np.arange(len(src)) - np.searchsorted(src, src)
        wide = int(min(place.max(initial=0) + 1, 4 * width))
        keep = place < wide
        back, score = np.full((len(touched), wide), -1, np.int32), np.full((len(touched), wide), -np.inf, np.float32)
        r = np.searchsorted(touched, src[keep])
        back[r, place[keep]], score[r, place[keep]] = dst[keep], val[keep]
        links = _select(back, score, x, 2 * width)
        table[touched] = -1
        table[touched, : links.shape[1]] = links
        done += size
    return table


def _scaled(v: np.ndarray) -> np.ndarray:
    """Each row divided by its largest component, as single precision; the order of its inner products stays."""
    return (v / np.maximum(np.abs(v).max(axis=1, initial=0, keepdims=True), np.finfo(np.float64).tiny)).astype(np.float32)


class Graph:
    """``x``: vectors of equal norm; ``layers``: from the top to the ground, (nodes, links) with links as node numbers."""

    def __init__(self, ids: np.ndarray, owner: np.ndarray, vectors: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]):
        self.ids, self.owner, self.vectors, self.layers = ids, owner, vectors, layers
        self.first = np.searchsorted(owner, np.arange(len(vectors) + 1))
        self.x = self._unit(vectors)

    @staticmethod
    def _unit(vectors: np.ndarray) -> np.ndarray:
        """All vectors divided by one number, so that the longest has length 1."""
        scaled = vectors / (np.abs(vectors).max(initial=0) or 1.0)
        return (scaled / (np.linalg.norm(scaled, axis=1).max(initial=0) or 1.0)).astype(np.float32)

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, links: int = LINKS) -> Graph:
        distinct, owner = np.unique(vectors, axis=0, return_inverse=True)
        # Random order of joining, fixed by the shard's content.
        shuffle = np.random.default_rng(len(distinct)).permutation(len(distinct))
        rank = np.empty_like(shuffle)
        rank[shuffle] = np.arange(len(shuffle))
        distinct, owner = distinct[shuffle], rank[owner.ravel()]
        pairs = np.unique(np.stack([owner, ids], axis=1), axis=0)
        owner, ids = pairs[:, 0], pairs[:, 1]
        unit = cls._unit(distinct)
        norms = np.minimum(np.linalg.norm(unit, axis=1), 1)
        x = np.concatenate([unit, np.sqrt(1 - norms**2)[:, None]], axis=1).astype(np.float32)
        u = np.random.default_rng(1).random(len(x))
        level = np.floor(-np.log(np.maximum(u, 1e-12)) / math.log(links)).astype(int)
        level[0] = max(level.max(), 1)
        out = cls(ids, owner.astype(np.int32), distinct, [])
        for k in range(level.max(), -1, -1):
            nodes = np.flatnonzero(level >= k).astype(np.int32)
            # What the layers above find for each node, as rows of this layer.
            above = np.concatenate([out._descend(x, x[nodes[at : at + QUERY_BLOCK]]) for at in range(0, len(nodes), QUERY_BLOCK)])
            start = np.where(above >= 0, np.searchsorted(nodes, np.maximum(above, 0)), len(x))
            local = _layer(x[nodes], links, start)
            out.layers.append((nodes, np.where(local >= 0, nodes[np.maximum(local, 0)], -1).astype(np.int32)))
        return out

    def _walk(self, x: np.ndarray, q: np.ndarray, layer: tuple[np.ndarray, np.ndarray], start: np.ndarray, width: int) -> np.ndarray:
        nodes, table = layer
        row = np.full(len(x), -1, np.int32)
        row[nodes] = np.arange(len(nodes))
        return _beam(x, q, table, row, start, width)[0]

    def _descend(self, x: np.ndarray, q: np.ndarray, layers: int | None = None, width: int = 16) -> np.ndarray:
        """Nodes near each query by the first ``layers`` layers (all, if None), -1 where fewer."""
        some = self.layers[:layers]
        start = np.tile(some[0][0][:ENTRIES], (len(q), 1)) if some else np.full((len(q), 1), -1, np.int32)
        for layer in some:
            start = self._walk(x, q, layer, start, width)
        return start

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, width: int = BEAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query id, id, score): the ``k`` best other ids of each query that the beam finds."""
        out = []
        for at in range(0, len(queries), QUERY_BLOCK):
            q64, own = queries[at : at + QUERY_BLOCK], query_ids[at : at + QUERY_BLOCK]
            q = _scaled(q64)
            start = self._descend(self.x, q, len(self.layers) - 1)
            start = np.concatenate([start, np.tile(self.layers[-1][0][:ENTRIES], (len(q), 1))], axis=1)
            found = self._walk(self.x, q, self.layers[-1], start, width)
            r, c = np.nonzero(found >= 0)
            node = found[r, c]
            exact = np.zeros(len(r))
            with np.errstate(over="ignore", invalid="ignore"):
                for d in range(queries.shape[1]):
                    exact += q64[r, d] * self.vectors[node, d]
            # All copies of a node score the same, and the smallest k + 1 ids can be among the best k.
            n = np.minimum(self.first[node + 1] - self.first[node], k + 1)
            r, s = np.repeat(r, n), np.repeat(exact, n)
            place = np.arange(len(r)) - np.repeat(np.cumsum(n) - n, n)
            ids = self.ids[np.repeat(self.first[node], n) + place]
            good = ids != own[r]
            r, s, ids = r[good], s[good], ids[good]
            order = np.lexsort((ids, -s, r))
            r, s, ids = r[order], s[order], ids[order]
            top = np.arange(len(r)) - np.searchsorted(r, r) < k
            out.append((own[r[top]], ids[top], s[top]))
        return tuple(np.concatenate([o[i] for o in out]) for i in range(3))

    def row(self, dim: int, shard: int) -> dict:
        return {
            "dim": dim, "shard": shard, "n": len(self.vectors), "ids": self.ids.astype("<i8").tobytes(), "owner": self.owner.astype("<i4").tobytes(), "vectors": self.vectors.astype("<f8").tobytes(),
            "layers": [{"nodes": a.astype("<i4").tobytes(), "links": b.astype("<i4").tobytes(), "width": b.shape[1]} for a, b in self.layers],
        }

    @classmethod
    def of(cls, r) -> Graph:
        layers = [(np.frombuffer(x["nodes"], "<i4"), np.frombuffer(x["links"], "<i4").reshape(-1, x["width"])) for x in r.layers]
        return cls(np.frombuffer(r.ids, "<i8"), np.frombuffer(r.owner, "<i4"), np.frombuffer(r.vectors, "<f8").reshape(int(r.n), int(r.dim)), layers)


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS, links: int = LINKS) -> DataFrame:
    """One row for each shard of (vec_id, v, dim): the graph as flat arrays. Every row is indexed."""
    shards = max(1, math.ceil(vectors.count() / shard_rows))

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        graph = Graph.build(pdf["vec_id"].to_numpy(np.int64), np.stack(pdf["v"].to_numpy()).astype(np.float64), links)
        return pd.DataFrame([graph.row(int(key[0]), int(key[1]))])

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).repartition(4 * shards, "dim", "shard")
    return materialise(dealt.groupBy("dim", "shard").applyInPandas(build, INDEX), "hnsw")


def search(index: DataFrame, queries: DataFrame, k: int = 20, width: int = BEAM) -> DataFrame:
    """Columns query_id, rank, vec_id, score of (vec_id, v, dim) queries, each searched in every shard of its dimension.

    A task gets a shard's row first and then its queries, a batch at a time.
    """
    shards = index.select("dim", "shard")
    n = max(1, shards.count())
    sent = queries.join(F.broadcast(shards.groupBy("dim").agg(F.collect_list("shard").alias("shards"))), "dim").select("dim", F.explode("shards").alias("shard"), F.col("vec_id").alias("query_id"), "v")
    graph = F.struct("n", "ids", "owner", "vectors", "layers")
    kind = index.select(graph.alias("g")).schema["g"].dataType
    rows = index.select("dim", "shard", F.lit(None).cast("long").alias("query_id"), F.lit(None).cast("array<double>").alias("v"), graph.alias("g"))
    rows = rows.unionByName(sent.withColumn("g", F.lit(None).cast(kind)))
    rows = rows.repartition(4 * n, "dim", "shard").sortWithinPartitions("dim", "shard", F.col("query_id").asc_nulls_first())

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, at = None, None
        for pdf in it:
            for key, part in pdf.groupby(["dim", "shard"], sort=False):
                if part["query_id"].isna().iloc[0]:
                    g = part["g"].iloc[0]
                    layers = [{"nodes": x["nodes"], "links": x["links"], "width": x["width"]} for x in g["layers"]]
                    held, at = Graph.of(pd.Series({"dim": key[0], "n": g["n"], "ids": g["ids"], "owner": g["owner"], "vectors": g["vectors"], "layers": layers})), key
                    part = part.iloc[1:]
                if len(part):
                    assert at == key
                    q, i, s = held.search(part["query_id"].to_numpy(np.int64), np.stack(part["v"].to_numpy()).astype(np.float64), k, width)
                    yield pd.DataFrame({"query_id": q, "vec_id": i, "score": s})

    found = rows.mapInPandas(run, "query_id long, vec_id long, score double").distinct()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = clean(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return search(build_index(vectors), vectors.where(F.col("vec_id") % 20 == 0), 20)
