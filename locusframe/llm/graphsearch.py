"""Approximate nearest neighbours: robust-pruned directed graphs, one per shard, and beam search.

Nearness is the inner product. Vectors get one more component that makes their lengths equal, so the
nearest by distance is the largest by inner product; queries get a zero there.

* Equal vectors are one node. A node keeps the ``k + 1`` smallest ids of its rows, which is all that a result
  of ``k`` rows without the query's own can need; no row of another vector is affected.
* Nodes are dealt by their length to bands, in which lengths differ by a factor of 2 at most, and in a band by a hash to
  shards. Very long vectors are so in shards of their own and drown no differences of others. A shard's graph grows in batches: a greedy beam search over the
  graph so far proposes neighbours; pruning keeps the nearest and drops every candidate that is nearer, by
  the factor ``alpha``, to a kept one than to the node. Edges go both ways; full lists are pruned again.
* Every distinct query vector is searched in every shard, in blocks of queries. A shard gives its best
  ``k + 1`` rows, scored in double precision on the original vectors, and these are merged.

Vectors that are null, zero or hold null or non-finite components take no part, neither as queries nor as
candidates; vectors are compared with those of equal length only. Ties go to the smaller id; ids should be
unique, and rows with a null id take no part. An empty table gives an empty result. Other columns of the
input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.llm.common import column, stored

#: Rows of a table of "seen" marks, queries times nodes, that one search holds at most.
_MARKS = 40_000_000


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def scaled(vectors: np.ndarray, axis: int | None) -> np.ndarray:
    """Vectors over the largest component of all of them (axis None) or of each (1): no square of it overflows."""
    return vectors / np.abs(vectors).max(axis=axis, keepdims=True) if vectors.size else vectors


def length_band(vector: Column) -> Column:
    """Lengths of one band differ by a factor of 2 at most; a length of 1 lies in a band's middle."""
    largest = F.array_max(F.transform(vector, F.abs))
    square = F.aggregate(vector, F.lit(0.0), lambda t, x: t + (x / largest) * (x / largest))
    return F.floor(F.log2(largest) + F.log2(square) / 2 + 0.5).cast("int")


def lifted(vectors: np.ndarray) -> np.ndarray:
    """Vectors of one length: with a last component that makes up for shorter ones."""
    vectors = scaled(vectors.astype(np.float64), None)
    square = (vectors**2).sum(1)
    rest = np.sqrt(np.maximum(square.max() - square, 0)) if len(square) else square
    return np.concatenate([vectors, rest[:, None]], 1).astype(np.float32)


def distances(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Squared distances, less the query's square, of ``ids`` (a row per query) to the queries."""
    found = vectors[ids]
    return (found**2).sum(2) - 2 * np.einsum("bcd,bd->bc", found, queries)


def beam_search(
    vectors: np.ndarray, edges: np.ndarray, starts: np.ndarray, queries: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ids (-1: none) and distances of the best ``width`` nodes met, nearest first, for each query.

    All queries take a step at once: each opens its nearest unopened node and adds that node's neighbours
    to its beam, until no beam holds an unopened node.
    """
    count, far = len(queries), np.float32(np.inf)
    ids = np.full((count, width), -1)
    near = np.full((count, width), far, np.float32)
    opened = np.ones((count, width), bool)
    seen = np.zeros((count, len(vectors) + 1), bool)
    first = np.tile(starts[:width], (count, 1))
    m = first.shape[1]
    ids[:, :m], near[:, :m], opened[:, :m] = first, distances(vectors, first, queries), False
    order = np.argsort(near, 1, kind="stable")
    ids, near, opened = (np.take_along_axis(x, order, 1) for x in (ids, near, opened))
    seen[:, starts[:width]] = True
    seen[:, -1] = True
    active = np.arange(count)
    while len(active):
        place = np.argmin(opened[active], 1)
        left = ~opened[active, place]
        active, place = active[left], place[left]
        if not len(active):
            break
        opened[active, place] = True
        next_ids = edges[ids[active, place]]
        new = ~seen[active[:, None], next_ids]
        seen[active[:, None], next_ids] = True
        next_near = distances(vectors, np.where(new, next_ids, 0), queries[active])
        next_near[~new] = far
        all_near = np.concatenate([near[active], next_near], 1)
        best = np.argsort(all_near, 1, kind="stable")[:, :width]
        ids[active] = np.take_along_axis(np.concatenate([ids[active], next_ids], 1), best, 1)
        near[active] = np.take_along_axis(all_near, best, 1)
        # What is no candidate counts as opened.
        opened[active] = np.take_along_axis(np.concatenate([opened[active], ~new], 1), best, 1)
    ids[~np.isfinite(near)] = -1
    return ids, near


def prune(vectors: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` diverse neighbours of each node out of its candidates (-1: none)."""
    candidates = np.where(candidates == nodes[:, None], -1, candidates)
    near = ((vectors[candidates] - vectors[nodes][:, None]) ** 2).sum(2)
    near[candidates < 0] = np.inf
    order = np.argsort(near, 1, kind="stable")
    candidates, near = np.take_along_axis(candidates, order, 1), np.take_along_axis(near, order, 1)
    repeated = np.zeros(candidates.shape, bool)
    by_id = np.argsort(candidates, 1, kind="stable")
    sorted_ids = np.take_along_axis(candidates, by_id, 1)
    np.put_along_axis(repeated, by_id[:, 1:], sorted_ids[:, 1:] == sorted_ids[:, :-1], 1)
    alive = np.isfinite(near) & ~repeated
    found = vectors[candidates]
    square = (found**2).sum(2)
    between = square[:, :, None] + square[:, None] - 2 * np.matmul(found, found.transpose(0, 2, 1))
    kept = np.full((len(nodes), degree), -1)
    rows = np.arange(len(nodes))
    for step in range(degree):
        place = np.argmax(alive, 1)
        some = alive[rows, place]
        if not some.any():
            break
        kept[some, step] = candidates[some, place[some]]
        alive[rows, place] = False
        alive[some] &= alpha * alpha * between[rows[some], place[some]] > near[some]
    return kept


def build(vectors: np.ndarray, degree: int = 32, width: int = 64, alpha: float = 1.2, seed: int = 3):
    """(edges, starts) of the graph; ``edges`` has -1 where a node has fewer than ``degree`` neighbours."""
    n = len(vectors)
    order = np.random.default_rng(seed).permutation(n)
    edges = np.full((n + 1, degree), -1)
    done = min(n, 2 * width)
    head = order[:done]
    edges[head] = prune(vectors, head, np.tile(head, (done, 1)), degree, alpha)
    starts = head[:8]
    while done < n:
        batch = order[done : done + max(64, min(done // 2, 1024, _MARKS // (n + 1)))]
        done += len(batch)
        met, _ = beam_search(vectors, edges, starts, vectors[batch], width)
        edges[batch] = prune(vectors, batch, met, degree, alpha)
        pairs = np.stack([edges[batch].ravel(), np.repeat(batch, degree)], 1)
        pairs = pairs[pairs[:, 0] >= 0]
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        targets, first, counts = np.unique(pairs[:, 0], return_index=True, return_counts=True)
        added = np.full((len(targets), counts.max(initial=0)), -1)
        row = np.repeat(np.arange(len(targets)), counts)
        added[row, np.arange(len(pairs)) - np.repeat(first, counts)] = pairs[:, 1]
        for i in range(0, len(targets), 512):
            part = targets[i : i + 512]
            both = np.concatenate([edges[part], added[i : i + 512]], 1)
            both = both[:, (both >= 0).any(0)]
            edges[part] = prune(vectors, part, both, degree, alpha)
    return edges[:n], starts


_GRAPH = "dim int, band int, shard int, n int, vectors binary, edges binary, starts binary, members binary, counts binary"


def _build_shard(degree: int, width: int, alpha: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("least", kind="stable")
        vectors = np.array(frame["vector"].tolist(), np.float64)
        edges, starts = build(lifted(vectors), degree, width, alpha)
        members = [np.asarray(m, np.int64) for m in frame["members"]]
        return pd.DataFrame(
            {
                "dim": [vectors.shape[1]],
                "band": [int(frame["band"].iloc[0])],
                "shard": [int(frame["shard"].iloc[0])],
                "n": [len(vectors)],
                "vectors": [vectors.tobytes()],
                "edges": [edges.astype(np.int32).tobytes()],
                "starts": [starts.astype(np.int32).tobytes()],
                "members": [np.concatenate(members).tobytes()],
                "counts": [np.array([len(m) for m in members], np.int32).tobytes()],
            }
        )

    return run


def _search_shard(k: int, degree: int, width: int):
    def run(graphs: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": [], "ids": [], "scores": []})
        if not len(graphs) or not len(queries):
            return empty
        g = graphs.iloc[0]
        vectors = np.frombuffer(g["vectors"], np.float64).reshape(g["n"], g["dim"])
        edges = np.frombuffer(g["edges"], np.int32).reshape(g["n"], degree).astype(np.int64)
        starts = np.frombuffer(g["starts"], np.int32).astype(np.int64)
        members, counts = np.frombuffer(g["members"], np.int64), np.frombuffer(g["counts"], np.int32)
        ends = np.cumsum(counts)
        asked = np.array(queries["vector"].tolist(), np.float64)
        flat = np.concatenate([scaled(asked, 1), np.zeros((len(asked), 1))], 1).astype(np.float32)
        space = lifted(vectors)
        out = []
        step = max(1, min(2048, _MARKS // (len(vectors) + 1)))
        for i in range(0, len(asked), step):
            met, _ = beam_search(space, edges, starts, flat[i : i + step], max(width, k + 1))
            for q, ids in zip(range(i, i + step), met, strict=False):
                ids = ids[ids >= 0]
                score = vectors[ids] @ asked[q]
                rows = np.concatenate([members[ends[j] - counts[j] : ends[j]] for j in ids])
                score = np.repeat(score, counts[ids])
                best = np.lexsort((rows, -score))[: k + 1]
                out.append((queries["query"].iloc[q], rows[best], score[best]))
        return pd.DataFrame(out, columns=["query", "ids", "scores"])

    return run


def nearest(
    embeddings: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector: str = "embedding",
    rows_per_shard: int = 10_000, least_shards: int = 12, degree: int = 32, width: int = 80, alpha: float = 1.2,
    queries_per_block: int = 20_000,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest rows found for the rows where ``is_query`` holds."""
    rows = embeddings.filter(column(id_column).isNotNull()).select(
        column(id_column).cast("long").alias("id"),
        column(vector).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = rows.filter(usable(F.col("vector")))
    # row_number with a bound keeps k + 1 rows of a vector in each task before anything is shuffled.
    by_id = Window.partitionBy("vector").orderBy("id")
    few = rows.select("vector", "id").withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= k + 1)
    nodes = few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("members"), F.min("id").alias("least"))
    nodes = stored(nodes.withColumn("dim", F.size("vector")).withColumn("band", length_band(F.col("vector"))), "nodes")
    size = max(1, min(rows_per_shard, -(-nodes.count() // least_shards)))
    # One row for each number of components and band of lengths; doubles have some 2,100 bands.
    kinds = nodes.groupBy("dim", "band").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("shards"))
    kinds = stored(kinds, "kinds")
    dealt = nodes.join(kinds, ["dim", "band"]).withColumn("shard", F.pmod(F.xxhash64("least"), F.col("shards")).cast("int"))
    graphs = stored(dealt.groupBy("dim", "band", "shard").applyInPandas(_build_shard(degree, width, alpha), _GRAPH), "graphs")

    asked = rows.filter("asks").select("id", "vector")
    distinct = asked.groupBy("vector").agg(F.min("id").alias("query")).withColumn("dim", F.size("vector"))
    distinct = stored(distinct, "queries")
    blocks = max(1, -(-distinct.count() // queries_per_block))
    sent = distinct.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
    sent = sent.join(kinds, "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    copies = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    key = ["dim", "band", "shard", "block"]
    found = (
        copies.groupBy(*key)
        .cogroup(sent.groupBy(*key))
        .applyInPandas(_search_shard(k, degree, width), "query long, ids array<long>, scores array<double>")
    )
    pairs = found.select("query", F.inline(F.arrays_zip(F.col("ids").alias("id"), F.col("scores").alias("score"))))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    merged = pairs.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    lists = merged.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("list"))
    # Rows that ask with equal vectors share one list; each leaves itself out.
    askers = asked.join(distinct.select("vector", "query"), "vector").select("id", "query")
    own = askers.join(lists, "query").select(
        F.col("id").alias("query_id"), F.slice(F.filter("list", lambda e: e["id"] != F.col("id")), 1, k).alias("list")
    )
    return own.select("query_id", F.posexplode("list").alias("rank", "e")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("e.id").alias("vec_id"), F.col("e.score").alias("score")
    )
