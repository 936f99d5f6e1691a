"""Exact search of the ``k`` largest inner products with KD-trees, one per shard.

Vectors are arrays of longs (``quantised`` makes them of floating-point ones). Equal vectors are one node.

1. Shards. Median splits of a bounded sample (``sample_rows`` nodes, fewer for vectors of more than 64 components) cut
   space into leaves, and every node is sent to its leaf; a leaf with more nodes than a shard may hold is dealt over
   several shards by a hash. The sample only decides how close together a shard's nodes lie: any dealing gives the same
   results.
2. Trees. In a shard, nodes are split at the median of the widest dimension until ``leaf_rows`` are left. Each tree node
   has the tight box around its vectors.
3. Bounds. No vector of a box has a larger inner product with a query than the sum, over dimensions, of the larger of
   the products with the box's two sides. Traversal is best-first: the open box of the largest bound is
   next, until no bound reaches the kth score known; a box whose bound equals it is opened, since ids break ties.
4. Two rounds. A query first searches the shard that its own vector lies in. The kth score found there goes
   with it to all other shards, whose traversal starts from it, so most stop at the root or near it.
   Queries meet shards in blocks, and only rows that reach the score known come back.

The work is at worst queries times nodes, as for any exact search; boxes can only save. A task holds a shard
(``rows_per_shard`` nodes) and a block of queries at a time. Arithmetic is exact: in double precision
where no sum can reach 2**53, in Python's integers otherwise; scores and components beyond a long become the
nearest long, scores after they are ranked.

Vectors that are null or hold null or non-finite components take no part, as queries or as candidates; zero vectors
do. Vectors are compared with those of equal length only. Ties go to the smaller id; ids should be unique, and rows with
a null id take no part. Rows of equal vectors are each a candidate. An empty table gives an empty result. Other columns of
the input are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.llm.common import column, stored

_LONG = 2**63 - 1
#: Added to a score, so that all are positive and text of equal width has their order.
_LIFT, _DIGITS = 10**42, 43
#: Bounds, queries times boxes, that a search holds at most.
_BOUNDS = 4_000_000


def quantised(vector: Column, factor: int) -> Column:
    """floor(factor * x) of every component, in double precision; null for vectors that take no part."""
    wide = vector.cast("array<double>")
    fine = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fine, F.transform(wide, lambda x: F.floor(x * F.lit(float(factor))).cast("long")))


def matrix(vectors) -> np.ndarray:
    return np.array([np.asarray(v, np.int64) for v in vectors], np.int64)


def exact(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices in a type in which their inner products, and sums of larger products, are exact."""
    if not left.size or not right.size:
        return left.astype(np.float64), right.astype(np.float64)
    most = [max(abs(int(m.min())), abs(int(m.max()))) for m in (left, right)]
    kind = np.float64 if most[0] * most[1] * left.shape[1] < 1 << 53 else object
    return left.astype(kind), right.astype(kind)


@dataclass
class Tree:
    """Nodes by number: a box [low, high] around the rows ``order[first:last]``; children are -1 for a leaf."""

    order: np.ndarray
    first: np.ndarray
    last: np.ndarray
    left: np.ndarray
    right: np.ndarray
    low: np.ndarray
    high: np.ndarray


def build(vectors: np.ndarray, leaf_rows: int) -> Tree:
    """Median splits at the widest dimension; rows of equal value there may part at the median."""
    order = np.arange(len(vectors))
    first, last, left, right, low, high = [], [], [], [], [], []

    def add(a: int, b: int) -> int:
        rows = vectors[order[a:b]]
        first.append(a)
        last.append(b)
        left.append(-1)
        right.append(-1)
        low.append(rows.min(0))
        high.append(rows.max(0))
        return len(first) - 1

    open_ = [add(0, len(vectors))] if len(vectors) else []
    while open_:
        node = open_.pop()
        a, b = first[node], last[node]
        # Python's integers, since a width may exceed a long.
        widths = [int(h) - int(w) for h, w in zip(high[node], low[node], strict=True)]
        if b - a <= leaf_rows or not any(widths):
            continue
        at = widths.index(max(widths))
        middle = (b - a) // 2
        rows = order[a:b]
        order[a:b] = rows[np.argpartition(vectors[rows, at], middle)]
        left[node], right[node] = add(a, a + middle), add(a + middle, b)
        open_ += [left[node], right[node]]
    numbers = [np.array(x, np.int64) for x in (first, last, left, right)]
    boxes = [np.array(x, np.int64).reshape(len(first), vectors.shape[1]) for x in (low, high)]
    return Tree(order, *numbers, *boxes)


def bounds(tree: Tree, queries: np.ndarray) -> np.ndarray:
    """A row per query: the largest inner product that any vector of each box could have."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    return up @ tree.high.astype(queries.dtype).T + down @ tree.low.astype(queries.dtype).T


class Best:
    """The ``k`` best (score, id) pairs, ties to the smaller id, and the score that a further pair has to reach."""

    def __init__(self, k: int, reach):
        self.k, self.reach = k, reach
        self.scores, self.ids = [], []

    def add(self, scores: list, ids: list) -> None:
        both = sorted(zip(self.scores + scores, self.ids + ids, strict=True), key=lambda p: (-p[0], p[1]))[: self.k]
        self.scores, self.ids = [p[0] for p in both], [p[1] for p in both]
        if len(both) == self.k and (self.reach is None or both[-1][0] > self.reach):
            self.reach = both[-1][0]


def search(
    tree: Tree, vectors: np.ndarray, members: list[np.ndarray], queries: np.ndarray, k: int, reach: list
) -> Iterator[tuple[list, list, int]]:
    """(scores, ids, leaves opened) per query: its best ``k`` rows with a score of ``reach`` (None: any) or more.

    ``vectors`` and ``members`` (the ids of each node's rows, ascending) are in the order of the tree.
    """
    queries, vectors = exact(queries, vectors)
    step = max(1, _BOUNDS // max(1, len(tree.first)))
    first, last, left, right = (x.tolist() for x in (tree.first, tree.last, tree.left, tree.right))
    for start in range(0, len(queries), step):
        block = queries[start : start + step]
        for q, of_boxes in enumerate(bounds(tree, block)):
            best, opened = Best(k, reach[start + q]), 0
            limit = of_boxes.tolist()
            heap = [(-limit[0], 0)] if len(limit) else []
            while heap:
                bound, node = heapq.heappop(heap)
                if best.reach is not None and -bound < best.reach:
                    break
                if left[node] >= 0:
                    for child in (left[node], right[node]):
                        if best.reach is None or limit[child] >= best.reach:
                            heapq.heappush(heap, (-limit[child], child))
                    continue
                opened += 1
                scores = vectors[first[node] : last[node]] @ block[q]
                rows = np.arange(len(scores)) if best.reach is None else np.flatnonzero(scores >= best.reach)
                if len(rows) > k:
                    # Nodes below the kth score of the leaf cannot count; equal ones are kept.
                    rows = rows[scores[rows] >= np.sort(scores[rows])[-k]]
                if len(rows):
                    found = [members[first[node] + r] for r in rows.tolist()]
                    best.add([s for s, m in zip(scores[rows].tolist(), found, strict=True) for _ in m], [i for m in found for i in m.tolist()])
            yield best.scores, best.ids, opened


_SHARD = "shard long, dim int, n int, vectors binary, members binary, counts binary, tree binary, boxes binary"


def _built(leaf_rows: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("least", kind="stable")
        vectors = matrix(frame["vector"])
        tree = build(vectors, leaf_rows)
        members = [np.asarray(m, np.int64) for m in frame["members"]]
        members = [members[i] for i in tree.order]
        return pd.DataFrame(
            {
                "shard": [int(frame["shard"].iloc[0])],
                "dim": [vectors.shape[1]],
                "n": [len(vectors)],
                "vectors": [vectors[tree.order].tobytes()],
                "members": [np.concatenate(members).tobytes()],
                "counts": [np.array([len(m) for m in members], np.int64).tobytes()],
                "tree": [np.stack([tree.first, tree.last, tree.left, tree.right]).tobytes()],
                "boxes": [np.stack([tree.low, tree.high]).tobytes()],
            }
        )

    return run


def _searched(k: int):
    def run(shards: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(shards) and len(queries):
            s = shards.iloc[0]
            dim = int(s["dim"])
            links = np.frombuffer(s["tree"], np.int64).reshape(4, -1)
            boxes = np.frombuffer(s["boxes"], np.int64).reshape(2, links.shape[1], dim)
            counts = np.frombuffer(s["counts"], np.int64)
            members = np.split(np.frombuffer(s["members"], np.int64), np.cumsum(counts)[:-1])
            tree = Tree(np.arange(s["n"]), *links, *boxes)
            vectors = np.frombuffer(s["vectors"], np.int64).reshape(s["n"], dim)
            asked = matrix(queries["vector"]).reshape(len(queries), dim)
            known = [None if r is None else int(r) - _LIFT for r in queries["reach"]]
            results = search(tree, vectors, members, asked, k, known)
            for name, (scores, ids, opened) in zip(queries["query"], results, strict=True):
                if ids:
                    whole = [int(x) for x in scores]
                    keys = [f"{x + _LIFT:0{_DIGITS}d}" for x in whole]
                    out.append((name, keys, [min(max(x, -_LONG), _LONG) for x in whole], ids, opened))
        return pd.DataFrame(out, columns=["query", "keys", "scores", "ids", "opened"])

    return run


_FOUND = "query long, keys array<string>, scores array<long>, ids array<long>, opened long"


def leaf_of(planes: list[tuple[int, int, int, int]], vectors: np.ndarray) -> np.ndarray:
    """The number of each vector's leaf; ``planes`` are (dimension, value, left, right), dimension -1 for a leaf."""
    at = np.zeros(len(vectors), np.int64)
    table = np.array(planes, np.int64).reshape(-1, 4)
    rows = np.arange(len(vectors))
    while len(rows):
        dimension, value, left, right = table[at[rows]].T
        inner = dimension >= 0
        rows = rows[inner]
        if len(rows):
            below = vectors[rows, dimension[inner]] < value[inner]
            at[rows] = np.where(below, left[inner], right[inner])
    return at


def planes_of(sample: np.ndarray, leaves: int) -> list[tuple[int, int, int, int]]:
    """Median splits at the widest dimension, for routing: a value below the plane's goes left."""
    planes: list[tuple[int, int, int, int]] = [(-1, 0, -1, -1)]
    open_ = [(0, sample, leaves)] if len(sample) else []
    while open_:
        node, rows, parts = open_.pop()
        if parts < 2 or len(rows) < 2:
            continue
        widths = [int(h) - int(w) for h, w in zip(rows.max(0), rows.min(0), strict=True)]
        if not any(widths):
            continue
        at = widths.index(max(widths))
        value = int(np.sort(rows[:, at])[len(rows) // 2])
        below = rows[:, at] < value
        if not below.any():
            value += 1
            below = rows[:, at] < value
        left, right = len(planes), len(planes) + 1
        planes += [(-1, 0, -1, -1), (-1, 0, -1, -1)]
        planes[node] = (at, value, left, right)
        open_ += [(left, rows[below], parts // 2), (right, rows[~below], parts - parts // 2)]
    return planes


def _routed(frame: DataFrame, planes: dict[int, list]) -> DataFrame:
    """``leaf`` of every row's vector."""
    sent = frame.sparkSession.sparkContext.broadcast(planes)

    @F.pandas_udf("long")
    def leaf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            dims = batch.map(len).to_numpy()
            out = np.zeros(len(batch), np.int64)
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                if dim in sent.value:
                    out[rows] = leaf_of(sent.value[dim], matrix(batch.iloc[rows]))
            yield pd.Series(out)

    return frame.withColumn("leaf", leaf("vector"))


def top_products(
    embeddings: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector: str = "embedding",
    factor: int = 64, rows_per_shard: int = 8_192, leaf_rows: int = 128, sample_rows: int = 8_192,
    queries_per_block: int = 4_096,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` largest inner products for the rows where ``is_query`` holds."""
    rows = embeddings.filter(column(id_column).isNotNull()).select(
        column(id_column).cast("long").alias("id"),
        quantised(column(vector), factor).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = rows.filter("vector IS NOT NULL")
    # A bounded row_number keeps k + 1 rows of a vector in each task before anything is shuffled.
    by_id = Window.partitionBy("vector").orderBy("id")
    few = rows.select("vector", "id").withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= k + 1)
    nodes = few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("members"), F.min("id").alias("least"))
    nodes = stored(nodes.withColumn("dim", F.size("vector")), "nodes")
    total, widest = nodes.agg(F.count(F.lit(1)), F.coalesce(F.max("dim"), F.lit(1))).first()

    sample_rows = max(64, min(sample_rows, (sample_rows * 64) // max(1, widest)))
    some = nodes.filter(F.pmod(F.xxhash64("least"), F.lit(max(1, -(-total // sample_rows)))) == 0)
    sample = some.orderBy("least").limit(2 * sample_rows).select("dim", "vector").collect()
    leaves = max(1, min(-(-2 * total // rows_per_shard), sample_rows // 8))
    planes = {
        dim: planes_of(matrix(r["vector"] for r in sample if r["dim"] == dim), leaves) for dim in {r["dim"] for r in sample} if dim
    }
    placed = _routed(nodes, planes)
    counts = placed.groupBy("dim", "leaf").agg(F.count(F.lit(1)).alias("rows"))
    # A row per leaf of the sample's trees, at most an eighth of sample_rows for each length of vectors.
    parts = counts.select("dim", "leaf", F.ceil(F.col("rows") / F.lit(rows_per_shard)).cast("long").alias("parts"))
    parts = stored(parts.withColumn("home", F.row_number().over(Window.orderBy("dim", "leaf"))), "leaves")

    def shard(part: Column) -> Column:
        return F.shiftleft(F.col("home").cast("long"), 32) + part

    spread = placed.join(F.broadcast(parts), ["dim", "leaf"])
    dealt = spread.withColumn("shard", shard(F.pmod(F.xxhash64("least"), F.col("parts"))))
    shards = stored(dealt.groupBy("shard", "dim").applyInPandas(_built(leaf_rows), _SHARD), "shards")

    asked = rows.filter("asks").select("id", "vector")
    distinct = asked.groupBy("vector").agg(F.min("id").alias("query"), F.count(F.lit(1)).alias("askers"))
    distinct = stored(distinct.withColumn("dim", F.size("vector")), "queries")
    vectors_asked, rows_asked = distinct.agg(F.count(F.lit(1)), F.coalesce(F.sum("askers"), F.lit(0))).first()
    homes = _routed(distinct.select("query", "vector", "dim"), planes).join(F.broadcast(parts), ["dim", "leaf"])
    homes = homes.withColumn("own", shard(F.pmod(F.xxhash64("query"), F.col("parts"))))
    homes = stored(homes.select("query", "vector", "dim", "own"), "homes")

    def meeting(sent: DataFrame, blocks: int) -> DataFrame:
        sent = sent.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
        copies = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        key = ["shard", "block", "dim"]
        return copies.groupBy(*key).cogroup(sent.groupBy(*key)).applyInPandas(_searched(k + 1), _FOUND)

    # A shard is home to about as many queries as its part of the nodes.
    first = homes.select(F.col("own").alias("shard"), "dim", "query", "vector", F.lit(None).cast("string").alias("reach"))
    first = stored(meeting(first, 1), "first-found")
    # The list may hold the query's own row, so its last score is the kth of others, or less; a short list tells nothing.
    kth = first.select("query", F.try_element_at("keys", F.lit(k + 1)).alias("reach"))
    rest = homes.join(kth, "query", "left").join(F.broadcast(parts.select("dim", "home", "parts")), "dim")
    rest = rest.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rest = rest.select(shard(F.col("part")).alias("shard"), "own", "dim", "query", "vector", "reach").filter("shard != own")
    found = first.unionByName(meeting(rest.drop("own"), max(1, -(-vectors_asked // queries_per_block))))

    pairs = found.select("query", F.inline(F.arrays_zip(F.col("ids").alias("id"), F.col("keys").alias("key"), F.col("scores").alias("score"))))
    order = Window.partitionBy("query").orderBy(F.desc("key"), "id")
    merged = pairs.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    lists = merged.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("list"))
    return _answers(asked, distinct.join(lists, "query"), k, max(1_000, rows_asked // 1_000))


def _answers(asked: DataFrame, lists: DataFrame, k: int, most: int) -> DataFrame:
    """Rows that ask with equal vectors share one list, and each leaves itself out.

    A list that more than ``most`` rows ask for is repeated, so that no task gets all of these; there are
    at most a thousand such lists.
    """
    copies = F.ceil(F.col("askers") / F.lit(most)).cast("long")
    busy = lists.filter(F.col("askers") > most).select("vector", copies.alias("copies"))
    repeated = lists.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
    salted = asked.join(F.broadcast(busy), "vector", "left")
    salted = salted.withColumn("copy", F.pmod(F.xxhash64("id"), F.coalesce("copies", F.lit(1).cast("long"))))
    own = salted.select("id", "vector", "copy").join(repeated.select("vector", "copy", "list"), ["vector", "copy"])
    own = own.select(F.col("id").alias("query_id"), F.slice(F.filter("list", lambda e: e["id"] != F.col("id")), 1, k).alias("list"))
    return own.select("query_id", F.posexplode("list").alias("rank", "e")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("e.id").alias("vec_id"), F.col("e.score").alias("score")
    )
