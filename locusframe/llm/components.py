"""Connected components of links: parts contracted in tasks, then joined by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import release, stored

#: Nodes that a task joins at a time; only the number of rounds depends on it.
LOCAL_NODES = 300_000


def _least(edges: DataFrame) -> DataFrame:
    """(u, v, m): each edge with the least of ``u`` and all its neighbours.

    An aggregate and a join, so that a node with very many edges is summed before it is shuffled.
    """
    least = edges.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("m"))
    return edges.join(least, F.col("u") == F.col("of")).select("u", "v", F.least("u", "m").alias("m"))


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges with the same components: each task joins up to ``LOCAL_NODES`` nodes at a time into stars on their least."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict = {}

        def root(x):
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = parent[x]
            return x

        def stars() -> pd.DataFrame:
            rows = [(x, root(x)) for x in parent]
            return pd.DataFrame([r for r in rows if r[0] != r[1]], columns=["u", "v"])

        for frame in frames:
            for u, v in zip(frame["u"].tolist(), frame["v"].tolist(), strict=True):
                x, y = root(u), root(v)
                parent[max(x, y)] = min(x, y)
            if len(parent) > LOCAL_NODES:
                yield stars()
                parent.clear()
        yield stars()

    return edges.mapInPandas(run, edges.schema)


def _flat(edges: DataFrame) -> bool:
    """Whether every node has one edge upwards, to a node that has none."""
    roles = edges.select(F.col("u").alias("node"), F.lit(1).alias("ups"), F.lit(0).alias("downs")).union(
        edges.groupBy("v").agg(F.lit(0), F.lit(1))
    )
    roles = roles.groupBy("node").agg(F.sum("ups").alias("ups"), F.max("downs").alias("downs"))
    return roles.filter("ups > 1 OR (ups = 1 AND downs = 1)").isEmpty()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) of all nodes of the edges (u, v); a component's name is its least node.

    Edges of one task are contracted first; rounds of stars join what lies in several tasks, until every edge
    leads to a least node. Their number grows with the logarithm of the longest chain of tasks' parts. Edges that are
    few enough for the ``LOCAL_NODES`` of one task need no round: that task joins them for good, to the same stars.
    Loops, repeated and reversed edges, nulls (dropped) and empty tables are fine. Memory does not depend on the size
    of a component.
    """
    state = stored(_contracted(edges.select("u", "v").filter("u != v")).distinct(), label)
    while not (fits := 2 * state.count() <= LOCAL_NODES) and not _flat(state):
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        small = _least(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        # Read back, small files share tasks, so that more is contracted at once.
        starred = stored(small.filter("u != v").distinct(), label)
        release(state)
        state = stored(_contracted(starred).distinct(), label)
        release(starred)
    if fits:
        before, state = state, stored(_contracted(state.coalesce(1)), label)
        release(before)
    nodes = state.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(state.select("v", "v").distinct())
