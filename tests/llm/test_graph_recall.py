"""Recall of the graph search on vectors of mixed lengths, and of one shard as large as the default allows."""

import inspect

import numpy as np
from pyspark.sql import functions as F

from locusframe.llm import graphsearch


def recall_by_brute_force(spark, vectors, k=10):
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    rows = graphsearch.nearest(frame, F.col("vec_id") % 20 == 0, k=k).collect()
    found = {}
    for r in rows:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in range(0, len(vectors), 20):
        score = vectors @ vectors[q]
        score[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-score, kind="stable")[:k].tolist()))
    return hits / (k * len(range(0, len(vectors), 20)))


def test_recall_with_one_very_long_vector(spark):
    vectors = np.random.default_rng(1).normal(size=(2000, 24))
    vectors[777] *= 1e4
    assert recall_by_brute_force(spark, vectors) >= 0.95


def test_recall_of_lengths_over_many_powers(spark):
    chance = np.random.default_rng(2)
    vectors = chance.normal(size=(1500, 16)) * 10.0 ** chance.uniform(-30, 30, (1500, 1))
    assert recall_by_brute_force(spark, vectors) >= 0.95


def test_recall_of_a_shard_of_the_default_size():
    rows = inspect.signature(graphsearch.nearest).parameters["rows_per_shard"].default
    vectors = np.random.default_rng(3).normal(size=(rows, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    space = graphsearch.lifted(vectors)
    edges, starts = graphsearch.build(space)
    asked = vectors[::100]
    flat = np.concatenate([asked, np.zeros((len(asked), 1))], 1).astype(np.float32)
    met, _ = graphsearch.beam_search(space, edges.astype(np.int64), starts, flat, 80)
    hits = 0
    for q, ids in zip(asked, met, strict=True):
        best = set(np.argsort(-(vectors @ q), kind="stable")[:21].tolist())
        mine = ids[ids >= 0]
        mine = mine[np.argsort(-(vectors[mine] @ q), kind="stable")][:21]
        hits += len(best & set(mine.tolist()))
    share = hits / (21 * len(asked))
    print("recall", share)
    assert share >= 0.9
