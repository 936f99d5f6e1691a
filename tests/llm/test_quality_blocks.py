"""The quality score learns from all labelled rows, dealt to blocks."""

import random
import zlib

import numpy as np
import pytest

from locusframe.llm import quality


def made(chance: random.Random, count: int) -> list[str]:
    return ["".join(chance.choice("abcdeXYZ019 .,;\n") for _ in range(chance.randint(20, 60))) for _ in range(count)]


def free(i: int) -> bool:
    return zlib.crc32(str(i).encode()) % 5 != 0


def test_decision_point_is_the_quantile_of_all_labelled_rows(spark):
    """30,000 labelled rows whose labels say nothing: a part of them has another quantile."""
    chance = random.Random(1)
    rows = [(i, t, int(chance.random() < 0.6)) for i, t in enumerate(made(chance, 30_000))]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    below = {r["doc_id"] for r in quality.score_quality(docs, docs, labels).filter("score < 0.3").collect()}
    assert abs(sum(free(i) for i in below) - sum(free(i) and not y for i, _, y in rows)) <= 1


@pytest.mark.parametrize("rare", [150, 3])
def test_every_labelled_row_is_in_a_block_with_both_kinds(spark, monkeypatch, rare):
    monkeypatch.setattr(quality, "BLOCK_ROWS", 100)
    monkeypatch.setattr(quality, "KIND_ROWS", 20)
    texts = made(random.Random(2), 800)
    rows = [(i, t, int(i < rare)) for i, t in enumerate([*texts, *texts[:5]])]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], 1 if r[0] == 800 else r[2]) for r in rows] + [(1, 1)], "doc_id long, y int")
    found = quality.labelled_rows(docs, labels, "text")
    blocks = quality.dealt(found).collect()
    assert len(blocks) == -(-found.count() // 100)
    own = 0
    for b in blocks:
        y, w = (np.frombuffer(bytes(b[c]), np.int64) for c in ("ys", "ws"))
        own += int((w * np.frombuffer(bytes(b["own"]), bool)).sum())
        assert w[y == 1].sum() >= min(rare, 10) and w[y == 0].sum() >= 20
    assert own == 806


def test_one_block_equals_plain_newton_steps(spark):
    chance = random.Random(3)
    texts = made(chance, 300)
    texts[20:40] = texts[:20]
    rows = [(i, t, int(t.count("a") + chance.random() * 3 > 3)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    used = [r for r in rows if free(r[0])]
    x = np.array([quality.vector(t) for _, t, _ in used]).astype(np.float32).astype(float)
    y = np.array([r[2] for r in used])
    order = np.lexsort((*x.T[quality.SHARES - 1 : 7 : -1], *x.T[:8], y))
    x, y = x[order], y[order]
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    draw, good, bad = np.random.default_rng(7), np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    pairs = max(len(y), 4 * min(len(good), len(bad)))
    z = (x - mean) / scale
    d = z[draw.choice(good, pairs)] - z[draw.choice(bad, pairs)]
    weights = np.zeros(quality.WIDTH)
    for _ in range(15):
        p = quality.sigmoid(d @ weights)
        bend = (d * (p * (1 - p))[:, None]).T @ d + np.eye(quality.WIDTH)
        weights -= np.linalg.solve(bend, d.T @ (p - 1) + weights)
    point = np.quantile(z @ weights, len(bad) / len(y))
    every = (np.array([quality.vector(t) for t in texts]) - mean) / scale
    expected = quality.sigmoid(every @ weights - point + np.log(0.3 / 0.7))
    found = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, docs, labels).collect()}
    assert np.allclose([found[i] for i in range(300)], expected, rtol=1e-6)


def test_quantiles_are_exact(spark, monkeypatch):
    monkeypatch.setattr(quality, "SORTED", 10)
    monkeypatch.setattr(quality, "BINS", 4)
    chance = np.random.default_rng(4)
    values = np.r_[chance.normal(size=200), np.full(50, 0.25), chance.normal(size=50) * 1e-9, 1e6]
    times = chance.integers(1, 4, len(values))
    frame = spark.createDataFrame(list(zip(values.tolist(), times.tolist(), strict=True)), "s double, w long").cache()
    every = np.repeat(values, times)
    for share in (0.0, 0.37, 0.6, 1.0):
        assert np.isclose(quality.quantile(frame, len(every), share), np.quantile(every, share), rtol=1e-12)
    assert quality.quantile(spark.createDataFrame([(2.5, 7)], "s double, w long"), 7, 0.4) == 2.5
