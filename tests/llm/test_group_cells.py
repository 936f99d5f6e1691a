"""What the second round of the n-gram join sends, when many groups are joined by few classes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusframe.llm import common, ngramjoin


def words(chance: random.Random, count: int) -> list[str]:
    return ["".join(chance.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(count)]


@pytest.fixture
def sent(monkeypatch):
    """Bytes that the cells of the first round get, and rows of open groups."""
    seen = {"bytes": 0, "open": 0}

    def counted(frame, label):
        back = common.stored(frame, label)
        if label == "open-grams":
            seen["open"] = back.count()
        if label == "arenas":
            size = F.sum(F.col("bytes") * F.ceil(F.col("bytes") / ngramjoin.CELL_BYTES))
            seen["bytes"] = back.agg(size).first()[0] or 0
        return back

    monkeypatch.setattr(ngramjoin, "stored", counted)
    return seen


def chained(chance: random.Random, count: int, group: int) -> list[str]:
    """Texts of equal size, no two of them similar, of which each shares a passage with ``group`` others before it, and one with those after."""
    passages = [words(chance, 4) for _ in range(count // group + 2)]
    return [" ".join([*passages[i // group], *words(chance, 56), *passages[i // group + 1]]) for i in range(count)]


@pytest.mark.parametrize("group", [2, 40])
def test_chains_of_groups_do_not_send_all_classes_to_all_parts(spark, sent, monkeypatch, group):
    monkeypatch.setattr(ngramjoin, "CELL_BYTES", 20_000)
    # All texts' n-grams have one counter, so that only their hashes order them.
    monkeypatch.setattr(ngramjoin, "gram_counts", lambda docs, n: np.zeros(ngramjoin.COUNTERS, np.uint32))
    texts = chained(random.Random(group), 1200, group)
    found = ngramjoin.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 4, 60)
    assert all(r["doc_id"] == r["component_id"] for r in found.collect())
    assert sent["open"] > 300
    assert sent["bytes"] <= 1.5 * sent["open"] * (ngramjoin.RANGES + 12)


def test_pairs_of_small_groups_are_linked(spark, sent):
    """Copies whose neighbours by size in each group are other texts: only listed pairs of a group link them."""
    chance, texts = random.Random(5), []
    for _ in range(8):
        base = words(chance, 60)
        texts += [" ".join([*base[:k], *words(chance, 3), *base[k:]]) for k in (10, 30, 50)]
        texts += [" ".join(base[:20] + words(chance, 40 + k)) for k in range(3)]
    found = ngramjoin.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 4, 60)
    expected = {i: i - i % 6 if i % 6 < 3 else i for i in range(48)}
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == expected
    assert sent["bytes"] == 0


def test_unrelated_long_sets_are_told_apart_by_their_spreads():
    chance = np.random.default_rng(6)
    draw = lambda size: np.unique(chance.integers(0, 2**63, size, np.uint64) * np.uint64(2) + np.uint64(1))
    for size in (300, 5_000, 20_000, 70_000):
        x, other = draw(size), draw(int(size * 0.9))
        near = np.unique(np.r_[x[: int(size * 0.93)], other[: int(size * 0.02)]])
        spreads = [ngramjoin.spread_of(s) for s in (x, other, near)]
        most = [(len(x) + len(s)) * 20 / 180 for s in (other, near)]
        assert ngramjoin.difference(spreads[0], spreads[1]) > most[0]
        assert ngramjoin.difference(spreads[0], spreads[2]) <= len(np.setxor1d(x, near)) <= most[1]
        assert len(spreads[0]) <= max(256, size // 8)
