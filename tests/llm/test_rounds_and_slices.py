"""The n-gram join in many small cells and rounds, and trigrams counted in slices."""

import random
import re

import numpy as np

from locusframe.llm import ngramjoin, toxicity


def test_join_in_small_cells_and_many_rounds_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngramjoin, "CELL_BYTES", 4_000)
    monkeypatch.setattr(ngramjoin, "FIRST_CANDIDATES", 1)
    chance = random.Random(9)
    texts = []
    for _ in range(4):
        base = [f"w{chance.randint(0, 400)}" for _ in range(60)]
        for _ in range(15):
            near = list(base)
            for _ in range(chance.randint(0, 3)):
                near[chance.randrange(60)] = f"v{chance.randint(0, 9)}"
            texts.append(" ".join(near))
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r[0]: (r[1], r[2]) for r in ngramjoin.near_duplicates(frame).collect()}
    sets = {}
    for i, text in rows:
        words = re.findall(r"\S+", text)
        sets[i] = {tuple(words[k : k + 4]) for k in range(len(words) - 3)}
    name = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in range(i):
                if name[i] != name[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                    name[i] = name[j] = min(name[i], name[j])
                    changed = True
    assert found == {i: (len(sets[i]), name[i]) for i in sets}


def test_trigrams_do_not_depend_on_slices(monkeypatch):
    chance = random.Random(1)
    texts = ["".join(chance.choice("abc dé\n.Ü漢") for _ in range(chance.randint(0, 50))) for _ in range(100)] + [None, ""]
    expected = sum((toxicity._trigrams_of(f"  {t.lower()}  ") for t in texts if t), np.zeros(toxicity.SYMBOLS**3, np.int64))
    for size in (7, 64, 1000, 1 << 20):
        monkeypatch.setattr(toxicity, "SLICE", size)
        assert (toxicity.count_trigrams(texts) == expected).all()


def test_words_that_sums_of_powers_confuse_stay_apart(spark):
    """The Thue-Morse word and its complement have equal sums of powers modulo 2^64, whatever the base."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = spark.createDataFrame([(1, word[:1024]), (2, other[:1024]), (3, word), (4, other), (5, word)], "doc_id long, text string")
    found = ngramjoin.near_duplicates(rows, 4, 85).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 3)]


def test_words_are_told_apart_by_all_their_bytes():
    chance = np.random.default_rng(8)
    words = {bytes(chance.integers(97, 99, size).astype(np.uint8)) for size in range(1, 90) for _ in range(40)}
    words = sorted(words)
    data = np.frombuffer(b" ".join(words), np.uint8)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = end - [len(w) for w in words]
    hashes = ngramjoin.word_hashes(data, start, end)
    assert len(set(hashes.tolist())) == len(words)
    one = ngramjoin.word_hashes(np.frombuffer(words[77], np.uint8), np.array([0]), np.array([len(words[77])]))
    assert one[0] == hashes[77]
