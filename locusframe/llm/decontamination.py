"""Benchmark decontamination: training passages query a BM25 index of test items by block-max WAND.

Index. Words are lower-cased runs of characters other than white space and ASCII punctuation. An item's
score for a passage is the sum of the BM25 impacts of the item's words that the passage holds, over the sum of
all its words' impacts: 1 if all are there. Word weights come from all items. Items are dealt to index parts
of at most ``items_per_part``; a part's index is broadcast, so its size is bounded whatever the benchmark's
size, and each part costs one pass over the documents.

Search. A document is cut into overlapping passages as long as two of the longest item, so every item lies
wholly in some passage. For all passages of a batch at once, the block maxima of their distinct words are
added per block of items; no item of a block can score more. Passages with a block above the threshold go
through WAND: cursors on the words' postings, a pivot by the words' largest impacts, the blocks' maxima
for it, and full scores for what is left. All items at or above the threshold are found, without a limit.

Verification. An item's question is its text but the last line (or sentence), its answer that last line or
sentence; an item of one sentence is cut after two thirds of its words. A pair counts when the passage holds
``overlap`` of the question's and of the answer's five-word shingles (shorter parts: the whole part).

Null and empty texts match nothing, and so do items without words. Repeated items match each on their own.
With empty tables nothing matches. Columns of the input pass through; ``matches`` is added and replaces
an input column of that name.
"""

from __future__ import annotations

import math
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import column, stored, unpacked, whole_row

K1, B = 1.2, 0.75
SHINGLE = 5
_SPACES = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
_MATCHES = "array<struct<item_id:long,score:double,question_overlap:double,answer_overlap:double>>"


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(_SPACES).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    stripped = text.strip()
    for mark in ("\n", "? ", ". ", "! "):
        at = stripped.rstrip(".!?").rfind(mark)
        if at >= 0:
            question, answer = words(stripped[: at + 1]), words(stripped[at + 1 :])
            if question and answer:
                return question, answer
    all_words = words(stripped)
    cut = max(1, len(all_words) * 2 // 3)
    return all_words[:cut], all_words[cut:]


def shingles(part: list[bytes]) -> set[tuple[bytes, ...]]:
    size = min(SHINGLE, len(part))
    return {tuple(part[i : i + size]) for i in range(len(part) - size + 1)} if part else set()


def held(part: list[bytes], passage: list[bytes]) -> float:
    """The share of the part's shingles that the passage holds; 1 for an empty part."""
    wanted = shingles(part)
    if not wanted:
        return 1.0
    size = len(next(iter(wanted)))
    there = {tuple(passage[i : i + size]) for i in range(len(passage) - size + 1)}
    return len(wanted & there) / len(wanted)


class Index:
    """Postings of one part of the items, with largest impacts per word and per block of items."""

    def __init__(self, items, frequency: dict[bytes, int], total: int, mean_length: float, threshold: float, overlap: float, block: int):
        self.threshold, self.overlap, self.block = threshold, overlap, block
        self.items = sorted(((i, t) for i, t in items if words(t)), key=lambda e: e[0])
        self.parts = [question_and_answer(t) for _, t in self.items]
        self.longest = max((len(words(t)) for _, t in self.items), default=1)
        blocks = -(-len(self.items) // block) or 1
        self.number: dict[bytes, int] = {}
        postings: list[list[tuple[int, float]]] = [[]]
        for place, (_, text) in enumerate(self.items):
            bag = Counter(words(text))
            length = K1 * (1 - B + B * sum(bag.values()) / mean_length)
            impact = {
                w: math.log(1 + (total - frequency[w] + 0.5) / (frequency[w] + 0.5)) * n * (K1 + 1) / (n + length)
                for w, n in bag.items()
            }
            whole = sum(impact.values())
            for w, value in impact.items():
                term = self.number.setdefault(w, len(self.number) + 1)
                if term == len(postings):
                    postings.append([])
                postings[term].append((place, value / whole))
        self.places = [[p for p, _ in ps] for ps in postings]
        self.impacts = [[v for _, v in ps] for ps in postings]
        self.block_max = np.zeros((len(postings), blocks), np.float32)
        for term, ps in enumerate(postings):
            for place, value in ps:
                self.block_max[term, place // block] = max(self.block_max[term, place // block], value)
        self.most = self.block_max.max(1).tolist() if len(postings) else []
        # Sums in single precision may be a little low.
        self.screen = np.float32(threshold * 0.999)

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """Items (places) with a score of at least the threshold for the distinct ``terms``."""
        threshold = self.threshold - 1e-9
        cursors = [[self.places[t][0], 0, t] for t in terms]
        found = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for i, (_, _, t) in enumerate(cursors):
                bound += self.most[t]
                if bound >= threshold:
                    pivot = i
                    break
            if pivot < 0:
                break
            place = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == place:
                pivot += 1
            here = place // self.block
            if sum(float(self.block_max[t, here]) for _, _, t in cursors[: pivot + 1]) < threshold * 0.999:
                # No item up to the block's end, or the next cursor, can reach the threshold.
                goal = (here + 1) * self.block
                if pivot + 1 < len(cursors):
                    goal = min(goal, cursors[pivot + 1][0])
                goal = max(goal, place + 1)
                moved = cursors[: pivot + 1]
            elif cursors[0][0] == place:
                score = sum(self.impacts[t][i] for p, i, t in cursors if p == place)
                if score >= threshold:
                    found.append((place, score))
                goal, moved = place + 1, [c for c in cursors if c[0] == place]
            else:
                goal, moved = place, [c for c in cursors if c[0] < place]
            for c in moved:
                c[1] = bisect_left(self.places[c[2]], goal, c[1])
                c[0] = self.places[c[2]][c[1]] if c[1] < len(self.places[c[2]]) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def matches(self, texts: list[str | None]) -> list[list[tuple[int, float, float, float]]]:
        """(item, score, question overlap, answer overlap) of every text's verified items."""
        results: list[list[tuple[int, float, float, float]]] = [[] for _ in texts]
        if not self.items:
            return results
        number, width = self.number, len(self.places)
        split = [words(t) for t in texts]
        # Passages are two neighbouring segments of the longest item's length.
        terms, owners = [], []
        segments = 0
        firsts = []
        for ws in split:
            firsts.append(segments)
            ids = np.fromiter((number.get(w, 0) for w in ws), np.int64, len(ws))
            at = np.flatnonzero(ids)
            terms.append(ids[at])
            owners.append(segments + at // self.longest)
            segments += len(ws) // self.longest + 2
        keys = np.unique(np.concatenate(owners) * width + np.concatenate(terms)) if owners else np.zeros(0, np.int64)
        if not len(keys):
            return results
        owner, term = keys // width, keys % width
        start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        bounds = np.zeros((segments + 1, self.block_max.shape[1]), np.float32)
        for i in range(0, len(start), 4096):
            part = start[i : i + 4096]
            stop = start[i + 4096] if i + 4096 < len(start) else len(keys)
            bounds[owner[part]] = np.add.reduceat(self.block_max[term[part[0] : stop]], part - part[0], axis=0)
        pairs = bounds[:-1] + bounds[1:]
        likely = np.flatnonzero(pairs.max(1) >= self.screen)
        of_text = np.searchsorted(firsts, likely, "right") - 1
        for segment, text in zip(likely.tolist(), of_text.tolist(), strict=True):
            begin = (segment - firsts[text]) * self.longest
            passage = split[text][begin : begin + 2 * self.longest]
            ids = {number[w] for w in passage if w in number}
            for place, score in self.search(list(ids)) if ids else ():
                question, answer = self.parts[place]
                one, two = held(question, passage), held(answer, passage)
                if one >= self.overlap and two >= self.overlap:
                    results[text].append((self.items[place][0], score, one, two))
        return [best(r) for r in results]


def best(found: list[tuple[int, float, float, float]]) -> list[tuple[int, float, float, float]]:
    """Each item once, with its largest figures, in order of the items."""
    largest: dict[int, tuple[float, float, float]] = {}
    for item, *figures in found:
        largest[item] = max(largest.get(item, (0.0, 0.0, 0.0)), tuple(figures))
    return [(item, *figures) for item, figures in sorted(largest.items())]


def find_matches(
    documents: DataFrame, benchmark: DataFrame, threshold: float = 0.6, overlap: float = 0.5,
    items_per_part: int = 500, block: int = 2, text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Adds ``matches``: the verified items of a document, an empty array if there is none."""
    context = documents.sparkSession.sparkContext
    items = benchmark.select(column(item_id).cast("long").alias("item"), column(item_text).alias("text"))
    items = items.filter(F.col("item").isNotNull() & F.col("text").isNotNull())

    def bag(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"item": frame["item"], "text": frame["text"], "words": [[*words(t)] for t in frame["text"]]})

    bags = stored(items.mapInPandas(bag, "item long, text string, words array<binary>").filter(F.size("words") > 0), "items")
    figures = bags.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("words")).alias("mean")).first()
    parts = max(1, -(-figures["n"] // items_per_part))
    frequency = bags.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    dealt = bags.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(parts)))
    rows = documents.select(
        whole_row(documents, ("matches",)), column(text).alias("_text"), F.array().cast(_MATCHES).alias("_matches")
    )
    for part in range(parts):
        here = dealt.filter(F.col("part") == part) if parts > 1 else bags
        wanted = here.select(F.explode("words").alias("w")).distinct()
        counts = {bytes(r["w"]): r["n"] for r in frequency.join(wanted, "w", "left_semi").collect()}
        texts = [(r["item"], r["text"]) for r in here.select("item", "text").collect()]
        index = context.broadcast(Index(texts, counts, figures["n"], figures["mean"] or 1.0, threshold, overlap, block))
        rows = rows.withColumn("_matches", F.concat("_matches", _matcher(index)(F.col("_text"))))
    return rows.select(*unpacked(rows), F.col("_matches").alias("matches"))


def _matcher(index):
    @F.pandas_udf(_MATCHES)
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("item_id", "score", "question_overlap", "answer_overlap")
        for batch in batches:
            found = []
            for i in range(0, len(batch), 500):
                found += index.value.matches(batch.iloc[i : i + 500].tolist())
            yield pd.Series([[dict(zip(names, m, strict=True)) for m in ms] for ms in found], dtype=object)

    return match
