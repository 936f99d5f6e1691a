"""Token counts by byte-pair merging, without making token ids.

A text is cut into the pre-tokens of the vocabulary's pattern. The symbols of a pre-token form a linked
list; a heap holds every adjacent pair that has a merge rank. The pair of lowest rank (leftmost among
equals) is merged again and again; a popped pair whose symbols have changed is skipped. The number of
tokens is the number of first symbols less the number of merges. Pre-tokens repeat, so each worker keeps
the counts of recent ones in a bounded memo.

Nulls and empty texts have 0 tokens. Repeated rows are counted each on their own; long texts are read
whole. Columns of the input other than the text pass through; the added columns are called ``n_bytes``
and ``n_tokens`` and replace input columns of these names.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from locusframe.llm.common import Recent

# Fixed value: the pattern that byte-level vocabularies cut text with before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    shown = set(plain)
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def merges_made(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> int:
    """How many merges the symbols allow; ``ranks`` gives a pair's rank and the symbol it becomes."""
    n = len(symbols)
    if n < 2:
        return 0
    find = ranks.get
    heap = []
    for i in range(n - 1):
        pair = (symbols[i], symbols[i + 1])
        if (hit := find(pair)) is not None:
            heap.append((hit[0], i, pair, hit[1]))
    if not heap:
        return 0
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    made = 0
    while heap:
        _, i, (left, right), merged = pop(heap)
        j = after[i]
        if j >= n or symbols[i] != left or symbols[j] != right:
            continue
        made += 1
        symbols[i], symbols[j] = merged, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            pair = (merged, symbols[k])
            if (hit := find(pair)) is not None:
                push(heap, (hit[0], i, pair, hit[1]))
        if (h := before[i]) >= 0:
            pair = (symbols[h], merged)
            if (hit := find(pair)) is not None:
                push(heap, (hit[0], h, pair, hit[1]))
    return made


class _Unclean(Exception):
    """A piece between spaces is empty or has white space at an end."""


class Counter:
    """Counts tokens under one vocabulary, given as the text of its JSON file."""

    def __init__(self, vocabulary: str):
        import regex

        spec = json.loads(vocabulary)
        ids = spec["model"]["vocab"]
        self.first = [ids[s] for s in byte_symbols()]
        self.ranks = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[ids[left], ids[right]] = (rank, ids[left + right])
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.pieces = regex.compile(PATTERN).findall
        self.of_token = Recent(self._token, 400_000)
        self.of_word = Recent(self._word, 400_000)

    def _token(self, token: str) -> int:
        data = token.encode()
        return len(data) - merges_made([self.first[b] for b in data], self.ranks)

    def _plain(self, text: str) -> int:
        return sum(map(self.of_token.__getitem__, self.pieces(text)))

    def _word(self, word: str) -> int:
        """Tokens of a space and a word; such a cut never splits a pre-token if the word is clean."""
        if not word or word[0].isspace() or word[-1].isspace():
            raise _Unclean
        return self._plain(" " + word)

    def _part(self, text: str) -> int:
        words = text.split(" ")
        head = words[0]
        try:
            if not head or head[-1].isspace():
                raise _Unclean
            return self._plain(head) + sum(map(self.of_word.__getitem__, words[1:]))
        except _Unclean:
            pass
        total, run, joined = 0, [head], bool(head) and not head[-1].isspace()
        for word in words[1:]:
            if joined and word and not word[0].isspace():
                total += self._plain(" ".join(run))
                run = ["", word]
            else:
                run.append(word)
            joined = bool(word) and not word[-1].isspace()
        return total + self._plain(" ".join(run))

    def count(self, text: str) -> int:
        if not text:
            return 0
        if self.special is None:
            return self._part(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self._part(p) for p in parts if p)


@lru_cache(maxsize=2)
def _counter(vocabulary: str) -> Counter:
    return Counter(vocabulary)


def token_counts(documents: DataFrame, vocabulary_path: str, text: str = "text") -> DataFrame:
    """Adds ``n_bytes`` (UTF-8) and ``n_tokens``. The vocabulary file is read by the driver and sent along."""
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = documents.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf(LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(vocabulary.value)
        for batch in batches:
            yield batch.map(lambda t: counter.count(t) if t else 0).astype("int64")

    return documents.withColumns(
        {"n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"), "n_tokens": count(F.coalesce(text, F.lit("")))}
    )
