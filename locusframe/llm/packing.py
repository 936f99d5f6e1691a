"""Packing of tokenized documents into sequences by a grouping genetic algorithm.

A document's tokens are those of a ``tokenizers`` vocabulary, without added special tokens, and an end id.
Documents longer than a sequence are cut into full pieces and a last, shorter one. Full pieces are
sequences of their own. The other pieces are dealt at random into blocks of about ``block`` pieces, and
each block is packed by itself:

* A solution is a bin number for every piece. The first ones are best-fit packings, one of them in
  falling order of length, the others in a disturbed order.
* Crossover puts well-filled bins of one parent whole into the other. Bins of the other that hold one of
  their pieces are dissolved; pieces that lose their bin so are placed by best fit, long ones first.
* Mutation dissolves the emptiest bins and a few random ones.
* Each block has several islands that evolve apart. Between epochs an island's best solution goes to the
  next island of its block. A block whose best solution needs no more bins than its tokens fill is done.

The state between epochs is a table with a row per block and island, so a lost executor costs the tasks it
ran. Random choices are seeded by block, island and epoch.

Null or empty texts are one piece with the end id alone. Repeated rows, equal ids and ties are packed each
on their own. An empty table gives an empty result. The result has its own columns and none of the
input's but the id.
"""

from __future__ import annotations

import os
import random
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from locusframe.llm.common import Recent, stored
from locusframe.llm.tokencount import byte_symbols

END_ID = 1
_TOKENS = StructType([StructField("n_tokens", LongType()), StructField("crcs", ArrayType(LongType()))])


class Tokens:
    """Little-endian 32-bit ids of texts, under a vocabulary given as the text of its JSON file.

    No pre-token of the vocabulary holds white space, so the ids of a text are those of its words one
    after the other. Words repeat and are kept in a bounded memo. Letters that the vocabulary's normalizer
    only lower-cases go to its model at once; all other words go through the whole library.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary)
        self.model = self.library.model
        self.shown = {chr(b): "".join(byte_symbols()[x] for x in chr(b).encode()) for b in range(0x180)}
        # At most some 60 MB together: a memo holds twice as many words at 150 bytes.
        self.of_word = Recent(self._word, 200_000)
        self.of_other = Recent(self._whole, 50_000)

    def _whole(self, word: str) -> bytes:
        return array("I", self.library.encode(word, add_special_tokens=False).ids).tobytes()

    def _letters(self, word: str) -> bytes:
        word = word.lower()
        if not word.isascii():
            word = "".join(map(self.shown.__getitem__, word))
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _word(self, word: str) -> bytes:
        letters = word.rstrip(".,;:!?")
        # U+0130 is the one letter below U+0180 whose lower case is no longer letters only.
        if letters.isalpha() and (letters.isascii() or (max(letters) < "\u0180" and "\u0130" not in letters)):
            if len(letters) == len(word):
                return self._letters(word)
            return self.of_word[letters] + self.of_other[word[len(letters) :]]
        return self.of_other[word] if word else b""

    def forget(self) -> None:
        self.of_word.forget()
        self.of_other.forget()

    def ids(self, text: str) -> bytes:
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.of_word.__getitem__, words))


@lru_cache(maxsize=2)
def _tokens(vocabulary: str) -> Tokens:
    return Tokens(vocabulary)


def document_pieces(documents: DataFrame, vocabulary_path: str, size: int, id_column: str, text: str) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every piece of at most ``size`` tokens."""
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = documents.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf(_TOKENS)
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder, end = _tokens(vocabulary.value), np.array([END_ID], "<u4").tobytes()
        try:
            for batch in batches:
                counts, crcs = [], []
                for text in batch:
                    data = encoder.ids(text or "") + end
                    counts.append(len(data) // 4)
                    crcs.append([zlib.crc32(data[i : i + 4 * size]) for i in range(0, len(data), 4 * size)])
                yield pd.DataFrame({"n_tokens": counts, "crcs": crcs})
        finally:
            encoder.forget()

    found = documents.select(F.col(id_column), tokens(F.coalesce(F.col(text), F.lit(""))).alias("t"))
    pieces = found.select(id_column, F.col("t.n_tokens").alias("n"), F.posexplode("t.crcs").alias("piece", "ids_crc32"))
    start = F.col("piece").cast("long") * size
    return pieces.select(
        id_column, "piece", start.alias("start"), F.least(F.lit(size), F.col("n") - start).alias("length"), "ids_crc32"
    )


def best_fit(lengths: list[int], order, bins: np.ndarray, room: list[int], size: int) -> None:
    """Puts the pieces of ``order`` into the fullest open bin with room, or a new one; changes its arguments."""
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    mask = 0
    for number, left in enumerate(room):
        by_room[left].append(number)
        mask |= 1 << left
    for item in order:
        need = lengths[item]
        rest = mask >> need
        if rest:
            left = need + (rest & -rest).bit_length() - 1
            here = by_room[left]
            number = here.pop()
            if not here:
                mask ^= 1 << left
        else:
            number, left = len(room), size
            room.append(size)
        bins[item] = number
        left -= need
        room[number] = left
        if not by_room[left]:
            mask |= 1 << left
        by_room[left].append(number)


class Block:
    """Solutions of one block of pieces."""

    def __init__(self, lengths: np.ndarray, size: int):
        self.size, self.lengths, self.list = size, lengths, lengths.tolist()
        self.least = -(-int(lengths.sum()) // size)
        self.falling = np.argsort(-lengths, kind="stable")

    def count(self, bins: np.ndarray) -> int:
        return int(bins.max()) + 1 if len(bins) else 0

    def fitness(self, bins: np.ndarray) -> float:
        """Few bins first, then unevenly filled ones: those leave room to empty another bin."""
        fill = np.bincount(bins, self.lengths) / self.size
        return float((fill**2).sum() / len(fill)) - len(fill)

    def finish(self, bins: np.ndarray) -> np.ndarray:
        """Places the pieces whose bin is -1, after renumbering the bins in use."""
        placed = bins >= 0
        used, numbers = np.unique(bins[placed], return_inverse=True)
        bins[placed] = numbers
        room = (self.size - np.bincount(numbers, self.lengths[placed], len(used)).astype(int)).tolist()
        best_fit(self.list, [i for i in self.falling.tolist() if not placed[i]], bins, room, self.size)
        return bins

    def first(self, chance: random.Random, disturbed: bool) -> np.ndarray:
        order = self.falling.tolist()
        if disturbed:
            order.sort(key=lambda i: -self.list[i] * chance.uniform(0.7, 1.0))
        bins = np.full(len(self.list), -1)
        best_fit(self.list, order, bins, [], self.size)
        return bins

    def cross(self, giver: np.ndarray, taker: np.ndarray, chance: random.Random) -> np.ndarray:
        fill = np.bincount(giver, self.lengths)
        good = np.flatnonzero(fill >= np.median(fill))
        given = np.zeros(len(fill), bool)
        given[chance.sample(good.tolist(), max(1, len(good) // 3))] = True
        injected = given[giver]
        broken = np.zeros(taker.max() + 1, bool)
        broken[taker[injected]] = True
        child = np.where(broken[taker], -1, taker)
        child[injected] = giver[injected] + taker.max() + 1
        return self.finish(child)

    def mutate(self, bins: np.ndarray, chance: random.Random) -> np.ndarray:
        fill = np.bincount(bins, self.lengths)
        gone = np.zeros(len(fill), bool)
        gone[np.argsort(fill, kind="stable")[: max(1, len(fill) // 50)]] = True
        gone[[chance.randrange(len(fill)) for _ in range(max(1, len(fill) // 50))]] = True
        return self.finish(np.where(gone[bins], -1, bins))

    def evolve(self, population: list[np.ndarray], chance: random.Random, generations: int, keep: int):
        for _ in range(generations):
            population.sort(key=self.fitness, reverse=True)
            if self.count(population[0]) <= self.least:
                break
            one, two = chance.sample(population, 2) if len(population) > 1 else (population[0], population[0])
            population.append(self.mutate(self.cross(one, two, chance), chance))
            population.append(self.mutate(population[0], chance))
            population.sort(key=self.fitness, reverse=True)
            del population[keep:]
        population.sort(key=self.fitness, reverse=True)
        return population[:keep]


_STATE = "block long, island int, lengths array<int>, population array<array<int>>, done boolean"


def _epoch(size: int, epoch: int, generations: int, keep: int, seed: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                block = Block(np.asarray(row.lengths, np.int64), size)
                chance = random.Random(f"{seed}/{row.block}/{row.island}/{epoch}")
                people = [np.asarray(p, np.int64) for p in row.population]
                if not people:
                    people = [block.first(chance, bool(i or row.island)) for i in range(keep)]
                people = block.evolve(people, chance, generations, keep)
                done = block.count(people[0]) <= block.least
                out.append((row.block, row.island, row.lengths, [p.astype(np.int32) for p in people], done))
            yield pd.DataFrame(out, columns=["block", "island", "lengths", "population", "done"])

    return run


def _lay_out(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of (id, piece, start, length, ids_crc32, sequence_id, offset) of packed blocks."""
    for frame in frames:
        for row in frame.itertuples(index=False):
            bins = np.asarray(row.bins, np.int64)
            lengths = np.array([i["length"] for i in row.items], np.int64)
            order = np.argsort(bins, kind="stable")
            total = np.cumsum(lengths[order]) - lengths[order]
            starts = np.r_[True, np.diff(bins[order]) > 0]
            base = np.maximum.accumulate(np.where(starts, total, 0))
            items = [row.items[i] for i in order]
            columns = {k: pd.Series([i[k] for i in items], dtype=object) for k in ("id", "piece", "start", "length", "ids_crc32")}
            yield pd.DataFrame(columns | {"sequence_id": (row.block << 32) + bins[order], "offset": total - base})


def pack(
    documents: DataFrame, vocabulary_path: str, size: int = 4096, block: int = 8192, islands: int = 2, epochs: int = 2,
    generations: int = 4, keep: int = 3, seed: int = 17, id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset`` in the sequence."""
    pieces = stored(document_pieces(documents, vocabulary_path, size, id_column, text), "pieces")
    id_type = pieces.schema[id_column].dataType.simpleString()
    full = pieces.filter(F.col("length") == size)
    rest = pieces.filter(F.col("length") < size)
    blocks = max(1, round(rest.count() / block))
    # A piece's place in the stored table deals equal rows to different blocks, too.
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)), F.lit(blocks))
    item = F.struct(F.col(id_column).alias("id"), "piece", "start", "length", "ids_crc32")
    packed = stored(
        rest.select(dealt.alias("block"), item.alias("item")).groupBy("block").agg(F.array_sort(F.collect_list("item")).alias("items")),
        "blocks",
    )
    nobody = F.array().cast("array<array<int>>")
    state = packed.select(
        "block",
        F.explode(F.array(*(F.lit(i) for i in range(islands)))).alias("island"),
        F.transform("items", lambda i: i["length"].cast("int")).alias("lengths"),
        nobody.alias("population"),
        F.lit(False).alias("done"),
    ).repartition("block", "island")
    results = []
    for epoch in range(epochs):
        state = stored(state.mapInPandas(_epoch(size, epoch, generations, keep, seed), _STATE), "islands")
        best = F.col("population")[0]
        results.append(state.select("block", F.struct(F.array_max(best).alias("bins"), "island", best.alias("of")).alias("best")))
        over = state.groupBy("block").agg(F.max("done").alias("over"))
        going = over.filter(~F.col("over")).select("block")
        if epoch + 1 == epochs or not going.limit(1).count():
            break
        elite = state.select("block", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), best.alias("elite"))
        state = state.join(going, "block", "left_semi").join(elite, ["block", "island"])
        state = state.withColumn("population", F.array_append("population", F.col("elite"))).drop("elite")
    best = reduce(DataFrame.union, results).groupBy("block").agg(F.min("best").alias("best"))
    laid = (
        packed.join(best, "block")
        .select("block", "items", F.col("best.of").alias("bins"))
        .mapInPandas(
            _lay_out,
            f"id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
        )
        .withColumnRenamed("id", id_column)
    )
    # Full pieces get numbers below 0, so they never meet those of the blocks.
    alone = full.withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    return alone.select(laid.columns).union(laid)
