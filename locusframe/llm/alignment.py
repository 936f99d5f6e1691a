"""Alignment of two tokenizers over a corpus, and scores of their id pairs by inverted bitmaps of documents.

A text gives two runs of tokens, A and B, over the same bytes. Offsets where tokens of both end cut them into
groups; an A token and a B token whose byte ranges overlap are a link. All offsets at which any token ends cut
the bytes into pieces, and each piece lies in just one A and one B token, so links are counted by pieces.

1. Chunks. A task deals its documents, in order, to chunks of up to ``docs`` documents or about ``chunk_bytes`` of
   text, and numbers them in their chunk. A document is never parted.
2. Postings. For each id pair, a chunk keeps bit planes over its documents: plane j holds the documents in which bit j
   of the pair's number of links is set. A plane is stored as sorted 16-bit numbers, or as bits where that is shorter.
   Planes of the batches of one chunk are united by OR when it is full: a document lies in one batch only.
3. Counts. The number of bits in the OR of a pair's planes is its number of documents; the bits of plane j, each 2**j
   times, are its links. A chunk's counts are added up by Spark for cells (pair and a bounded range of chunks),
   then for pairs. ``pair_counts`` gives these sums.
4. Scores. Counts go back to the postings' names over the cells, so that no task gets all chunks of a frequent pair; then
   each chunk gets its postings and their counts together and adds, for each document of a plane, 2**j times the count.

Texts null or empty, or whose tokens do not give back the text's bytes with one space before it, have no
tokens: zeros, and an empty digest. Repeated rows and ids each count on their own. Other columns of the input are
not read. An empty table gives an empty result. Special strings in texts are plain text.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusframe.llm.common import column, stored
from locusframe.llm.tokencount import PATTERN, byte_symbols

#: Documents of a chunk are numbered in 13 bits, so a plane as bits takes 1,024 bytes.
DOCS = 1 << 13
CHUNK_BYTES = 16_000_000
_BATCH_BYTES = 2_000_000
#: Tasks whose chunks share a cell of the counts.
_TASKS_PER_CELL = 64


def rank_encoder(spec: dict):
    """An encoder by ranks for a vocabulary in JSON, or None if the vocabulary is not of that kind.

    It is one if its ids are the bytes, then the merges in their order, and words are cut as byte-level vocabularies do;
    then a merge's rank is the id of what it makes. Such an encoder gives the same ids in a fifth of the time.
    """
    import tiktoken

    cut = spec.get("pre_tokenizer") or {}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ids = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"].get("merges", [])]
    plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    if not plain or spec.get("normalizer") or spec["model"].get("dropout") or spec["model"].get("ignore_merges"):
        return None
    value = {c: i for i, c in enumerate(byte_symbols())}
    if sorted(ids[c] for c in value if c in ids) != list(range(256)) or len(ids) != 256 + len(merges):
        return None
    if any(ids.get(left + right) != 256 + i for i, (left, right) in enumerate(merges)):
        return None
    ranks = {bytes(value[c] for c in token): i for token, i in ids.items()}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Vocabularies:
    """Both tokenizers, with the bytes of every token."""

    def __init__(self, a_model: str, b_model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece

        spec = json.loads(a_model)
        self.ranks, self.library = rank_encoder(spec), None
        if self.ranks is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(a_model)
            self.library.encode_special_tokens = True
            self.library.no_truncation()
            self.library.no_padding()
        value = {s: i for i, s in enumerate(byte_symbols())}
        names = {t["content"]: t["id"] for t in spec.get("added_tokens", [])} | spec["model"]["vocab"]
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for token, i in names.items():
            shown = all(c in value for c in token)
            self.a_bytes[i] = bytes(value[c] for c in token) if shown else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            whole = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            self.b_bytes.append(whole)
        self.a_length = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_length = np.array([len(t) for t in self.b_bytes], np.int64)
        # An id's text with the sign after it: 2 * id inside a group, 2 * id + 1 at its end.
        self.a_text = np.array([f"{i}{sign}" for i in range(len(self.a_bytes)) for sign in ",|"], object)
        self.b_text = np.array([f"{i}{sign}" for i in range(len(self.b_bytes)) for sign in ",;"], object)

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        if self.ranks is not None:
            return [self.ranks.encode_ordinary(t) for t in texts]
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of both tokenizers for each text; empty ones where the bytes do not come back."""
        spaced = [" " + t for t in texts]
        second = self.b.encode(texts, num_threads=1) if texts else []
        for text, a, b in zip(spaced, self.encode_a(spaced), second, strict=True):
            data = text.encode()
            same = b"".join(map(self.a_bytes.__getitem__, a)) == data and b"".join(map(self.b_bytes.__getitem__, b)) == data
            yield (a, b) if same and len(data) > 1 else ([], [])


@lru_cache(maxsize=1)
def _vocabularies(a_model: str, b_model: bytes) -> Vocabularies:
    return Vocabularies(a_model, b_model)


class Aligned:
    """Groups and links of a batch of texts, laid end to end as one run of bytes."""

    def __init__(self, words: Vocabularies, encoded: list[tuple[list[int], list[int]]]):
        self.words = words
        counts = np.array([(len(a), len(b)) for a, b in encoded], np.int64).reshape(-1, 2)
        self.n_a, self.n_b = counts.T
        self.a = np.concatenate([np.array(a, np.int64) for a, _ in encoded] or [np.zeros(0, np.int64)])
        self.b = np.concatenate([np.array(b, np.int64) for _, b in encoded] or [np.zeros(0, np.int64)])
        self.a_end, self.b_end = np.cumsum(words.a_length[self.a]), np.cumsum(words.b_length[self.b])
        # Texts' ends, in bytes; a text without tokens has no bytes here.
        self.ends = np.r_[0, self.a_end][np.cumsum(self.n_a)]
        a_ends, b_ends = (self._marks(e) for e in (self.a_end, self.b_end))
        both = a_ends & b_ends
        self.common, pieces = np.flatnonzero(both), np.flatnonzero(a_ends | b_ends)
        # How many tokens or groups have ended at each byte or before it.
        self.a_ended, self.b_ended, ended = (np.cumsum(m, dtype=np.int32) for m in (a_ends, b_ends, both))
        self.a_group, self.b_group = (ended[e] - both[e] for e in (self.a_end, self.b_end))
        self.n_groups = np.diff(ended[self.ends], prepend=0).astype(np.int64)
        self.link_a = self.a[self.a_ended[pieces] - a_ends[pieces]]
        self.link_b = self.b[self.b_ended[pieces] - b_ends[pieces]]
        self.n_links = np.diff(np.searchsorted(pieces, self.ends, side="right"), prepend=0)
        self.link_text = np.repeat(np.arange(len(encoded)), self.n_links)

    def _marks(self, places: np.ndarray) -> np.ndarray:
        marks = np.zeros((int(self.a_end[-1]) if len(self.a_end) else 0) + 1, bool)
        marks[places] = True
        return marks

    def groups(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        a_last = np.r_[self.a_group[1:] != self.a_group[:-1], True][: len(self.a)]
        b_last = np.r_[self.b_group[1:] != self.b_group[:-1], True][: len(self.b)]
        # In the text of groups, an A token stands behind the B tokens of earlier groups, a B token behind its group's A.
        before = np.r_[0, self.common]
        a_place = np.arange(len(self.a)) + self.b_ended[before[self.a_group]]
        b_place = np.arange(len(self.b)) + self.a_ended[before[self.b_group + 1]]
        shown = np.empty(len(self.a) + len(self.b), object)
        shown[a_place] = self.words.a_text[2 * self.a + a_last]
        shown[b_place] = self.words.b_text[2 * self.b + b_last]
        stops = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(shown[i:j].tolist())[:-1] for i, j in zip([0, *stops[:-1]], stops, strict=True)] if stops else []


def posting_keys(pairs: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (pair, document) keys in order, and how often each was met."""
    return np.unique((pairs.astype(np.uint64) << np.uint64(13)) | docs.astype(np.uint64), return_counts=True)


class Planes:
    """Bit planes over a chunk's documents for many pairs: plane j as sorted (pair, document) keys.

    Keys are 64-bit numbers with the document in the lowest 13 bits.
    """

    def __init__(self, planes: list[np.ndarray]):
        self.planes = planes

    @classmethod
    def counted(cls, keys: np.ndarray, counts: np.ndarray) -> Planes:
        most = int(counts.max(initial=0)).bit_length()
        return cls([keys[(counts >> j) & 1 == 1] for j in range(most)])

    @classmethod
    def united(cls, parts: list[Planes]) -> Planes:
        """The OR, plane by plane."""
        most = max((len(p.planes) for p in parts), default=0)
        some = [[p.planes[j] for p in parts if j < len(p.planes)] for j in range(most)]
        return cls([same[0] if len(same) == 1 else np.unique(np.concatenate(same)) for same in some])

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """(pairs, number of documents): bits in the OR of all planes of each pair."""
        every = np.unique(np.concatenate(self.planes)) if self.planes else np.zeros(0, np.uint64)
        return np.unique(every >> np.uint64(13), return_counts=True)

    def links(self, pairs: np.ndarray) -> np.ndarray:
        """Of each of all ``pairs``: bits of plane j, each 2**j times."""
        total = np.zeros(len(pairs), np.int64)
        for j, keys in enumerate(self.planes):
            total += np.bincount(np.searchsorted(pairs, keys >> np.uint64(13)), minlength=len(pairs)) << j
        return total


def compressed(docs: np.ndarray) -> bytes:
    """A plane of one pair: sorted 16-bit numbers or, where it is shorter, a bit for each document."""
    if 2 * len(docs) < DOCS // 8:
        return docs.astype("<u2").tobytes()
    bits = np.zeros(DOCS, bool)
    bits[docs] = True
    return np.packbits(bits).tobytes()


def expanded(plane: bytes) -> np.ndarray:
    if len(plane) < DOCS // 8:
        return np.frombuffer(plane, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(plane, np.uint8)))


def posting_columns(planes: Planes) -> dict[str, pa.Array]:
    """a, b, docs, links and planes of every pair; ``planes`` has an entry, perhaps an empty one, for each plane."""
    pairs, docs = planes.documents()
    links = planes.links(pairs)
    lists: list[list[bytes]] = [[] for _ in range(len(pairs))]
    limit = DOCS // 16
    for j, keys in enumerate(planes.planes):
        if not len(keys):
            continue
        numbers = (keys & np.uint64(DOCS - 1)).astype("<u2")
        mine, first = np.unique(keys >> np.uint64(13), return_index=True)
        ends = np.r_[first[1:], len(keys)]
        data = numbers.tobytes()
        for at, i, k in zip(np.searchsorted(pairs, mine).tolist(), first.tolist(), ends.tolist(), strict=True):
            entry = lists[at]
            if len(entry) < j:
                entry.extend([b""] * (j - len(entry)))
            entry.append(data[2 * i : 2 * k] if k - i < limit else compressed(numbers[i:k]))
    return {
        "a": pa.array((pairs >> np.uint64(16)).astype(np.int32)),
        "b": pa.array((pairs & np.uint64(0xFFFF)).astype(np.int32)),
        "docs": pa.array(docs),
        "links": pa.array(links),
        "planes": pa.array(lists, pa.list_(pa.binary())),
    }


_CHUNKS = (
    "kind string, cell int, chunk long, no int, id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "a int, b int, docs long, links long, planes array<binary>"
)
_NUMBERS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<binary>": pa.list_(pa.binary())}


def _batch(rows: int, made: dict) -> pa.RecordBatch:
    """A batch of the columns of ``_CHUNKS``: arrays, values for all rows, and nulls where nothing is given."""
    columns = {}
    for name, kind in (c.split() for c in _CHUNKS.split(", ")):
        value, of_arrow = made.get(name), _NUMBERS[kind]
        if isinstance(value, pa.Array):
            columns[name] = value if value.type == of_arrow else value.cast(of_arrow)
        elif value is None:
            columns[name] = pa.nulls(rows, of_arrow)
        elif isinstance(value, (int, str)):
            columns[name] = pa.array([value] * rows, of_arrow)
        else:
            columns[name] = pa.array(value, of_arrow)
    return pa.RecordBatch.from_pydict(columns)


def _chunked(a_model, b_model, chunk_bytes: int, max_docs: int):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _vocabularies(a_model.value, b_model.value)
        task = TaskContext.get().partitionId()
        chunk, used, size, parts = task << 24, 0, 0, []

        def closed() -> Iterator[pa.RecordBatch]:
            made = posting_columns(Planes.united(parts))
            rows = len(made["a"])
            for at in range(0, rows, 20_000):
                some = {name: values.slice(at, 20_000) for name, values in made.items()}
                yield _batch(len(some["a"]), some | {"kind": "posting", "cell": task // _TASKS_PER_CELL, "chunk": chunk})

        for frame in frames:
            ids, texts = frame["id"], [t or "" for t in frame["text"].to_pylist()]
            at = 0
            while at < len(texts):
                stop, batch = at, 0
                while stop < len(texts) and stop - at < max_docs - used and (stop == at or batch + len(texts[stop]) <= _BATCH_BYTES):
                    batch += len(texts[stop])
                    stop += 1
                aligned = Aligned(words, list(words.encode(texts[at:stop])))
                pairs = (aligned.link_a << 16) | aligned.link_b
                parts.append(Planes.counted(*posting_keys(pairs, aligned.link_text + used)))
                digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in aligned.groups()]
                counts = {name: getattr(aligned, name) for name in ("n_a", "n_b", "n_groups", "n_links")}
                place = {"chunk": chunk, "no": np.arange(used, used + stop - at, dtype=np.int32), "id": ids.slice(at, stop - at)}
                yield _batch(stop - at, place | counts | {"kind": "document", "groups_sha256": digests})
                used, size, at = used + stop - at, size + batch, stop
                if used == max_docs or size >= chunk_bytes:
                    yield from closed()
                    chunk, used, size, parts = chunk + 1, 0, 0, []
        if used:
            yield from closed()

    return run


_OF_DOCUMENTS = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def _scored(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """Scores of a chunk's documents from all its postings and the counts of their pairs."""
    best, total = np.zeros(DOCS, np.int64), np.zeros(DOCS, np.int64)
    is_posting = pc.equal(rows["kind"], "posting")
    documents, postings = rows.filter(pc.invert(is_posting)), rows.filter(is_posting)
    names = (postings["a"], postings["b"]), (counts["of_a"], counts["of_b"])
    wanted, given = (a.to_numpy().astype(np.int64) << 16 | b.to_numpy().astype(np.int64) for a, b in names)
    order = np.argsort(given)
    at = order[np.searchsorted(given, wanted, sorter=order)]
    count, top = counts["count"].to_numpy()[at], counts["top"].to_numpy()[at]
    lists = postings["planes"].combine_chunks()
    planes = lists.flatten().to_pylist()
    lengths = lists.value_lengths().to_numpy()
    level = np.arange(len(planes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    one = np.left_shift(1, level)
    weight = np.repeat(count, lengths) * one
    of_best = np.repeat(top, lengths) * one
    size = np.array([len(p) for p in planes], np.int64)
    short = size < DOCS // 8
    docs = np.frombuffer(b"".join(p for p in planes if len(p) < DOCS // 8), "<u2")
    np.add.at(total, docs, np.repeat(weight[short], size[short] // 2))
    np.add.at(best, docs, np.repeat(of_best[short], size[short] // 2))
    for i in np.flatnonzero(~short).tolist():
        docs = expanded(planes[i])
        total[docs] += weight[i]
        best[docs] += of_best[i]
    at = documents["no"].to_numpy()
    return documents.select(_OF_DOCUMENTS).append_column("n_best", pa.array(best[at])).append_column("count_sum", pa.array(total[at]))


def aligned_chunks(
    documents: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text: str = "text",
    chunk_bytes: int = CHUNK_BYTES, docs: int = DOCS,
) -> DataFrame:
    """The rows of all chunks, stored: ``kind`` tells documents, with their counts and digests, from postings.

    ``a_path`` is a byte-level vocabulary in JSON, ``b_path`` a sentencepiece model; the driver reads both and sends
    them along.
    """
    if not 0 < docs <= DOCS:
        raise ValueError(f"docs must be 1 to {DOCS}")
    context = documents.sparkSession.sparkContext
    with open(a_path, encoding="utf-8") as a_file, open(b_path, "rb") as b_file:
        a_model, b_model = context.broadcast(a_file.read()), context.broadcast(b_file.read())
    rows = documents.select(column(id_column).cast("string").alias("id"), column(text).alias("text"))
    return stored(rows.mapInArrow(_chunked(a_model, b_model, chunk_bytes, docs), _CHUNKS), "alignment")


def _cells(chunks: DataFrame) -> DataFrame:
    postings = chunks.filter("kind = 'posting'")
    return postings.groupBy("a", "b", "cell").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(a, b, docs, links): documents and links of each id pair that is linked anywhere."""
    return _cells(chunks).groupBy("a", "b").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))


def alignment_scores(
    documents: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text: str = "text",
    chunk_bytes: int = CHUNK_BYTES, docs: int = DOCS,
) -> DataFrame:
    """One row per document: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``."""
    chunks = aligned_chunks(documents, a_path, b_path, id_column, text, chunk_bytes, docs)
    cells = stored(_cells(chunks), "pair-cells")
    pairs = cells.groupBy("a", "b").agg(F.sum("links").alias("count"))
    # A window group has the A ids linked to one B id: at most a vocabulary.
    pairs = pairs.withColumn("top", F.col("count") == F.max("count").over(Window.partitionBy("b")))
    known = cells.select("a", "b", "cell").join(pairs, ["a", "b"])
    # Only names of postings meet the counts; their planes are sent once, to the chunk.
    named = chunks.filter("kind = 'posting'").select("a", "b", "cell", F.col("chunk").alias("of_chunk"))
    returned = named.join(known, ["a", "b", "cell"]).select("of_chunk", F.col("a").alias("of_a"), F.col("b").alias("of_b"), "count", "top")
    whole = chunks.select("chunk", "kind", "no", *_OF_DOCUMENTS, "a", "b", "planes")
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in whole.select(*_OF_DOCUMENTS).schema]
    scored = (
        whole.groupBy("chunk")
        .cogroup(returned.groupBy("of_chunk"))
        .applyInArrow(_scored, ", ".join([*fields, "n_best long", "count_sum long"]))
    )
    id_type = documents.select(column(id_column)).schema[0].dataType
    return scored.select(
        F.col("id").cast(id_type).alias(id_column), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
