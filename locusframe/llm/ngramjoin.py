"""Jaccard self-join of documents on word n-grams by rare-first prefix filtering, and its components.

A document's set holds 64-bit hashes of its distinct n-grams of words; a shorter document has its whole
sequence as one. Equal sets are one class and travel once.

1. Frequency. All n-grams of all documents are counted in a table of fixed size (a hash chooses the
   counter). N-grams are ordered by their counter, rare ones first, then by hash. Any order gives the same
   links; this one keeps what many documents share out of the prefixes.
2. Prefix. Two sets linked at the threshold share an n-gram among the first ``size - ceil(t size) + 1`` of
   each. Those prefix n-grams are the join key; the documents' classes meet in the group of a shared one.
3. Filters. A pair in a group counts if the sizes allow the threshold and if the positions leave enough
   n-grams for the overlap needed.
4. First round. A group's classes are put in order of size, and neighbours are verified: a line through the
   group, not all its pairs. Only pairs that pass the suffix filter of step 5 have their sets made again from the texts
   and sent. Components of the links found follow.
5. Second round. Groups of three classes or more that still hold several components are open; the only pair of a smaller
   one is a line. The pairs of an open group of ``SMALL_GROUP`` classes at most are listed, a bounded number for each row, and
   pass the filters of step 3 and the suffix filter like lines: the differences of two classes' counts of n-grams by
   ranges of hashes bound what their sets do not share. Classes that meet in larger open groups form arenas. An arena's
   classes are sent once, or for a large arena once per part, to cells of bounded mean size, each with its n-grams of such
   groups and its counts, not with its set. An arena that is cheaper to send n-gram by n-gram is dealt as one arena for
   each: many groups that are joined by few classes, as by chance in much text, do not make all classes meet all others.
   A cell meets pairs of different components by these n-grams, with the same filters.
6. Verification. Only sets of the pairs left are fetched and compared whole. A class has a bounded number of
   candidates in a round; while a cell had more, a round with four times as many follows, in which pairs that became one
   component meanwhile are skipped. After the last round every linked pair has been verified, or lies in one component.

Results are one row per input row: ``n_shingles`` and ``component_id``, the
smallest id reachable by links. Nulls, empty texts and texts without words have no n-gram, are linked with
nothing, and have their own id. Equal rows of one id share a component; null ids count as larger than all
others. An empty table gives an empty result. Of the input only id and text are read, whatever other columns
are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from locusframe.llm.common import column, marked, release, stored
from locusframe.llm.components import components

COUNTERS = 1 << 20
#: Ranges of hashes by which sets are compared before they are fetched; a set of more than ``RANGE_GRAMS`` for each has more ranges.
RANGES = 256
#: Unrelated sets with so many n-grams a range differ by some 0.28 of their size, more than a threshold of 80 % allows.
RANGE_GRAMS = 16
#: Candidates of a class that are verified in the first round; each further round takes four times as many.
FIRST_CANDIDATES = 32
#: Pairs whose ends are broadcast, 16 bytes each, to pick their sets.
BROADCAST_PAIRS = 500_000
#: Bytes of classes in one part of an arena; a cell holds two parts at most.
CELL_BYTES = 1_500_000
#: Classes of an open group whose pairs are listed; those of a larger one meet in cells, with their counts by ranges.
SMALL_GROUP = 32
#: Bytes of an n-gram of a class in a cell.
_GRAM_BYTES = 12
_CHUNKS = 16
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Words of more bytes are hashed one by one.
LONG_WORD = 64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words ``data[start:end]``.

    Eight bytes at a time are added and mixed, a bijection each, so no two words of up to eight bytes and equal length
    collide, and none of the longer ones by the structure that sums of powers have.
    """
    size = end - start
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded.tobytes(), strides=(1,))
    word = mixed(size.astype(np.uint64))
    rest = np.flatnonzero(size <= LONG_WORD)
    at = 0
    while len(rest):
        left = np.minimum(size[rest] - at, 8)
        part = eights[start[rest] + at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left.astype(np.uint64)))
        word[rest] = mixed(word[rest] + part)
        at += 8
        rest = rest[size[rest] > at]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        word[i] = xxh3_64_intdigest(data[start[i] : end[i]].tobytes())
    return word


#: Factors of a word's place in an n-gram. They are unrelated, so no order of the same words gives an equal sum.
_PLACES = mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


class Shingler:
    """Sorted distinct n-gram hashes of texts; words are what is between ASCII white space, A-Z lower-cased."""

    def __init__(self, n: int):
        self.n = n

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        out = []
        batch: list[bytes] = []
        size = 0
        for text in texts:
            data = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
            if batch and size + len(data) > 1 << 20:
                out += self._sets(batch)
                batch, size = [], 0
            batch.append(data)
            size += len(data) + 1
        return out + self._sets(batch) if batch else out

    def _sets(self, batch: list[bytes]) -> list[np.ndarray]:
        n = self.n
        data = np.frombuffer(b"\n".join(batch) + b"\n", np.uint8)
        ends_of = np.cumsum([len(b) + 1 for b in batch])
        space = _SPACE[data]
        start = np.flatnonzero(~space & np.r_[True, space[:-1]])
        end = np.flatnonzero(~space & np.r_[space[1:], True]) + 1
        word = word_hashes(data, start, end)
        first = np.searchsorted(start, np.r_[0, ends_of])
        grams = np.zeros(len(word), np.uint64)
        if len(word) >= n:
            for i in range(n):
                grams[: len(word) - n + 1] += word[i : len(word) - n + 1 + i] * _PLACES[i]
        grams = mixed(grams)
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= n:
                out.append(np.unique(grams[a : b - n + 1]))
            elif b > a:
                whole = sum((word[a + i : a + i + 1] * _PLACES[i] for i in range(b - a)), np.zeros(1, np.uint64))
                out.append(mixed(whole + np.uint64(b - a)))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def class_of(grams: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    name = mixed(np.array([mixed(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(grams))]))
    return int(name.astype(np.int64)[0])


def gram_counts(documents: DataFrame, n: int) -> np.ndarray:
    """How many documents' n-grams fall on each counter; a table of fixed size, summed by Spark."""
    size = COUNTERS // _CHUNKS

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, total, some = Shingler(n), np.zeros(COUNTERS, np.uint32), False
        for frame in frames:
            for i in range(0, len(frame), 2000):
                sets = shingler.sets(frame["_text"].iloc[i : i + 2000].tolist())
                places = np.concatenate(sets) >> np.uint64(44)
                total += np.bincount(places.astype(np.int64), minlength=COUNTERS).astype(np.uint32)
                some = True
        if some:
            # As narrow as the counts allow; the length tells the type.
            narrow = [c.astype(np.min_scalar_type(c.max())) for c in total.reshape(_CHUNKS, size)]
            yield pd.DataFrame({"chunk": range(_CHUNKS), "counts": [c.tobytes() for c in narrow]})

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for chunk, counts in zip(frame["chunk"], frame["counts"], strict=True):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts, f"u{len(counts) // size}").astype(np.int64)
        yield pd.DataFrame({"chunk": list(sums), "counts": [c.tobytes() for c in sums.values()]})

    kind = "chunk int, counts binary"
    rows = documents.mapInPandas(count, kind).repartition(_CHUNKS, "chunk").mapInPandas(add, kind).collect()
    total = np.zeros((_CHUNKS, size), np.int64)
    for row in rows:
        total[row["chunk"]] = np.frombuffer(row["counts"], np.int64)
    return np.minimum(total.ravel(), 2**32 - 1).astype(np.uint32)


def prefixes(documents: DataFrame, n: int, percent: int, counts) -> DataFrame:
    """(id, n, cid, prefix, spread) of the rows; a task gives the prefix and spread of a class once, then empty ones."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, table, met = Shingler(n), counts.value, set()
        for frame in frames:
            sizes, names, firsts, spreads = [], [], [], []
            for i in range(0, len(frame), 2000):
                for grams in shingler.sets(frame["_text"].iloc[i : i + 2000].tolist()):
                    size, name = len(grams), class_of(grams)
                    kept = size - -(-percent * size // 100) + 1 if size and name not in met else 0
                    met.add(name)
                    spreads.append(spread_of(grams) if kept else None)
                    if kept:
                        grams = rarest(grams, table, kept)
                    sizes.append(size)
                    names.append(name)
                    firsts.append(grams[:kept].astype(np.int64))
            yield pd.DataFrame({"_id": frame["_id"], "n": sizes, "cid": names, "prefix": firsts, "spread": spreads})

    id_type = documents.schema["_id"].dataType.simpleString()
    return documents.mapInPandas(run, f"_id {id_type}, n long, cid long, prefix array<long>, spread binary")


def class_sets(documents: DataFrame, rows: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(cid, grams) of the classes ``wanted``, made again from one row's text; a class may come twice, and others come along.

    Texts are not shuffled: each task knows the ids by bits of their hashes, which let some others pass.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(n)
        for frame in frames:
            for i in range(0, len(frame), 2000):
                sets = [s for s in shingler.sets(frame["_text"].iloc[i : i + 2000].tolist()) if len(s)]
                yield pd.DataFrame({"cid": [class_of(s) for s in sets], "grams": [s.tobytes() for s in sets]})

    some = marked(rows.filter("n > 0").select("cid", "_id"), F.col("cid"), wanted).join(wanted, "cid", "left_semi")
    ids = some.groupBy("cid").agg(F.min("_id").alias("_id")).select("_id")
    return marked(documents, F.col("_id"), ids).select("_text").mapInPandas(run, "cid long, grams binary")


def class_spreads(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, spread) of the classes ``wanted`` and some others."""
    return marked(rows.filter("spread IS NOT NULL").select("cid", "spread"), F.col("cid"), wanted).dropDuplicates(["cid"])


def ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()


def reaches(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    if len(x) > len(y):
        x, y = y, x
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def rarest(grams: np.ndarray, table: np.ndarray, count: int) -> np.ndarray:
    """The first ``count`` n-grams in the order of their counters, then hashes."""
    rare = table[(grams >> np.uint64(44)).astype(np.int64)]
    if count < len(grams):
        low = rare <= np.partition(rare, count - 1)[count - 1]
        grams, rare = grams[low], rare[low]
    return grams[np.lexsort((grams, rare))[:count]]


def verified(pairs: DataFrame, documents: DataFrame, rows: DataFrame, n: int, percent: int) -> DataFrame:
    """The stored pairs (a, b) of classes whose sets reach the threshold."""

    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        ranges = np.r_[(np.arange(16, dtype=np.uint64) << np.uint64(60)), np.uint64(2**64 - 1)]
        for x, y in zip(left, right, strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            # Sets at the threshold differ in at most (nx + ny) (1 - t) / (1 + t) n-grams.
            apart = int(np.abs(np.diff(np.searchsorted(x, ranges)) - np.diff(np.searchsorted(y, ranges))).sum())
            if (100 + percent) * apart > (100 - percent) * (len(x) + len(y)):
                out.append(False)
                continue
            out.append(reaches(x, y, percent))
        return pd.Series(out, dtype=bool)

    wanted = stored(ends(pairs), "ends")
    sets = class_sets(documents, rows, wanted, n)
    if pairs.count() <= BROADCAST_PAIRS:
        sets = sets.join(F.broadcast(wanted), "cid", "left_semi")
    sets = stored(sets.dropDuplicates(["cid"]), "sets")
    one = sets.select(F.col("cid").alias("a"), F.col("grams").alias("left"))
    two = sets.select(F.col("cid").alias("b"), F.col("grams").alias("right"))
    links = stored(pairs.join(one, "a").join(two, "b").filter(linked("left", "right")).select("a", "b").distinct(), "verified")
    release(wanted, sets)
    return links


def alike(pairs: DataFrame, spreads: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, total size) whose counts by ranges of hashes allow the threshold; sets do not travel for this."""

    @F.pandas_udf("long")
    def apart(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([difference(x, y) for x, y in zip(left, right, strict=True)], dtype="int64")

    one = spreads.select(F.col("cid").alias("a"), F.col("spread").alias("left"))
    two = spreads.select(F.col("cid").alias("b"), F.col("spread").alias("right"))
    # Sets at the threshold differ in at most (nx + ny) (1 - t) / (1 + t) n-grams.
    most = F.lit(100 - percent) * F.col("total")
    return pairs.join(one, "a").join(two, "b").filter(F.lit(100 + percent) * apart("left", "right") <= most).select("a", "b")


def spread_of(grams: np.ndarray) -> bytes:
    """How many n-grams of a sorted set lie in each range of hashes, 255 at most; ``RANGES`` times a power of 2 ranges."""
    bits = max(RANGES - 1, (len(grams) - 1) // RANGE_GRAMS).bit_length()
    counts = np.bincount((grams >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def folded(spread: bytes, ranges: int) -> np.ndarray:
    return np.frombuffer(spread, np.uint8).reshape(ranges, -1).sum(1, dtype=np.int64)


def difference(x: bytes, y: bytes) -> int:
    """How many n-grams two sets with these spreads do not share, at least."""
    ranges = min(len(x), len(y))
    return int(np.abs(folded(x, ranges) - folded(y, ranges)).sum())


def _cell_candidates(percent: int, most: int):
    """Pairs of classes of one cell (parts ``i`` and ``j`` of an arena) that no filter rules out, ``most`` for each class.

    A row with ``more`` set says that a class had more of them.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        # By size, so that the partners a class may have by size are one run before it.
        frame = frame.sort_values(["n", "cid"], kind="stable")
        across = frame["i"].iloc[0] != frame["j"].iloc[0]
        names, component, part = (frame[c].to_numpy() for c in ("cid", "component", "part"))
        size = frame["n"].to_numpy()
        fine = frame["spread"].to_list()
        spread = np.stack([folded(s, RANGES) for s in fine]).astype(np.int32)
        counts = frame["hs"].map(len).to_numpy()
        first = np.r_[0, np.cumsum(counts)]
        h, pos = np.concatenate(frame["hs"].to_list()), np.concatenate(frame["ps"].to_list()).astype(np.int64)
        row = np.repeat(np.arange(len(frame)), counts)
        order = np.lexsort((row, h))
        h, of_group, at_group = h[order], row[order], pos[order]
        begin = np.searchsorted(h, h)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        least = np.searchsorted(size, -(-percent * size // 100))
        out = []
        for x in range(len(frame)):
            n = size[x]
            runs = []
            for e in range(first[x], first[x + 1]):
                stop = place[e]
                start = begin[stop]
                start += np.searchsorted(of_group[start:stop], least[x])
                if start < stop:
                    runs.append((start, stop, pos[e]))
            if not runs:
                continue
            y = np.concatenate([of_group[a:b] for a, b, _ in runs])
            at = np.concatenate([at_group[a:b] for a, b, _ in runs])
            mine = np.repeat([p for _, _, p in runs], [b - a for a, b, _ in runs])
            fits = (component[y] != component[x]) & ((100 + percent) * np.minimum(n - mine, size[y] - at) >= percent * (n + size[y]))
            if across:
                fits &= part[y] != part[x]
            y = np.unique(y[fits])
            # Sets at the threshold differ in at most (nx + ny) (1 - t) / (1 + t) n-grams.
            apart = np.abs(spread[y] - spread[x]).sum(1, dtype=np.int64)
            y = y[(100 + percent) * apart <= (100 - percent) * (n + size[y])]
            if len(fine[x]) > RANGES:
                apart = np.array([difference(fine[x], fine[k]) for k in y.tolist()], np.int64)
                y = y[(100 + percent) * apart <= (100 - percent) * (n + size[y])]
            out += [(min(names[x], names[k]), max(names[x], names[k]), False) for k in y[:most].tolist()]
            if len(y) > most:
                out.append((names[x], names[x], True))
        return pd.DataFrame(out, columns=["a", "b", "more"]).astype({"a": "int64", "b": "int64", "more": bool})

    return run


def _fits(percent: int) -> str:
    """Sizes and positions of two rows x and y allow the threshold: overlap needed is t / (1 + t) of both sizes."""
    return (
        f"100 * least(x_n, y_n) >= {percent} * greatest(x_n, y_n) AND "
        f"{100 + percent} * least(x_n - x_pos, y_n - y_pos) >= {percent} * (x_n + y_n)"
    )


def group_pairs(open_: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, total size) of different components that meet in a group and pass the filters of size and position."""
    one, two = (open_.selectExpr("h", f"cid {s}", f"n {s}_n", f"pos {s}_pos", f"component {s}_component") for s in "xy")
    fits = F.expr(f"x < y AND x_component != y_component AND {_fits(percent)}")
    return one.join(two, "h").filter(fits).selectExpr("x a", "y b", "x_n + y_n total").distinct()


def arena_classes(open_: DataFrame, rows: DataFrame) -> DataFrame:
    """(arena, cid, n, hs, ps, spread) of the rows (h, cid, n, pos, v) of open groups.

    Classes that meet in groups, directly or over others, are one arena. In P parts an arena sends each class P times. If its
    groups sent one by one, each in parts of its own, are fewer bytes, every group is an arena.
    """
    arena = components(open_.select(F.col("cid").alias("u"), "v")).select(F.col("node").alias("cid"), F.col("component").alias("arena"))
    held = open_.select("h", "cid", "n", "pos").join(arena, "cid")
    sent = lambda size: size * F.ceil(size / F.lit(CELL_BYTES))
    groups = held.groupBy("arena", "h").agg(F.count(F.lit(1)).alias("classes"))
    groups = groups.groupBy("arena").agg(
        F.sum("classes").alias("grams"), F.sum(sent(F.col("classes") * (_GRAM_BYTES + RANGES))).alias("apart")
    )
    sizes = arena.groupBy("arena").agg((F.count(F.lit(1)) * RANGES).alias("counts"))
    cut = groups.join(sizes, "arena").filter(F.col("apart") < sent(F.col("grams") * _GRAM_BYTES + F.col("counts")))
    # An arena of one part is never cut, so these are few.
    held = held.join(F.broadcast(cut.select("arena", F.lit(True).alias("cut"))), "arena", "left")
    held = held.withColumn("arena", F.when(F.col("cut"), F.col("h")).otherwise(F.col("arena")))
    lists = held.groupBy("arena", "cid").agg(F.first("n").alias("n"), F.array_sort(F.collect_set(F.struct("pos", "h"))).alias("open"))
    classes = lists.select("arena", "cid", "n", F.col("open.h").alias("hs"), F.col("open.pos").alias("ps"))
    return classes.join(class_spreads(rows, open_.select("cid")), "cid")


def link_components(documents: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, links, component of each linked class) for documents (_id, _text)."""
    context = documents.sparkSession.sparkContext
    counts = context.broadcast(gram_counts(documents.select("_text"), n))
    rows = stored(prefixes(documents, n, percent, counts), "prefixes")
    grams = rows.filter(F.size("prefix") > 0).select("cid", "n", F.posexplode("prefix").alias("pos", "h"))
    order = Window.partitionBy("h").orderBy("n", "cid")
    # Copies of a class from several tasks stand next to each other.
    once = grams.withColumn("before", F.lag("cid").over(order)).filter("before IS NULL OR before != cid").drop("before")
    met = once.withColumn("classes", F.count(F.lit(1)).over(Window.partitionBy("h"))).filter("classes > 1")
    near = {}
    for name, step in (("down", F.lag), ("up", F.lead)):
        near[name] = step(F.struct("cid", "n", "pos")).over(order)
    together = [f"({s}.n IS NOT NULL AND 100 * least({s}.n, n) >= {percent} * greatest({s}.n, n))" for s in near]
    lined = met.withColumns(near).filter(" OR ".join(together))
    live = stored(lined.select("h", "cid", "n", "pos", "classes", "down"), "shared-grams")
    line = live.filter(together[0]).selectExpr(
        "down.cid x", "down.n x_n", "down.pos x_pos", "cid y", "n y_n", "pos y_pos"
    )
    pairs = stored(line.filter(_fits(percent)).selectExpr("least(x, y) a", "greatest(x, y) b", "x_n + y_n total").distinct(), "lines")
    near_pairs = stored(alike(pairs, class_spreads(rows, ends(pairs)), percent), "pairs")
    links = verified(near_pairs, documents, rows, n, percent)
    release(pairs, near_pairs)
    component = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    # The only pair of a group of two classes is a line.
    named = live.filter("classes > 2").select("h", "cid", "n", "pos")
    named = named.join(component.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    named = stored(named, "named-grams")
    release(live)
    spans = named.groupBy("h").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min("cid").alias("v"), F.count(F.lit(1)).alias("classes")
    )
    open_ = stored(named.join(spans.filter("low != high").select("h", "v", "classes"), "h"), "open-grams")
    release(named)
    pairs = stored(group_pairs(open_.filter(F.col("classes") <= SMALL_GROUP), percent), "group-pairs")
    few = stored(alike(pairs, class_spreads(rows, ends(pairs)), percent), "few")
    release(pairs)
    classes = stored(arena_classes(open_.filter(F.col("classes") > SMALL_GROUP), rows), "classes")
    release(open_)
    totals = stored(classes.groupBy("arena").agg(F.sum(F.size("hs") * _GRAM_BYTES + F.length("spread")).alias("bytes")), "arenas")
    # Small arenas share cells; no n-gram of one is in another.
    shared_cells = -(-(totals.agg(F.sum("bytes")).first()[0] or 0) // CELL_BYTES) + 1
    parts = totals.select(F.col("arena").alias("of"), F.ceil(F.col("bytes") / F.lit(CELL_BYTES)).cast("int").alias("parts"))
    parted = classes.join(parts, F.col("arena") == F.col("of")).withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    most = FIRST_CANDIDATES
    while True:
        named = parted.join(component.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
        cells = named.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        cell = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("arena"), F.lit(shared_cells))).otherwise(F.col("arena"))
        cells = cells.select(
            cell.alias("cell"), (F.col("parts") > 1).alias("many"), F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "cid", "component", "n", "spread", "hs", "ps"
        )
        found = cells.groupBy("cell", "many", "i", "j").applyInPandas(_cell_candidates(percent, most), "a long, b long, more boolean")
        found = stored(found.distinct(), "candidates")
        before, more = links, not found.filter("more").isEmpty()
        new = verified(found.filter("NOT more").select("a", "b").union(few).distinct(), documents, rows, n, percent)
        links = stored(before.union(new).distinct(), "links")
        release(before, new, found, few)
        component = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
        if not more:
            members = stored(rows.select("_id", "n", "cid"), "members")
            release(rows, classes, totals)
            return members, links, component
        few = stored(links.limit(0), "few")
        most *= 4


def near_duplicates(
    documents: DataFrame, n: int = 4, percent: int = 85, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, ``n_shingles``, ``component_id``): one row per document."""
    keyed = documents.select(column(id_column).alias("_id"), column(text).alias("_text"))
    rows, _, component = link_components(keyed, n, percent)
    member = rows.select("_id", "n", "cid").join(component.withColumnRenamed("node", "cid"), "cid", "left")
    member = member.withColumn("component", F.coalesce("component", "cid"))
    least = member.filter("n > 0").groupBy(F.col("component").alias("of")).agg(F.min("_id").alias("least"))
    named = member.join(least, (F.col("component") == F.col("of")) & (F.col("n") > 0), "left")
    named = named.select("_id", F.col("n").alias("n_shingles"), F.coalesce("least", "_id").alias("component_id"))
    return named.withColumnRenamed("_id", id_column)
