"""Suffix order by linear grouping, and removal of byte strings that occur again anywhere.

``suffix_order`` groups suffixes by their Lyndon prefix (the longest Lyndon word they start with). Groups are
processed in descending order: every suffix of a group finds, over pointers of suffixes done before, the
previous smaller one; those parents have their prefix lengthened by the group's word, as often as it
follows, and move to new groups right above their old ones. When all groups are final, one pass over the
result emits the order inside each group: a suffix goes to its group's next place when the suffix behind
its prefix is met. Nothing is renamed and nothing recurses.

``repeated_spans`` finds all bytes covered by strings of ``length`` bytes that start at two places or more.

1. Anchors. In each run of ``length - gram + 1`` grams (strings of ``gram`` bytes) the one of least hash is an
   anchor, so every string of ``length`` bytes holds one, at the same place wherever the string occurs.
   Only anchors whose gram occurs again matter. A context is an anchor with the bytes that strings of
   ``length`` bytes around it can reach; equal contexts are one, and all their strings occur again.
2. Blocks. Contexts of a gram that differ from each other are grouped by more of their bytes, as ``narrowed`` says, and each
   group goes to one block of bounded mean size. The contexts of a group are lined up at their gram; they are cut at the columns where neighbours in the order of the
   right or of the left part first differ. A column range with its content is a symbol.
3. Order. The block's symbols are one text; its suffixes are ordered by ``suffix_order``. What a suffix has in
   common with its neighbours, in bytes, tells which strings from its first range on occur again.
4. Spans of all contexts are united for each distinct text.

Texts are handled once per distinct text and named by a 64-bit hash. Null and empty texts and those
shorter than ``length`` have no span. Repeated rows are each other's repetition. No task holds all anchors of a
frequent gram: these are counted before the shuffle and the sums of at most 1,000 of them are broadcast. Grams, contexts
and their parts are told apart by 64-bit hashes of their bytes; none of these is a polynomial of the bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from locusframe.llm.common import column, marked, release, stored
from locusframe.llm.ngramjoin import mixed

_BASE = 0x9E3779B97F4A7C15


def suffix_order(text: list[int]) -> list[int]:
    """Start positions of all suffixes in their order; an end is smaller than any symbol."""
    n = len(text)
    if n == 0:
        return []
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        by_symbol.setdefault(c, []).append(i)
    symbols = sorted(by_symbol)
    number = {c: g for g, c in enumerate(symbols)}
    group = [number[c] for c in text]
    members = [by_symbol[c] for c in symbols]
    above, below = list(range(1, len(members) + 1)), list(range(-1, len(members) - 1))
    above[-1] = -1
    done = [False] * n
    smaller = [-1] * n
    current = len(members) - 1
    while current >= 0:
        here = [s for s in members[current] if group[s] == current]
        here.sort()
        members[current] = here
        for s in here:
            done[s] = True
        if len(here) == 1:
            s = here[0]
            p = s - 1
            while p >= 0 and done[p]:
                p = smaller[p]
            smaller[s] = p
            if p >= 0:
                old = group[p]
                made, group[p] = len(members), len(members)
                members.append([p])
                up = above[old]
                above.append(up)
                below.append(old)
                above[old] = made
                below[up] = made
        else:
            times: dict[int, int] = {}
            for s in here:
                p = s - 1
                while p >= 0 and done[p]:
                    p = smaller[p]
                smaller[s] = p
                if p >= 0:
                    times[p] = times.get(p, 0) + 1
            parents: dict[tuple[int, int], list[int]] = {}
            for p, count in times.items():
                parents.setdefault((group[p], count), []).append(p)
            # The more often the word follows, the larger; each new group goes right above the old one.
            for old, count in sorted(parents, key=lambda k: -k[1]):
                moved = parents[old, count]
                made = len(members)
                for p in moved:
                    group[p] = made
                members.append(moved)
                up = above[old]
                above.append(up)
                below.append(old)
                above[old] = made
                below[up] = made
        current = below[current]
    first = 0
    at = [0] * len(members)
    g = 0
    while g >= 0:
        at[g] = first
        first += len(members[g])
        g = above[g]
    order = [-1] * n
    placed = [False] * n
    behind = n
    i = -1
    while True:
        s = behind - 1
        while s >= 0 and not placed[s]:
            placed[s] = True
            g = group[s]
            order[at[g]] = s
            at[g] += 1
            s = smaller[s]
        i += 1
        if i == n:
            return order
        behind = order[i]


class Anchors:
    """Anchors of byte strings, with hashes of their grams and contexts."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.run = length, gram, length - gram + 1
        self.power = self.inverse = np.ones(1, np.uint64)

    def _powers(self, size: int) -> None:
        if len(self.power) <= size:
            power = np.full(2 * size + 1, _BASE, np.uint64)
            inverse = np.full(2 * size + 1, pow(_BASE, -1, 1 << 64), np.uint64)
            power[0] = inverse[0] = 1
            self.power, self.inverse = np.cumprod(power), np.cumprod(inverse)

    def _least(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the least hash (leftmost among equals) of every run; at most 2**20 hashes."""
        low = np.uint64((1 << 20) - 1)
        key = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        span = 1
        while 2 * span <= self.run:
            key = np.minimum(key[:-span], key[span:])
            span *= 2
        rest = self.run - span
        if rest:
            key = np.minimum(key[:-rest], key[rest:])
        places = (key & low).astype(np.int64)
        return places[np.r_[True, places[1:] != places[:-1]]]

    def find(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(gram hash, context hash, place) of every anchor."""
        n, gram = len(data), self.gram
        if n < self.length:
            return (np.zeros(0, np.int64),) * 3
        self._powers(n)
        codes = (np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * self.power[:n]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes)])
        hashes = mixed((total[gram:] - total[:-gram]) * self.inverse[: n - gram + 1])
        most = 1 << 20
        parts = [
            start + self._least(hashes[start : start + most])
            for start in range(0, max(1, len(hashes) - self.run + 1), most - self.run + 1)
        ]
        places = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
        # The rolling hash only picks places; what is found there is named by a hash that no built text makes collide.
        reach = self.length - gram
        names = np.empty((2, len(places)), np.uint64)
        for i, p in enumerate(places.tolist()):
            start, end = max(0, p - reach), min(n, p + self.length)
            names[0, i] = xxh3_64_intdigest(data[p : p + gram])
            names[1, i] = xxh3_64_intdigest(data[start:end], (p - start) * 65536 + end - p)
        return names[0].view(np.int64), names[1].view(np.int64), places


def common_bytes(rows: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group, column) where neighbours in the order of the rows, inside a group, first differ."""
    keyed = np.concatenate([groups.astype(">u4").view(np.uint8).reshape(-1, 4), rows], 1)
    order = np.argsort(np.ascontiguousarray(keyed).view(f"V{keyed.shape[1]}").ravel(), kind="stable")
    rows, groups = rows[order], groups[order]
    beside = groups[1:] == groups[:-1]
    differ = rows[1:][beside] != rows[:-1][beside]
    some = differ.any(1)
    return groups[1:][beside][some], differ[some].argmax(1)


def repeated_starts(contexts: np.ndarray, groups: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, first, last): string starts, as columns, whose strings of ``length`` bytes occur in another context.

    ``contexts`` has a row of bytes for each different context, lined up at the gram; ``groups`` numbers the grams,
    ascending.
    """
    left, width = length - gram, contexts.shape[1]
    g1, right_cuts = common_bytes(contexts[:, left:], groups)
    g2, left_cuts = common_bytes(contexts[:, :left][:, ::-1], groups)
    kinds = int(groups.max()) + 1
    ends = np.arange(kinds, dtype=np.int64)
    cuts = np.unique(
        np.concatenate([g1 * (width + 1) + left + right_cuts, g2 * (width + 1) + left - left_cuts, ends * (width + 1), ends * (width + 1) + width])
    )
    cut_group, cut_column = cuts // (width + 1), cuts % (width + 1)
    first_cut = np.searchsorted(cut_group, ends)
    ranges = np.bincount(cut_group, minlength=kinds) - 1
    count = ranges[groups]
    owner = np.repeat(np.arange(len(groups)), count)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    cut = first_cut[groups[owner]] + place
    begin, end = cut_column[cut], cut_column[cut + 1]
    # Unrelated factors of the columns; powers of one number would let built texts collide.
    power = mixed(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    total = np.zeros((len(contexts), width + 1), np.uint64)
    np.cumsum((contexts.astype(np.uint64) + np.uint64(1)) * power, axis=1, out=total[:, 1:])
    content = mixed(total[owner, end] - total[owner, begin]) ^ mixed(cut.astype(np.uint64))
    _, symbols = np.unique(content, return_inverse=True)
    order = np.array(suffix_order(symbols.tolist()), np.int64)
    # Symbols that a suffix shares with the next one in the order; a context's end stops it.
    left_over = np.repeat(np.cumsum(count), count) - np.arange(len(owner))
    a, b = order[:-1], order[1:]
    shared = np.zeros(len(a), np.int64)
    active = np.arange(len(a))
    most = np.minimum(left_over[a], left_over[b])
    while len(active):
        active = active[shared[active] < most[active]]
        active = active[symbols[a[active] + shared[active]] == symbols[b[active] + shared[active]]]
        shared[active] += 1
    best = np.zeros(len(owner), np.int64)
    np.maximum.at(best, a, shared)
    np.maximum.at(best, b, shared)
    reach = cut_column[cut + best] - begin
    last = np.minimum(end - 1, begin + reach - length)
    good = (last >= begin) & (begin <= left)
    return owner[good], begin[good], np.minimum(last[good], left)


def _spans_of_block(length: int, gram: int):
    left, width = length - gram, 2 * length - gram

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["h", "th", "p"], kind="stable")
        _, groups = np.unique(frame["h"].to_numpy(), return_inverse=True)
        contexts = np.frombuffer(b"".join(frame["bytes"]), np.uint8).reshape(-1, width)
        # Columns that no string of the group covers count as equal.
        a, b = frame["a"].to_numpy(), frame["b"].to_numpy()
        columns = np.arange(width)
        contexts = np.where((columns >= a[:, None]) & (columns < b[:, None] + length), contexts, np.uint8(255))
        owner, first, last = repeated_starts(contexts, groups.astype(np.int64), length, gram)
        first, last = np.maximum(first, a[owner]), np.minimum(last, b[owner])
        single = (frame["m"].to_numpy() == 1)[owner]
        owner, first, last = owner[single], first[single], last[single]
        base = frame["p"].to_numpy()[owner] - left
        # Bytes beyond a text's ends are 0xFF, which no text holds; strings with them are not of this text.
        low, high = frame["low"].to_numpy()[owner], frame["high"].to_numpy()[owner]
        first, last = np.maximum(first, low), np.minimum(last, high - length)
        kept = first <= last
        return pd.DataFrame(
            {"th": frame["th"].to_numpy()[owner][kept], "start": (base + first)[kept], "stop": (base + last + length)[kept]}
        )

    return run


def counted(rows: DataFrame, keys: list[str], deal: list[str]) -> DataFrame:
    """The stored rows with the number ``n`` of rows of equal ``keys``.

    Keys of more than a thousandth of the rows (and 1000) are counted before the shuffle, and their rows are dealt by ``deal``.
    """
    most = max(1000, rows.count() // 1000)
    heavy = stored(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("heavy")).filter(F.col("heavy") > most), "heavy")
    marked = rows.join(F.broadcast(heavy), keys, "left")
    salt = F.when(F.col("heavy").isNotNull(), F.xxhash64(*deal)).otherwise(0)
    near = F.count(F.lit(1)).over(Window.partitionBy(*keys, "salt"))
    return marked.withColumn("salt", salt).withColumn("n", F.coalesce("heavy", near)).drop("heavy", "salt")


def narrowed(contexts: DataFrame, length: int, gram: int, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """Groups of at most ``most`` contexts that may share a string, and the spans of those that are equal.

    ``contexts`` has (th, p, m, low, high, bytes). A string of ``length`` bytes that starts at one of the columns ``a`` to ``b``
    covers the columns ``b`` to ``a + length``, so contexts that share one are equal there: that is their group. Each
    round cuts the ranges of starts into shorter ones, which makes what must be equal longer. Contexts alone in their group
    share nothing. Those equal at all columns that the starts reach share all the strings, and one stands for them.
    ``h`` names a group. Groups that are still too large go to the next round; in the last, of one start each, all of a group are equal.
    """
    left = length - gram
    starts = left + 1
    steps = sorted({-(-starts // 2), -(-starts // 12), 1}, reverse=True)
    bytes_ = lambda first, stop: F.substring("bytes", first + 1, stop - first)
    active = contexts.withColumns({"a": F.lit(0), "b": F.lit(left)})
    rounds, spans = [], []
    for step in steps:
        cut = active.withColumn("a", F.explode(F.sequence("a", "b", F.lit(step))))
        cut = cut.withColumn("b", F.least("b", F.col("a") + step - 1))
        a, b = F.col("a"), F.col("b")
        cut = cut.withColumns({"h": F.xxhash64("a", "b", bytes_(b, a + length)), "reach": F.xxhash64(bytes_(a, b + length))})
        cut = stored(cut.select("h", "reach", "a", "b", "th", "p", "m", "low", "high"), "ranges")
        equal = counted(cut, ["h", "reach"], ["th", "p"])
        first, last = F.greatest("a", "low"), F.least("b", F.col("high") - length)
        again = equal.filter((F.col("n") > 1) & (F.col("m") == 1)).filter(first <= last)
        again = again.select("th", (F.col("p") - left + first).alias("start"), (F.col("p") - left + last + length).alias("stop"))
        spans.append(stored(again, "equal-spans"))
        one = F.min(F.struct("th", "p", "low", "high")).alias("one")
        unlike = cut.groupBy("h", "reach", "a", "b").agg(one, (F.sum("m")).alias("m"))
        unlike = stored(unlike.select("h", "a", "b", "m", "one.*"), "unlike")
        release(cut)
        groups = stored(counted(unlike, ["h"], ["th", "p"]).filter("n > 1"), "groups")
        release(unlike)
        rounds.append(groups)
        crowded = groups.filter(F.col("n") > most)
        if crowded.isEmpty():
            break
        active = crowded.select("th", "p", "a", "b", "m").join(contexts.select("th", "p", "low", "high", "bytes"), ["th", "p"])
    small = stored(reduce(DataFrame.unionByName, rounds).filter(F.col("n") <= most).drop("n"), "small-groups")
    release(*rounds)
    return small, spans


def united(spans, size: int) -> list[tuple[int, int]]:
    """Maximal runs of the bytes in the spans."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        start, stop = max(0, start), min(stop, size)
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        elif stop > start:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def distinct_texts(documents: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(th, text) of the distinct texts that are not null and of which ``wanted`` has the ``th``, and of some others.

    Texts that are not wanted and copies in one task go before the shuffle.
    """
    rows = documents.select(column(text).alias("text")).filter("text IS NOT NULL").select(F.xxhash64("text").alias("th"), "text")
    return marked(rows, F.col("th"), wanted.select("th")).dropDuplicates(["th"])


def repeated_spans(
    documents: DataFrame, length: int = 200, gram: int = 100, text: str = "text", contexts_per_block: int = 20_000
) -> DataFrame:
    """(th, spans): for distinct texts with repeated strings, (start, stop) spans that cover them, not yet united.

    The rows are stored; the tables they were made of are released.
    """
    left, width = length - gram, 2 * length - gram

    def anchors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = Anchors(length, gram)
        for frame in frames:
            texts = frame.groupby("th", sort=False)["text"].agg(["first", "size"])
            found, names, copies = [], [], []
            for name, first, size in texts.itertuples():
                one = finder.find(first.encode("utf-8", "replace"))
                found.append(np.stack(one))
                names.append(np.full(len(one[0]), name))
                copies.append(np.full(len(one[0]), size))
            if found:
                h, c, p = np.concatenate(found, 1)
                yield pd.DataFrame({"h": h, "c": c, "th": np.concatenate(names), "p": p, "copies": np.concatenate(copies)})

    rows = documents.select(F.xxhash64(column(text)).alias("th"), column(text).alias("text")).filter("text IS NOT NULL")
    met = stored(rows.mapInPandas(anchors, "h long, c long, th long, p long, copies long"), "met")
    most = max(1000, met.count() // 1000)
    grams = met.groupBy("h").agg(F.count(F.lit(1)).alias("rows"), (F.min("c") != F.max("c")).alias("heavy"))
    grams = stored(grams.filter(F.col("rows") > most).select("h", "heavy"), "heavy-grams")
    rows = met.join(F.broadcast(grams), "h", "left")
    # Rows of all other grams are one group here.
    of_heavy = [F.when(F.col("heavy").isNotNull(), F.col(k)).alias(k) for k in ("h", "c")]
    sums = rows.groupBy(*of_heavy).agg(F.count(F.lit(1)).alias("rows"), F.sum("copies").alias("whole"))
    sums = stored(sums.filter((F.col("rows") > most) & F.col("h").isNotNull()).select("h", "c", "whole"), "heavy-contexts")
    rows = rows.join(F.broadcast(sums), ["h", "c"], "left")
    # A heavy gram is dealt by context, and a heavy context by place.
    salt = F.when(F.col("heavy").isNull(), 0).when(F.col("whole").isNull(), F.xxhash64("c")).otherwise(F.xxhash64("th", "p"))
    rows = rows.withColumn("salt", salt)
    gram_rows, same = Window.partitionBy("h", "salt"), Window.partitionBy("h", "salt", "c")
    rows = rows.withColumn("n", F.sum("copies").over(gram_rows)).filter("n > 1 OR heavy IS NOT NULL")
    rows = rows.withColumn("m", F.coalesce("whole", F.sum("copies").over(same)))
    rows = rows.withColumns({"least": F.min("m").over(gram_rows), "low": F.min("c").over(gram_rows), "high": F.max("c").over(gram_rows)})
    unlike = F.coalesce(F.col("heavy"), (F.col("least") == 1) & (F.col("low") != F.col("high")))
    live = stored(rows.select("h", "c", "th", "p", "m", unlike.alias("unlike")), "anchors")
    release(met, grams, sums)
    needed = live.filter("unlike").groupBy("h", "c").agg(F.min(F.struct("th", "p")).alias("at"), F.max("m").alias("m"))
    needed = needed.select("at.th", "at.p", "m")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for th, content, wanted_ in zip(frame["th"], frame["text"], frame["list"], strict=True):
                data = content.encode("utf-8", "replace")
                n = len(data)
                for e in wanted_:
                    p = e["p"]
                    low, high = max(0, left - p), min(width, n - p + left)
                    piece = b"\xff" * low + data[max(0, p - left) : p + length] + b"\xff" * (width - high)
                    out.append((th, p, e["m"], low, high, piece))
            yield pd.DataFrame(out, columns=["th", "p", "m", "low", "high", "bytes"])

    wanted = stored(needed.groupBy("th").agg(F.collect_list(F.struct("p", "m")).alias("list")), "wanted")
    kind = "th long, p long, m long, low int, high int, bytes binary"
    contexts = stored(distinct_texts(documents, text, wanted).join(wanted, "th").mapInPandas(cut, kind), "contexts")
    release(wanted)
    groups, equal = narrowed(contexts, length, gram, max(1, contexts_per_block // 10))
    blocks = max(1, groups.count() // contexts_per_block)
    block = F.pmod(F.xxhash64("h", F.lit(8)), F.lit(blocks)).alias("block")
    found = groups.join(contexts.select("th", "p", "bytes"), ["th", "p"]).withColumn("block", block).groupBy("block").applyInPandas(
        _spans_of_block(length, gram), "th long, start long, stop long"
    )
    found = reduce(DataFrame.union, equal, found)
    whole = live.filter("m > 1").select("th", F.greatest(F.col("p") - left, F.lit(0)).alias("start"), (F.col("p") + length).alias("stop"))
    spans = found.union(whole)
    spans = stored(spans.groupBy("th").agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "spans")
    release(live, contexts, groups, *equal)
    return spans


def per_text(documents: DataFrame, spans: DataFrame, make, kind: str, text: str = "text") -> DataFrame:
    """Rows (th, ...) made of every distinct text with spans; ``make`` gets the bytes and the united spans."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for th, content, found in zip(frame["th"], frame["text"], frame["spans"], strict=True):
                data = content.encode("utf-8", "replace")
                out.append((th, *make(data, united([(s["start"], s["stop"]) for s in found], len(data)))))
            yield pd.DataFrame(out, columns=["th", *(c.split()[0] for c in kind.split(", "))])

    return distinct_texts(documents, text, spans).join(spans, "th").mapInPandas(run, f"th long, {kind}")


def kept_bytes(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for start, stop in spans:
        out.append(data[at:start])
        at = stop
    return b"".join([*out, data[at:]])


def removal_digest(documents: DataFrame, length: int = 200, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every document, all repeated bytes removed."""

    def digest(data: bytes, spans):
        kept = kept_bytes(data, spans)
        return len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()

    spans = repeated_spans(documents, length, text=text)
    changed = per_text(documents, spans, digest, "n_removed long, n_spans long, sha string", text)
    content = F.coalesce(column(text), F.lit(""))
    rows = documents.select(
        column(id_column).alias(id_column),
        F.xxhash64(column(text)).alias("th"),
        F.octet_length(content).cast("long").alias("n_bytes"),
        F.sha2(content.cast("binary"), 256).alias("whole"),
    )
    return rows.join(changed, "th", "left").select(
        id_column,
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("sha", "whole").alias("kept_sha256"),
    )
