"""Quality: Bradley-Terry ranking of documents from preference pairs.

A document's features are shares of kinds of characters, words and lines. From labelled rows, pairs of a
good and a bad document are drawn; the chance that the good one wins is the logistic function of the
difference of their scores, and scores are linear in the features. The log loss over the pairs, with a
ridge, is minimised by Newton steps. Only differences matter to the pairs, so the scale is set after:
the score at the quantile of the labelled bad share becomes the decision point.

All labelled rows that are not held out take part. Their shares, equal ones once with their number, are dealt to blocks of
about ``BLOCK_ROWS`` rows, in which pairs are drawn; rows of a rare kind come to several blocks, so that each has enough of
both. Newton steps sum what the blocks give, in the order of blocks, so only sums come to the driver. Scoring is one pass
over the whole texts without a shuffle.

Nulls and empty texts have zeros as features and are scored by them. Without both good and bad labelled
rows every score is the base rate (0.5 without labels). Repeated rows score alike. Labels, language, source
and id are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import column, held_out, marked, release, sigmoid, stored, unpacked, whole_row

#: Labelled rows of a block, and how many of a kind it has at least, if there are as many.
BLOCK_ROWS, KIND_ROWS = 20_000, 2_000
#: Pairs whose differences are in memory at a time.
PAIRS = 8_192
#: Pieces in which the arrays of the blocks are summed.
_CHUNKS = 8
#: Scores that are sorted by the driver, and ranges by which more are narrowed down.
SORTED, BINS = 20_000, 4_096
_SIGNS = "!|$%&*#.,;:?-_'\"/<>=(){}[]@+~^`\\"
_KINDS = 6 + len(_SIGNS)
_KIND = np.zeros(256, np.intp)
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[[9, 10, 11, 12, 13, 32]] = 4
_KIND[128:] = 5
for _i, _c in enumerate(_SIGNS):
    _KIND[ord(_c)] = 6 + _i


def shares(text: str) -> list[float]:
    """Shares of character kinds, and figures of words and lines."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n = max(1, len(data))
    kinds = _KIND[data]
    of_kind = np.bincount(kinds, minlength=_KINDS) / n
    words = text.split()
    m = max(1, len(words))
    equal = data[1:] == data[:-1]
    runs = float((equal[1:] & equal[:-1]).sum()) / n
    sign_ends = float(((kinds[1:] == 4) & (kinds[:-1] >= 6)).sum()) / m
    upper_starts = float(((kinds[1:] == 2) & (kinds[:-1] == 4)).sum()) / m
    repeats = sum(map(str.__eq__, words[1:], words[:-1])) / m
    lines = text.split("\n")
    return [
        *of_kind, runs, sign_ends, upper_starts, repeats, len(set(words)) / m, len(set(lines)) / len(lines),
        min(1.0, n / m / 20), min(1.0, np.log1p(len(words)) / 12), min(1.0, m / len(lines) / 100),
    ]


def expanded(x: np.ndarray) -> np.ndarray:
    """Rows of shares, their roots, and whether they are more than a trace; then products of the word figures."""
    tail = x[:, _KINDS:]
    i, j = np.triu_indices(tail.shape[1])
    return np.concatenate([x, np.sqrt(x), x > 0.01, x > 0.1, tail[:, i] * tail[:, j]], axis=1)


def vector(text: str) -> np.ndarray:
    return expanded(np.array([shares(text)]))[0]


SHARES = len(shares(""))
WIDTH = len(vector(""))


def labelled_rows(documents: DataFrame, usable: DataFrame, text: str) -> DataFrame:
    """(y, x, w): the shares of the labelled documents, and how many have them."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [np.array(shares(t or ""), float).tobytes() for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "x": made})

    rows = documents.select("doc_id", column(text).alias("text"))
    if rows.schema["doc_id"].dataType == usable.schema["doc_id"].dataType:
        rows = marked(rows, F.col("doc_id"), usable.select("doc_id"))
    made = rows.mapInPandas(read, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, x binary")
    return made.join(usable, "doc_id").groupBy("y", "x").agg(F.count(F.lit(1)).alias("w"))


def dealt(rows: DataFrame) -> DataFrame:
    """(block, xs, ys, ws, own): blocks of rows as arrays, in an order of their own; a row is ``own`` in one block only."""
    sizes = {r["good"]: r["n"] for r in rows.groupBy((F.col("y") == 1).alias("good")).agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = -(-sum(sizes.values()) // BLOCK_ROWS)
    good, bad = (min(blocks, max(1, sizes.get(kind, 0) // KIND_ROWS)) for kind in (True, False))
    parts = F.when(F.col("y") == 1, F.lit(good)).otherwise(F.lit(bad))
    placed = rows.withColumn("first", F.pmod(F.xxhash64("x", "y"), parts).cast("int"))
    placed = placed.withColumn("block", F.explode(F.sequence("first", F.lit(blocks - 1), parts)))

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        x, y = np.frombuffer(b"".join(frame["x"]), float).reshape(-1, SHARES), frame["y"].to_numpy()
        narrow = x.astype(np.float32)
        order = np.lexsort((*narrow.T[:7:-1], *narrow.T[:8], y))  # rows arrive in any order; draw the same pairs each time
        ys, ws, own = y.astype(np.int64), frame["w"].to_numpy(), (frame["first"] == frame["block"]).to_numpy()
        arrays = {"xs": x, "ys": ys, "ws": ws, "own": own}
        return pd.DataFrame({"block": [key[0]]} | {c: [a[order].tobytes()] for c, a in arrays.items()})

    return placed.groupBy("block").applyInPandas(pack, "block int, xs binary, ys binary, ws binary, own binary")


def opened(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels, numbers of rows, and those of them that are counted in this block."""
    x = expanded(np.frombuffer(row.xs, float).reshape(-1, SHARES)).astype(np.float32).astype(float)
    w = np.frombuffer(row.ws, np.int64)
    return x, np.frombuffer(row.ys, np.int64), w, w * np.frombuffer(row.own, bool)


def summed(blocks: DataFrame, of) -> np.ndarray:
    """The sum of the arrays that ``of`` makes of the blocks."""

    def make(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                pieces = np.array_split(np.asarray(of(row), float).ravel(), _CHUNKS)
                yield pd.DataFrame({"block": row.block, "chunk": range(_CHUNKS), "part": [p.tobytes() for p in pieces]})

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: dict[int, list[tuple[int, bytes]]] = {}
        for frame in frames:
            for block, chunk, part in zip(frame["block"], frame["chunk"], frame["part"], strict=True):
                parts.setdefault(chunk, []).append((block, part))
        if parts:
            sums = [sum(np.frombuffer(p, float) for _, p in sorted(own)).tobytes() for own in parts.values()]
            yield pd.DataFrame({"chunk": list(parts), "part": sums})

    made = blocks.mapInPandas(make, "block int, chunk int, part binary").repartition(_CHUNKS, "chunk")
    found = {r["chunk"]: np.frombuffer(bytes(r["part"]), float) for r in made.mapInPandas(add, "chunk int, part binary").collect()}
    return np.concatenate([found[c] for c in range(_CHUNKS)])


def pairs_of(y: np.ndarray, w: np.ndarray, own: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Good rows, bad rows, and how often they were drawn as a pair."""
    chance, drawn = np.random.default_rng(seed), []
    kinds = [np.flatnonzero(y == 1), np.flatnonzero(y == 0)]
    pairs = max(int(own.sum()), 4 * min(int(w[k].sum()) for k in kinds))
    for k in kinds:
        ends = np.cumsum(w[k])
        drawn.append(k[np.searchsorted(ends, chance.integers(0, ends[-1], pairs), side="right")] if len(k) else k)
    if not all(map(len, drawn)):
        return kinds[0][:0], kinds[0][:0], kinds[0][:0]
    both, times = np.unique(drawn[0] * len(y) + drawn[1], return_counts=True)
    return both // len(y), both % len(y), times


def bradley_terry(blocks: DataFrame, mean: np.ndarray, scale: np.ndarray, seed: int, ridge: float = 1.0, steps: int = 15) -> np.ndarray:
    """Weights by Newton steps on the log loss of the good rows of the drawn pairs beating the bad ones."""

    def of(weights: np.ndarray):
        def loss(row) -> np.ndarray:
            """The slope, then the rows of second derivatives."""
            x, y, w, own = opened(row)
            z = (x - mean) / scale
            good, bad, times = pairs_of(y, w, own, seed + row.block)
            total = np.zeros((WIDTH + 1, WIDTH))
            for i in range(0, len(times), PAIRS):
                d, t = z[good[i : i + PAIRS]] - z[bad[i : i + PAIRS]], times[i : i + PAIRS]
                p = sigmoid(d @ weights)
                total[0] += d.T @ (t * (p - 1))
                total[1:] += (d * (t * p * (1 - p))[:, None]).T @ d
            return total

        return loss

    weights = np.zeros(WIDTH)
    for _ in range(steps):
        total = summed(blocks, of(weights)).reshape(WIDTH + 1, WIDTH)
        weights = weights - np.linalg.solve(total[1:] + ridge * np.eye(WIDTH), total[0] + ridge * weights)
    return weights


def in_order(values: DataFrame, rank: int) -> float:
    """The value (s, each w times) that has so many smaller or equal ones before it; the driver sorts ``SORTED`` values at most."""
    low, high, rows = values.agg(F.min("s"), F.max("s"), F.count(F.lit(1))).first()
    while low < high:
        inside = values.filter(F.col("s").between(low, high))
        if rows <= SORTED:
            found = sorted(inside.select("s", "w").collect())
            return found[int(np.searchsorted(np.cumsum([r["w"] for r in found]), rank, side="right"))]["s"]
        place = F.least(F.floor((F.col("s") - F.lit(low)) / F.lit((high - low) / BINS)), F.lit(BINS - 1))
        bins = inside.groupBy(place.alias("bin")).agg(F.min("s").alias("low"), F.max("s").alias("high"), F.count(F.lit(1)).alias("rows"), F.sum("w").alias("w"))
        for r in sorted(bins.collect(), key=lambda r: r["bin"]):
            if rank < r["w"]:
                low, high, rows = r["low"], r["high"], r["rows"]
                break
            rank -= r["w"]
    return low


def quantile(values: DataFrame, count: int, share: float) -> float:
    """The quantile of the values (s, each w times), between two of them in proportion."""
    at = share * (count - 1)
    below = int(np.floor(at))
    a, b = (in_order(values, min(i, count - 1)) for i in (below, below + 1))
    return a + (b - a) * (at - below)


def train(documents: DataFrame, labels: DataFrame, label: str, text: str, seed: int):
    """(mean, scale, weights, decision point, base rate)."""
    usable = labels.filter(~held_out(F.col("doc_id")) & F.col(label).isNotNull()).select("doc_id", F.col(label).cast("int").alias("y"))
    rows = stored(labelled_rows(documents, usable, text), "labelled")
    count, good, bad = rows.agg(F.sum("w"), F.sum(F.col("y") * F.col("w")), F.sum(F.when(F.col("y") == 0, F.col("w")))).first()
    if not count or not 0 < good < count:
        release(rows)
        return np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), 0.0, good / count if count else 0.5
    blocks = stored(dealt(rows), "blocks")
    release(rows)

    def total(row) -> np.ndarray:
        x, _, _, own = opened(row)
        return own @ x

    mean = summed(blocks, total) / count

    def squares(row) -> np.ndarray:
        x, _, _, own = opened(row)
        return own @ (x - mean) ** 2

    scale = np.sqrt(summed(blocks, squares) / count)
    scale[scale < 1e-9] = 1.0
    weights = bradley_terry(blocks, mean, scale, seed)

    def margins(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                x, _, _, own = opened(row)
                yield pd.DataFrame({"s": (x - mean) / scale @ weights, "w": own})[own > 0]

    values = stored(blocks.mapInPandas(margins, "s double, w long"), "margins")
    point = quantile(values, count, bad / count)
    release(blocks, values)
    return mean, scale, weights, point, good / count


def score_quality(
    documents: DataFrame, corpus: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text",
    threshold: float = 0.3, seed: int = 7,
) -> DataFrame:
    """Adds ``score`` in 0 to 1 (high: good), replacing a column of that name.

    The quantile of the labelled bad share has the score ``threshold``.
    """
    mean, scale, weights, point, base = train(corpus, labels, label, text, seed)
    shift = float(np.log(threshold / (1 - threshold)))
    slope = weights / scale
    offset = shift - point - float(mean @ slope)
    flat = not weights.any()
    model = documents.sparkSession.sparkContext.broadcast((slope, offset))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        slope, offset = model.value
        for batch in batches:
            yield pd.Series(sigmoid(np.array([vector(t) @ slope + offset for t in batch], float)))

    rows = documents.select(whole_row(documents, ("score",)), column(text).alias("_text"))
    value = F.lit(base) if flat else score(F.coalesce("_text", F.lit("")))
    scored = rows.withColumn("score", value)
    return scored.select(*unpacked(scored), "score")
