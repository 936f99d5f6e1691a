"""Toxicity: noisy-channel restoration of disguised words, then a score of the restored text.

Restoration. A word that holds digits, signs, letters cut by separators, or a letter twice in a row, or a run
of single letters with any white space between them is a lattice: each character may stand
for itself, for the letters it resembles, or for nothing (separators, signs, repetitions); a separator may
also end a word. Viterbi search finds the likeliest reading under a character trigram model with the
channel's costs. A word without letters is a number, and dropped, unless its reading is likelier than letters
drawn evenly. Plain words stand for themselves.

Language model. Trigram counts of letters come from all documents: every batch gives one table of counts,
and these are added by Spark. A table has at most ``SYMBOLS ** 3`` entries, which bounds the broadcast model.

Score. A document is its set of restored words. The classifier learns from about ``max_train`` labelled rows
and has two kinds of features. Marks are words and their first four and five letters that are precise
on these rows; they are taken greedily as long as they cover further toxic rows. The lean is the sum of the
words' log ratios: how much more often words with a word's longest known prefix of three to seven letters are
in toxic rows than in others. Logistic regression weighs marks and the lean, taken per word and per root of
the word count. The score is the probability; no labelled row is needed by the restoration.

Nulls and empty texts have no feature and get the score of the bias. With no toxic or no clean labelled row
every score is the base rate (0 without labels). Repeated rows score alike. Labels, language, source and id
are never inputs of a score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import Recent, column, held_out, sigmoid, stored, unpacked, whole_row

#: Letters of the model: a boundary, a-z, and the letters from U+00DF to U+00FF.
SYMBOLS = 60
#: Characters whose trigrams are counted at a time.
SLICE = 1 << 20
_CODE = np.zeros(256, np.int64)
_CODE[ord("a") : ord("z") + 1] = np.arange(1, 27)
_CODE[0xDF:0x100] = np.arange(27, SYMBOLS)
_CODE[0xF7] = 0
_CODES = {chr(i): int(c) for i, c in enumerate(_CODE) if c}

# Letters that digits and signs resemble.
DIGITS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i"}
SEPARATORS = " .,-_*~'`:;/\\\"^=#%&"
# Costs of the channel, in nats: a resemblance, a sign or a separator that stands for nothing, a separator
# that ends a word, a repeated letter that stands for nothing (in a run of three or more, and of two).
RESEMBLES, NO_SIGN, NO_SEPARATOR, ENDS_WORD, LONG_RUN, SHORT_RUN = 0.5, 4.0, 0.3, 1.5, 0.1, 4.0

_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
_EDGES = ".,;:?\"'()[]{}<>&%#*~=^`-_/\\"
_REPEATED = re.compile(r"(.)\1")
_CUT_LETTERS = re.compile(r"(?:[^\W_][-._*~'`]){2,}[^\W_]")


class Restorer:
    """Readings of words under log probabilities of trigrams of letter codes."""

    def __init__(self, model: np.ndarray):
        self.model = model.ravel().tolist()

    def options(self, word: str) -> list[list[tuple[str, float]]]:
        """For each character the texts it may stand for, with their costs."""
        lattice = []
        ending = len(word.rstrip("!"))
        for i, c in enumerate(word):
            if i >= ending:
                # A mark at the end is mostly no letter.
                here = [(x, RESEMBLES) for x in SIGNS[c]] + [("", NO_SEPARATOR)]
            elif c in DIGITS:
                here = [(x, RESEMBLES) for x in DIGITS[c]]
            elif c in SIGNS:
                here = [*((x, RESEMBLES) for x in SIGNS[c]), ("", NO_SIGN)]
            elif c in _CODES:
                here = [(c, 0.0)]
                if i and word[i - 1] == c:
                    long = (i > 1 and word[i - 2] == c) or word[i + 1 : i + 2] == c
                    here.append(("", LONG_RUN if long else SHORT_RUN))
            elif c in SEPARATORS:
                here = [("", NO_SEPARATOR), (" ", ENDS_WORD)]
            else:
                here = [(c if c.isalpha() else " ", 0.0)]
            lattice.append(here)
        return lattice

    def restore(self, word: str) -> str:
        """The likeliest reading, with spaces where words end inside it."""
        return self.reading(word)[1]

    def reading(self, word: str) -> tuple[float, str]:
        """The cost of the likeliest reading, and the reading."""
        model, n = self.model, SYMBOLS
        best = {(0, 0): (0.0, None)}
        for options in self.options(word):
            following: dict[tuple[int, int], tuple[float, object]] = {}
            for (a, b), (cost, path) in best.items():
                for out, price in options:
                    if not out:
                        state, total, made = (a, b), cost + price, path
                    else:
                        c = _CODES.get(out, 0)
                        if c == 0 and b == 0 and out == " ":
                            state, total, made = (a, b), cost + price, path
                        else:
                            state = (b, c)
                            total = cost + price - model[(a * n + b) * n + c]
                            made = (out, path)
                    if state not in following or total < following[state][0]:
                        following[state] = (total, made)
            best = following
        ends = [(cost - model[(a * n + b) * n] if b else cost, path) for (a, b), (cost, path) in best.items()]
        cost, path = min(ends, key=lambda e: e[0])
        out = []
        while path is not None:
            out.append(path[0])
            path = path[1]
        return cost, "".join(reversed(out))

    def words(self, word: str) -> tuple[str, ...]:
        """The restored words of one lower-case word of a text."""
        core = word.strip(_EDGES)
        if core.isalpha() and not _REPEATED.search(core):
            return (core,)
        if not any(c.isalpha() for c in core):
            if not core:
                return ()
            cost, text = self.reading(core)
            return tuple(text.split()) if cost < len(core) * math.log(SYMBOLS) else ()
        parts = [p for p in re.split(r"[^\w@$!|+€£¡(]+|_", core) if p]
        if _CUT_LETTERS.search(core) or len(parts) < 2:
            found = self.restore(core).split()
        else:
            found = [r for p in parts for r in ([p] if p.isalpha() and not _REPEATED.search(p) else self.restore(p).split())]
            found.append("".join(found))
        return tuple(found)

    def spaced(self, text: str) -> list[str]:
        """Restored words of runs of single characters with white space between them."""
        return [w for hit in _SPACED.findall(text) for w in self.restore(" ".join(hit.split())).split() if len(w) > 1]


def _trigrams_of(text: str) -> np.ndarray:
    codes = _CODE[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)].astype(np.int32)
    return np.bincount((codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:], minlength=SYMBOLS**3)


def count_trigrams(texts) -> np.ndarray:
    """Trigrams of letter codes of texts, each with two blanks on both sides, counted in slices of bounded size."""
    total = np.zeros(SYMBOLS**3, np.int64)
    part, size = [], 0
    for text in texts:
        padded = f"  {text.lower()}  " if text else ""
        if len(padded) > SLICE:
            # Slices of a long text share two letters.
            for at in range(0, len(padded) - 2, SLICE):
                total += _trigrams_of(padded[at : at + SLICE + 2])
        elif padded:
            part.append(padded)
            size += len(padded)
        if size > SLICE:
            total += _joined(part)
            part, size = [], 0
    return total + _joined(part) if part else total


def _joined(part: list[str]) -> np.ndarray:
    counts = _trigrams_of("".join(part))
    # Four blanks meet between texts and make two trigrams of no text.
    counts[0] -= 2 * (len(part) - 1)
    return counts


def language_model(documents: DataFrame, text: str = "text") -> np.ndarray:
    """Log probabilities of a letter after two others, from the trigrams of all documents.

    Every task sends its table of counts in rows of ``SYMBOLS`` numbers; the sums are at most
    ``SYMBOLS ** 2`` rows.
    """

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for frame in frames:
            total += count_trigrams(frame["text"])
        rows = total.reshape(-1, SYMBOLS)
        seen = np.flatnonzero(rows.any(axis=1))
        if len(seen):
            yield pd.DataFrame({"context": seen, "counts": list(rows[seen])})

    sums = [F.sum(F.col("counts")[i]).alias(f"c{i}") for i in range(SYMBOLS)]
    rows = (
        documents.select(column(text).alias("text"))
        .mapInPandas(partial, "context long, counts array<long>")
        .groupBy("context")
        .agg(F.array(*sums).alias("counts"))
        .collect()
    )
    three = np.zeros((SYMBOLS**2, SYMBOLS))
    for row in rows:
        three[row["context"]] = row["counts"]
    three = three.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    # Absolute weights of shorter contexts smooth the longer ones.
    one = three.sum((0, 1)) + 1.0
    one /= one.sum()
    two = three.sum(0) + 10.0 * one
    two /= two.sum(1, keepdims=True)
    full = three + 10.0 * two[None]
    return np.log(full / full.sum(2, keepdims=True)).astype(np.float32)


def features(word: str) -> tuple[str, ...]:
    return (word, "4 " + word[:4], "5 " + word[:5]) if len(word) > 5 else (word,)


class Reader:
    """Distinct restored words of texts."""

    def __init__(self, model: np.ndarray):
        self.restorer = Restorer(model)
        self.of_word = Recent(self.restorer.words, 300_000)

    def read(self, text: str) -> set[str]:
        lower = text.lower()
        found = set(self.restorer.spaced(lower))
        for words in map(self.of_word.__getitem__, set(lower.split())):
            found.update(words)
        return found


class Classifier:
    """``marks`` numbers the marks, ``lean`` has log ratios of prefixes, ``weights`` of regression inputs."""

    def __init__(self, marks: dict[str, int], lean: dict[str, float], weights: np.ndarray):
        self.marks, self.lean, self.weights = marks, lean, weights

    def of_word(self, word: str) -> tuple[tuple[int, ...], float]:
        marks, lean = self.marks, self.lean
        ratio = next((lean[word[:k]] for k in range(min(7, len(word)), 2, -1) if word[:k] in lean), 0.0)
        return tuple(marks[f] for f in features(word) if f in marks), ratio

    def inputs(self, marks: set[int], total: float, words: int) -> list[tuple[int, float]]:
        """(column, value) of the regression; column 0 is the bias."""
        size = words + 5.0
        return [(0, 1.0), (1, 20 * total / size), (2, total / math.sqrt(size)), *((m + 3, 1.0) for m in marks)]

    def logit(self, inputs: list[tuple[int, float]]) -> float:
        return float(sum(self.weights[i] * v for i, v in inputs))


class Scorer:
    """Logits of texts; what a word as written adds is kept in a bounded memo."""

    def __init__(self, model: np.ndarray, classifier: Classifier):
        self.restorer, self.classifier = Restorer(model), classifier
        self.of_word = Recent(self._word, 300_000)

    def _word(self, word: str) -> tuple[tuple[int, ...], float, int]:
        found = [self.classifier.of_word(w) for w in self.restorer.words(word)]
        return tuple({m for ms, _ in found for m in ms}), sum(r for _, r in found), len(found)

    def logit(self, text: str) -> float:
        lower = text.lower()
        marks, total, words = set(), 0.0, 0
        for held, ratio, n in map(self.of_word.__getitem__, set(lower.split())):
            if held:
                marks.update(held)
            total += ratio
            words += n
        for held, ratio in map(self.classifier.of_word, set(self.restorer.spaced(lower))):
            marks.update(held)
            total += ratio
            words += 1
        return self.classifier.logit(self.classifier.inputs(marks, total, words))


def training_words(documents: DataFrame, labels: DataFrame, label: str, model, max_train: int, text: str) -> DataFrame:
    """(y, words) of about ``max_train`` labelled rows at most, none of them held out."""
    usable = labels.filter(~held_out(F.col("doc_id")) & F.col(label).isNotNull()).select("doc_id", F.col(label).alias("y"))
    share = min(1.0, max_train / max(1, usable.count()))
    if share < 1:
        usable = usable.filter(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = documents.select("doc_id", column(text).alias("text")).join(usable, "doc_id").select("y", "text")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(model.value)
        for frame in frames:
            words = [sorted(reader.read(t or "")) for t in frame["text"]]
            yield pd.DataFrame({"y": frame["y"], "words": words})

    return rows.mapInPandas(read, "y int, words array<string>")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the first column of ``x`` is not shrunk."""
    weights = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[0] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ weights)
        slope = x.T @ (p - y) + shrink * weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink)
        weights -= np.linalg.solve(bend, slope)
    return weights


def cover(rows: list[tuple[int, list[int]]], least: int = 3, most: int = 2000) -> list[int]:
    """Features in the order of a greedy cover of the positive rows; each covers ``least`` more of them."""
    holders: dict[int, set[int]] = {}
    for number, (y, held) in enumerate(rows):
        if y:
            for f in held:
                holders.setdefault(f, set()).add(number)
    chosen, heap = [], sorted(((-len(h), f) for f, h in holders.items()), reverse=True)
    covered: set[int] = set()
    while heap and len(chosen) < most:
        gain, f = heap.pop()
        now = len(holders[f] - covered)
        if now < least:
            if -gain < least:
                break
            continue
        # Another feature may cover more by now: put this one back in its place.
        if heap and now < -heap[-1][0]:
            import bisect

            bisect.insort(heap, (-now, f), key=lambda e: (-e[0], -e[1]))
            continue
        chosen.append(f)
        covered |= holders[f]
    return chosen


def prefix_ratios(sample: DataFrame, support: int = 20, least: float = 0.5) -> dict[str, float]:
    """Log ratios of prefixes that ``support`` words of the sample have and whose ratio is ``least`` from 0."""
    cut = F.array_distinct(F.transform(F.sequence(F.lit(3), F.lit(7)), lambda k: F.left("w", k)))
    each = sample.select("y", F.explode("words").alias("w")).filter(F.length("w") > 2).select("y", F.explode(cut).alias("p"))
    counts = each.groupBy("p").agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n"))
    sums = sample.agg(F.sum(F.col("y") * F.size("words")).alias("pos"), F.sum(F.size("words")).alias("n")).first()
    share = (sums["pos"] or 0) / max(1, sums["n"] or 0)
    if not 0 < share < 1:
        return {}
    # Five words of the common share are added to each prefix.
    of_toxic, of_rest = F.col("pos") + 5 * share, F.col("n") - F.col("pos") + 5 * (1 - share)
    ratio = F.log(of_toxic / of_rest) - math.log(share / (1 - share))
    kept = counts.filter(F.col("n") >= support).select("p", ratio.alias("r")).filter(F.abs("r") >= least)
    return {r["p"]: r["r"] for r in kept.collect()}


def train(documents: DataFrame, labels: DataFrame, label: str, language, max_train: int, text: str) -> Classifier:
    sample = stored(training_words(documents, labels, label, language, max_train, text), "toxicity-sample")
    w = F.col("w")
    cuts = F.array(w, F.concat(F.lit("4 "), F.left(w, F.lit(4))), F.concat(F.lit("5 "), F.left(w, F.lit(5))))
    each = sample.select("y", F.monotonically_increasing_id().alias("row"), F.explode("words").alias("w"))
    each = each.select("y", "row", F.explode(F.when(F.length(w) > 5, cuts).otherwise(F.array(w))).alias("f"))
    # A row counts once for each feature: its words are distinct, only prefixes can repeat.
    counts = each.distinct().groupBy("f").agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n"))
    precise = counts.filter((F.col("pos") >= 3) & (F.col("pos") >= 0.9 * F.col("n")))
    number = {f: i for i, f in enumerate(sorted(r["f"] for r in precise.select("f").collect()))}
    draft = Classifier(number, prefix_ratios(sample), np.zeros(3))
    shared = sample.sparkSession.sparkContext.broadcast(draft)

    def held(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of_word = shared.value.of_word
        for frame in frames:
            found = [[of_word(w) for w in words] for words in frame["words"]]
            marks = [sorted({m for ms, _ in ws for m in ms}) for ws in found]
            sums = [float(sum(r for _, r in ws)) for ws in found]
            yield pd.DataFrame({"y": frame["y"], "marks": marks, "total": sums, "words": [len(ws) for ws in found]})

    rows = sample.mapInPandas(held, "y int, marks array<int>, total double, words int").collect()
    y = np.array([r["y"] for r in rows], float)
    if not len(y) or not 0 < y.sum() < len(y):
        base = min(max(float(y.mean()) if len(y) else 0.0, 1e-9), 1 - 1e-9)
        return Classifier({}, {}, np.array([math.log(base / (1 - base)), 0.0, 0.0]))
    chosen = cover([(r["y"], r["marks"]) for r in rows])
    place = {f: i for i, f in enumerate(chosen)}
    names = {i: f for f, i in number.items()}
    result = Classifier({names[f]: i for f, i in place.items()}, draft.lean, np.zeros(3))
    x = np.zeros((len(rows), len(chosen) + 3))
    for i, r in enumerate(rows):
        for column_, value in result.inputs({place[f] for f in r["marks"] if f in place}, r["total"], r["words"]):
            x[i, column_] = value
    result.weights = logistic(x, y, ridge=0.1)
    return result


def score_toxicity(
    documents: DataFrame, corpus: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text",
    max_train: int = 20_000,
) -> DataFrame:
    """Adds ``score`` (probability of being toxic) to the documents, replacing a column of that name.

    ``corpus`` gives the language model and, with ``labels``, the rows to learn from; it is usually the
    documents themselves.
    """
    context = documents.sparkSession.sparkContext
    language = context.broadcast(language_model(corpus, text))
    model = context.broadcast(train(corpus, labels, label, language, max_train, text))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(language.value, model.value)
        for batch in batches:
            yield pd.Series(sigmoid(np.array([scorer.logit(t) for t in batch], float)))

    rows = documents.select(whole_row(documents, ("score",)), column(text).alias("_text"))
    scored = rows.withColumn("score", score(F.coalesce("_text", F.lit(""))))
    return scored.select(*unpacked(scored), "score")
