"""Fill-in-middle transformation by block rotation in place, and its exact inverse.

A text's units are white space followed by a word, or the white space at its end. Two cuts, drawn from the
document's id, part it into prefix, middle and suffix.

1. Scan. A run over the bytes finds the ends of all units; the two cuts are two of them. White space is ASCII, so a cut
   never parts a character.
2. Insert. ``<P>``, ``<M>`` and ``<S>`` go before prefix, middle and suffix, in a bytearray that holds the text once.
3. Rotate. Two neighbouring blocks change places when each is reversed and then both together: (middle, suffix) for
   the order prefix, suffix, middle (``psm``), (prefix with middle, suffix) for suffix, prefix, middle (``spm``).
4. Restore. The marks of an output tell the blocks; the same rotation the other way round puts them back, and the
   marks are taken out.

Rows stay where they are: there is no shuffle, and a task holds a few copies of a batch's texts. The draws are made
of a seed and the id alone, so a repeated task or another partitioning gives the same rows.

Null texts count as empty. Empty texts, texts that hold a mark, and those that the draw leaves out keep their text, in
the form ``plain``, with null lengths. A null id draws like an empty one. Repeated rows are changed each on
their own, in the same way. Other columns pass through; input columns of the names of added ones are replaced. An
empty table gives an empty result. Bytes that are not UTF-8 pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import column

PREFIX, MIDDLE, SUFFIX = b"<P>", b"<M>", b"<S>"
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def draws(doc_id: Column, seed: int) -> Column:
    """Four numbers below 2**32 from the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*(F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)))


def unit_ends(data: bytes) -> np.ndarray:
    """Where each unit ends."""
    if not data:
        return np.zeros(0, np.int64)
    space = _SPACE[np.frombuffer(data, np.uint8)]
    ends = np.flatnonzero(~space & np.r_[space[1:], True]) + 1
    return np.append(ends, len(data)) if space[-1] else ends


def reverse(buffer: bytearray, start: int, stop: int) -> None:
    """Reverse a block where it lies, in steps of bounded size from both ends."""
    while stop - start > 1:
        step = min(1 << 16, (stop - start) // 2)
        head = buffer[start : start + step]
        head.reverse()
        tail = buffer[stop - step : stop]
        tail.reverse()
        buffer[start : start + step] = tail
        buffer[stop - step : stop] = head
        start, stop = start + step, stop - step


def rotate(buffer: bytearray, start: int, middle: int, stop: int) -> None:
    """Exchange the blocks [start, middle) and [middle, stop) by three reversals."""
    reverse(buffer, start, middle)
    reverse(buffer, middle, stop)
    reverse(buffer, start, stop)


def transformed(data: bytes, low: int, high: int, form: str) -> bytearray:
    """The text with its parts [0, low), [low, high) and [high, end) marked and put in the order of ``form``."""
    buffer = bytearray(data)
    # From the back, so that the earlier cuts stay where they are.
    for at, mark in ((high, SUFFIX), (low, MIDDLE), (0, PREFIX)):
        buffer[at:at] = mark
    middle, suffix = low + len(PREFIX), high + len(PREFIX) + len(MIDDLE)
    rotate(buffer, middle if form == "psm" else 0, suffix, len(buffer))
    return buffer


def restored_text(output: bytes, form: str) -> bytes:
    """The text that ``transformed`` was given; a ``plain`` output is its own text."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    first = PREFIX if form == "psm" else SUFFIX
    second = SUFFIX if form == "psm" else PREFIX
    if not output.startswith(first) or (at := output.find(second)) < 0 or (middle := output.find(MIDDLE, at)) < 0:
        raise ValueError(f"no output of the form {form}")
    if form == "psm":
        rotate(buffer, at, middle, len(buffer))
        middle, suffix = at, at + len(output) - middle
    else:
        rotate(buffer, 0, at, len(buffer))
        middle, suffix = middle - at, len(buffer) - at
    for start, mark in ((suffix, SUFFIX), (middle, MIDDLE), (0, PREFIX)):
        del buffer[start : start + len(mark)]
    return bytes(buffer)


def _characters(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)) if data else 0


def fill_in_middle(
    documents: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Adds ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` (binary).

    About ``percent`` of the texts are changed, ``spm_percent`` of them to suffix, prefix, middle.
    """

    @F.pandas_udf("n long, form string, prefix_chars long, middle_chars long, output binary")
    def change(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, numbers in batches:
            out = []
            for data, (h1, h2, h3, h4) in zip(texts, numbers, strict=True):
                ends = unit_ends(data)
                n = len(ends)
                if not data or h3 % 100 >= percent or any(m in data for m in (PREFIX, MIDDLE, SUFFIX)):
                    out.append((n, "plain", None, None, data))
                    continue
                cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
                low, high = (int(ends[c - 1]) if c else 0 for c in cuts)
                form = "spm" if h4 % 100 < spm_percent else "psm"
                out.append((n, form, _characters(data[:low]), _characters(data[low:high]), bytes(transformed(data, low, high, form))))
            frame = pd.DataFrame(out, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
            yield frame.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    names = ("n", "form", "prefix_chars", "middle_chars", "output")
    content = F.coalesce(column(text), F.lit("")).cast("binary")
    whole = [column(c) for c in documents.columns if c not in names]
    made = documents.select(*whole, change(content, draws(column(id_column), seed)).alias("_made"))
    return made.select(*whole, *(F.col("_made").getField(c).alias(c) for c in names))


def restore(changed: DataFrame, output: str = "output", form: str = "form", into: str = "restored") -> DataFrame:
    """Adds the text (binary) that an output of the given form was made of; a null output gives null."""

    @F.pandas_udf("binary")
    def back(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for outputs, forms in batches:
            yield pd.Series([None if o is None else restored_text(o, f) for o, f in zip(outputs, forms, strict=True)], dtype=object)

    return changed.withColumn(into, back(column(output), column(form)))
