"""Reads from 4-line FASTQ text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locusframe.operators.lookup import lookup_join
from locusframe.session import shared_path

#: Input blocks whose starts are broadcast, some 50 bytes each; at 128 MB a block, 256 TB of text.
MAX_BLOCKS = 2_000_000


def number_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text lines with their exact place: (row, source_file, line_no), line_no from 0 per file.

    The lines are stored once as Parquet together with the input block they came from. Lines of
    a block stay together and in order, so a line's number is the number of lines in earlier
    blocks of its file plus its place in its own block. No line is shuffled.
    """
    stored = shared_path(spark, "numbered-lines")
    spark.read.text(path).select(
        F.col("value").alias("row"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
    ).write.parquet(stored)
    located = spark.read.parquet(stored).select(
        "*",
        F.col("_metadata.file_name").alias("stored_file"),
        F.col("_metadata.row_index").alias("stored_row"),
    )
    blocks = located.groupBy("source_file", "block", "stored_file").agg(
        F.count("*").alias("n"), F.min("stored_row").alias("first_row")
    )
    # A window group holds one row per block of one file.
    earlier = F.expr(
        "coalesce(sum(n) over (partition by source_file order by block "
        "rows between unbounded preceding and 1 preceding), 0)"
    )
    shifts = blocks.select(
        F.col("source_file").alias("of_file"),
        F.col("block").alias("of_block"),
        (earlier - F.col("first_row")).alias("shift"),
    )
    joined = lookup_join(located, shifts, on=[("source_file", "of_file"), ("block", "of_block")])
    return joined.select("row", "source_file", (F.col("stored_row") + F.col("shift")).alias("line_no"))


class _Ends:
    """What a block of lines is known by: how many, its first and last three, and its last line with text."""

    def __init__(self, key: int, file: str, block: int):
        self.key, self.file, self.block = key, file, block
        self.n, self.head, self.tail, self.last_text = 0, [], [], -1

    def add(self, values: pa.Array) -> None:
        self.head += values.slice(0, 3 - len(self.head)).to_pylist() if len(self.head) < 3 else []
        self.tail = [*self.tail, *values.slice(max(0, len(values) - 3)).to_pylist()][-3:]
        filled = np.flatnonzero(pc.binary_length(values).to_numpy(zero_copy_only=False) > 0)
        if len(filled):
            self.last_text = self.n + int(filled[-1])
        self.n += len(values)


_ENDS = "key long, source_file string, block long, n long, last_text long, head array<string>, tail array<string>"


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True) if len(keys) else iter(())


def _block_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each input block of a task; the lines of a block come together and in order."""
    done: list[_Ends] = []

    def rows() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())]
        columns = zip(*((e.key, e.file, e.block, e.n, e.last_text, e.head, e.tail) for e in done), strict=True)
        names = [c.split()[0] for c in _ENDS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        keys = batch["key"].to_numpy()
        for start, stop in _runs(keys):
            if not done or done[-1].key != keys[start]:
                if len(done) > 1000:
                    last = done.pop()
                    yield rows()
                    done = [last]
                done.append(_Ends(int(keys[start]), batch["source_file"][start].as_py(), batch["block"][start].as_py()))
            done[-1].add(batch["row"].slice(start, stop - start))
    if done:
        yield rows()


_RECORDS = "key long, read_no long, title string, seq string, plus string, qual string"


def _whole_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records that lie in one block whole, put together from its lines by their order."""
    key, at, left, read = None, 0, None, 0
    for batch in batches:
        keys = batch["key"].to_numpy()
        for start, stop in _runs(keys):
            if keys[start] != key:
                key, at, left = keys[start], 0, None
                if batch["skip"][start].as_py() is None:
                    raise RuntimeError("the files were split otherwise than when their lines were counted; read them again")
                skip, whole, read = (batch[c][start].as_py() for c in ("skip", "whole", "first_read"))
            low, high = max(start, start + skip - at), min(stop, start + skip + 4 * whole - at)
            at += stop - start
            if low >= high:
                continue
            values = batch["row"].slice(low, high - low)
            if left is not None and len(left):
                values = pa.concat_arrays([left, values])
            made = len(values) // 4
            left = values.slice(4 * made)
            lines = [values.take(pa.array(np.arange(i, 4 * made, 4))) for i in range(4)]
            place = [pa.array(np.full(made, key)), pa.array(np.arange(read, read + made))]
            read += made
            if made:
                yield pa.RecordBatch.from_arrays([*place, *lines], [c.split()[0] for c in _RECORDS.split(", ")])


def read_fastq(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Reads as (id, seq, qual, source_file, read_no), read_no from 0 per file.

    A record is four lines by position; the ``@`` of a line is no sign of a record's start, since
    quality strings may begin with it. Empty lines at a file's end are ignored. Any other record that lacks a line or has
    no ``@`` or ``+`` in its place fails the query. Lengths of sequence and quality are not compared.

    1. Seams. A first pass keeps of each input block its number of lines and its first and last three, stored in one row a
       block. Running sums over a file's blocks tell which line of a record each block starts with.
    2. Records. A second pass puts together, where they are read, the records that lie in one block. No line of these is
       shuffled or stored.
    3. Stitching. Lines of records that a block's end cuts, six a block at most, come from the rows of step 1 and meet by
       their record's number.

    Both passes split the files alike: splits follow from the listing and the session's settings. If these change between
    the passes, the query fails rather than number lines wrongly.
    """
    scanned = spark.read.text(path).select(
        F.col("value").alias("row"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.xxhash64("_metadata.file_path", "_metadata.file_block_start").alias("key"),
    )
    kept = shared_path(spark, "block-ends")
    scanned.mapInArrow(_block_ends, _ENDS).write.parquet(kept)
    ends = spark.read.parquet(kept)
    # Window groups hold one row per block of one file.
    of_file = Window.partitionBy("source_file")
    earlier = of_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = ends.withColumn("first_line", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    filled = F.when(F.col("last_text") >= 0, F.col("first_line") + F.col("last_text") + 1)
    blocks = blocks.withColumn("lines", F.coalesce(F.max(filled).over(of_file), F.lit(0)))
    blocks = blocks.withColumn("skip", F.least(F.pmod(-F.col("first_line"), F.lit(4)), F.col("n")))
    blocks = blocks.withColumn("first_read", F.ceil(F.col("first_line") / 4).cast("long"))
    # Records that start behind the last line with text are blank.
    filled_reads = F.ceil(F.col("lines") / 4).cast("long") - F.col("first_read")
    in_block = F.floor((F.col("n") - F.col("skip")) / 4).cast("long")
    blocks = blocks.withColumn("whole", F.greatest(F.least(in_block, filled_reads), F.lit(0)))
    total = ends.count()
    if total > MAX_BLOCKS:
        raise ValueError(f"more than {MAX_BLOCKS} input blocks; read the files in parts, or in larger splits")
    starts = F.broadcast(blocks.select(F.col("key").alias("of_key"), "skip", "whole", "first_read"))
    placed = scanned.select("row", "key").join(starts, F.col("key") == F.col("of_key"), "left").drop("of_key")
    names = blocks.select(F.col("key").alias("of_key"), "source_file")
    inside = lookup_join(placed.mapInArrow(_whole_records, _RECORDS), names, on=[("key", "of_key")], table_rows=total, max_broadcast_rows=MAX_BLOCKS)

    cut_tail = F.when(F.col("n") > F.col("skip"), F.pmod(F.col("n") - F.col("skip"), F.lit(4))).otherwise(0)
    lines_of_head = F.slice("head", 1, F.col("skip").cast("int"))
    lines_of_tail = F.slice("tail", (F.size("tail") - cut_tail + 1).cast("int"), cut_tail.cast("int"))
    seams = [
        blocks.select("source_file", "lines", first.alias("first"), F.posexplode(some).alias("i", "row"))
        for some, first in ((lines_of_head, F.col("first_line")), (lines_of_tail, F.col("first_line") + F.col("n") - cut_tail))
    ]
    cut = seams[0].unionByName(seams[1]).withColumn("line_no", F.col("first") + F.col("i"))

    def line(i: int):
        return F.max(F.when(F.col("line_no") % 4 == i, F.col("row")))

    stitched = (
        cut.withColumn("read_no", F.floor(F.col("line_no") / 4))
        .filter("4 * read_no < lines")
        .groupBy("source_file", "read_no")
        .agg(line(0).alias("title"), line(1).alias("seq"), line(2).alias("plus"), line(3).alias("qual"))
    )
    columns = ["source_file", "read_no", "title", "seq", "plus", "qual"]
    records = inside.select(columns).unionByName(stitched.select(columns))
    fine = F.coalesce(
        F.col("title").startswith("@") & F.col("plus").startswith("+") & F.col("qual").isNotNull(), F.lit(False)
    )
    wrong = F.raise_error(F.concat(F.lit("bad FASTQ record "), F.col("read_no").cast("string"), F.lit(" of "), F.col("source_file")))
    records = records.withColumn("title", F.when(fine, F.col("title")).otherwise(wrong.cast("string")))
    return records.select(
        F.regexp_replace("title", "^@", "").alias("id"), "seq", "qual", "source_file", "read_no"
    )
