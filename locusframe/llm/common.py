"""Small helpers of the training-data operators."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.session import shared_path


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


#: Ends the shuffle files of a finished query; else they stay until the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: Bits that name the rows of a set of keys; 2 MB.
MARKS = 1 << 24


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The rows written once under the shared folder and read back; later readers see the same rows.

    The shuffle files behind them go at once.
    """
    spark = frame.sparkSession
    path = shared_path(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    back = spark.read.schema(frame.schema).parquet(path)
    _PATHS[back] = path
    return back


def release(*frames: DataFrame) -> None:
    """Empties tables that ``stored`` returned and that no result still to be computed reads; a later reader fails."""
    for frame in frames:
        path = _PATHS.pop(frame)
        frame.sparkSession.createDataFrame([], "released int").write.mode("overwrite").parquet(path)


def marked(frame: DataFrame, key: Column, keys: DataFrame, inside: bool = True) -> DataFrame:
    """The rows whose key is in the only column of ``keys``, and some others; with ``inside`` unset the rest of the rows.

    The keys are known by bits of their hashes: a broadcast of fixed size, whatever their number.
    """
    place = lambda k: F.pmod(F.xxhash64(k), F.lit(MARKS)) + 1
    of_key = place(column(keys.columns[0]))
    blocks = keys.select(F.bitmap_bucket_number(of_key).alias("_block"), F.bitmap_bit_position(of_key).alias("_bit"))
    blocks = blocks.groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    rows = frame.withColumn("_at", place(key)).join(F.broadcast(blocks), F.bitmap_bucket_number("_at") == F.col("_block"), "left")
    bit = F.bitmap_bit_position("_at").cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, bit.bitwiseAND(F.lit(7))) == 1, F.lit(False))
    return rows.filter(found if inside else ~found).select(*(column(c) for c in frame.columns))


def column(name: str) -> Column:
    """A top-level column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(frame: DataFrame, without: tuple[str, ...] = ()) -> Column:
    """All columns but some in one struct ``_row``, so none can clash with an operator's own columns."""
    return F.struct(*(column(c) for c in frame.columns if c not in without)).alias("_row")


def unpacked(frame: DataFrame) -> list[Column]:
    return [F.col("_row").getField(c).alias(c) for c in frame.schema["_row"].dataType.names]


def held_out(doc_id: Column) -> Column:
    """True for rows that no classifier may learn from: crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def sigmoid(x):
    import numpy as np

    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))


class Recent(dict):
    """A memo of at most ``2 * size`` entries: when it is full, the older half goes.

    A missing key is computed by ``make``; results never depend on what the memo holds.
    """

    def __init__(self, make, size: int = 300_000):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def forget(self) -> None:
        """Frees the memory; a worker that goes on with other work should not hold on to it."""
        self.clear()
        self.older = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value
