"""What several operators need: tables, scratch tables, text as bytes in numpy."""

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetide.session import scratch_path

#: Bytes of text a numpy kernel takes at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
#: Bytes of an Arrow batch on its way to Python; a larger row is a batch of its own.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table of the sample data."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back, which cuts the lineage.

    Values that depend on how rows were dealt to tasks (row numbers of a task) are fixed
    from here on, whatever is recomputed later.
    """
    path = scratch_path(frame.sparkSession, name)
    with small_batches(frame.sparkSession):
        frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs started here send Python batches of bounded bytes, whatever the rows hold.

    By default a batch is 10,000 rows, which may be any number of bytes.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def returning(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The step ``run``, after whose last batch what it has freed goes back to the system.

    Python workers wait for later tasks, one for each core; otherwise each holds on to most of
    what its largest step took, whatever the next one needs.
    """

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
        if trim:
            trim(0)

    return whole


def body(text: str = "text") -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a text or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    count = len(column)
    if not count:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null(b"")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64, count + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer row comes alone."""
    first, count = 0, len(offsets) - 1
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), count)
        yield first, last
        first = last


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices ``start, start + 1, ...`` of every range, one range after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
