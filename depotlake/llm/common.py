"""What the operators share: reading tables, tables at rest, token arrays."""

from __future__ import annotations

import ctypes
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from depotlake.config import scratch_dir
from depotlake.sources.files import delete_paths

# Python workers see at most this much text of a batch at once, plus one whole document.
SLICE_BYTES = 8 << 20
# Bytes of a batch on its way between the JVM and a worker, which hold it both; plus one row.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back. Cuts the lineage: a lost executor costs no rerun."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables at rest that are deleted together once what is made of them is at rest itself."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def staged(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_dir(self.spark, label)
        self.paths.append(path)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        delete_paths(self.spark, self.paths)
        self.paths = []


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, which may not have it on their path."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="depotlake-zip-")) / package.name
        context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def give_back() -> None:
    """Return what a worker has freed to the system; Spark reuses workers, and allocators keep memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library has no such call
        return


def map_arrow(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers, by batches of a few megabytes."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()

    return df.mapInArrow(run, schema)


def raw_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string()).cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return bounds, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def as_rows(df: DataFrame) -> DataFrame:
    """All columns as one struct, so that no name clashes with what an operator adds."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))


def slices(
    batches: Iterator[pa.RecordBatch], text: str | Callable[[pa.RecordBatch], pa.Array], size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut to about ``size`` bytes of text each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        bounds, _ = raw_texts(text(batch) if callable(text) else batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(bounds, bounds[start] + size, side="left"))
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def sample_texts(docs: DataFrame, code: Column, documents: int, size: int, codes: int = 1) -> dict[str, list[str]]:
    """The first ``size`` characters of about ``documents`` distinct texts for each of the ``codes`` most
    frequent values of ``code``: a bounded sample to fit a classifier on.

    One pass counts the codes, one takes the texts whose hash falls below the code's share. Copies have
    one hash and are merged before they leave their tasks. The order of the rows does not matter.
    """
    rows = docs.select(code.alias("code"), F.col("text").cast("string").alias("text"))
    rows = rows.where((F.length("text") > 0) & F.col("code").isNotNull())
    counts = rows.groupBy("code").count().orderBy(F.desc("count"), "code").limit(codes).collect()
    if not counts:
        return {}
    shares = F.create_map(*(F.lit(x) for r in counts for x in (r[0], min(1.0, 1.5 * documents / r[1]))))
    hashed = rows.select("code", F.xxhash64("text").alias("h"), F.substring("text", 1, size).alias("start"))
    place = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    chosen = hashed.where(place < F.element_at(shares, F.col("code"))).groupBy("code", "h").agg(F.min("start").alias("start"))
    found: dict[str, list[str]] = {r[0]: [] for r in counts}
    for r in chosen.orderBy("h", "code").limit(2 * documents * len(counts)).collect():
        if len(found[r.code]) < documents:
            found[r.code].append(r.start)
    return found


def ragged_take(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[starts[i] : starts[i] + lengths[i]] of every i, one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return values[:0]
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])]


def binary_column(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary value per document from a flat array and its bounds (in items)."""
    width = data.dtype.itemsize
    offsets = pa.py_buffer((bounds.astype(np.int64) * width).tobytes())
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(data))]
    ).cast(pa.binary())


def words_of(
    column: pa.Array, fold: np.ndarray
) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts (with the separators after them), first bytes, ends and the texts' bounds.

    ``fold`` maps every byte; what it maps to a space separates words.
    """
    bounds, raw = raw_texts(column)
    data = fold[raw]
    inside = data != 32
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    firsts = bounds[:-1][bounds[:-1] < bounds[1:]]
    start[firsts] = inside[firsts]
    starts = np.flatnonzero(start[: bounds[-1]])
    starts = starts[np.searchsorted(starts, bounds[0]) :]
    # Where a word ends: at a separator or where its text ends.
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    stop[firsts[firsts > 0] - 1] |= inside[firsts[firsts > 0] - 1]
    if bounds[-1] > bounds[0]:
        stop[bounds[-1] - 1] |= inside[bounds[-1] - 1]
    ends = np.flatnonzero(stop[: bounds[-1]])
    ends = ends[np.searchsorted(ends, bounds[0]) :] + 1
    edges = np.append(starts, bounds[-1]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))]
    ).dictionary_encode()
    return words, starts, ends, np.searchsorted(starts, bounds)
