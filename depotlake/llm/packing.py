"""Packing along a space-filling curve.

Each document's token ids are hashed into a vector of signed counts and projected to a few
dimensions. The projections, standardised over the corpus, give a cell of a grid; the cell's place
on a Hilbert curve is the sort key. Documents are range-sorted by that key and cut into sequences
in this order, so a sequence holds neighbours. Exact copies have equal keys and are spread by
doc_id, so no group of copies lands in one task.

Null texts count as empty and still carry the end id. A null doc_id sorts first. Repeated rows are
packed as often as they occur. An empty table gives no pieces. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlake.llm.common import binary_column, map_arrow, slices, staged
from depotlake.llm.tokens import encode, tokenizer, with_end

HASHED = 512
DIMENSIONS = 3
BITS = 10
# Sequence ids: the partition of the sorted table, then the number within it.
SEQUENCE_BITS = 36

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of grid cells (n x dimensions), after J. Skilling (2004)."""
    x = [c.astype(np.int64) for c in cells.T]
    n, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(high, x[0] ^ (q - 1), x[0] ^ swap)
            x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where((x[n - 1] & q) > 0, turn ^ (q - 1), turn)
        q >>= 1
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | (((x[i] ^ turn) >> bit) & 1)
    return key


def project(ids: np.ndarray, bounds: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Hashed, signed and normalised count vectors of the documents, projected at random."""
    docs = len(bounds) - 1
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bucket = (mixed >> np.uint64(55)).astype(np.int64) % HASHED
    sign = ((mixed >> np.uint64(40)) & np.uint64(1)).astype(np.float64) * 2 - 1
    doc = np.repeat(np.arange(docs), np.diff(bounds))
    vectors = np.bincount(doc * HASHED + bucket, weights=sign, minlength=docs * HASHED)
    vectors = vectors.reshape(docs, HASHED)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    directions = np.random.default_rng(7).standard_normal((HASHED, dimensions))
    return (vectors / np.maximum(norms, 1e-9)) @ directions


def tokenised(docs: DataFrame, path: str, end: int, dimensions: int = DIMENSIONS) -> DataFrame:
    """doc_id, n, ids (packed as narrow as the vocabulary allows) and the projections p0, p1, ..."""
    places = [f"p{i}" for i in range(dimensions)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        narrow = np.uint16 if max(tokenizer(path).get_vocab_size(), end + 1) <= 1 << 16 else np.uint32
        for batch in slices(batches, "text"):
            ids, bounds = with_end(*encode(batch.column("text"), path), end)
            found = project(ids, bounds, dimensions)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(np.diff(bounds)),
                    pa.array([narrow().itemsize] * batch.num_rows, pa.int32()),
                    binary_column(ids.astype(narrow), bounds),
                    *(pa.array(found[:, i]) for i in range(dimensions)),
                ],
                names=["doc_id", "n", "width", "ids", *places],
            )

    schema = "doc_id long, n long, width int, ids binary, " + ", ".join(f"{p} double" for p in places)
    return map_arrow(docs.select("doc_id", "text"), run, schema)


def cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Fill sequences of ``length`` ids from the documents in their order.

    What is left at the end becomes sequences whose lengths are powers of two, so nothing is padded.
    """
    partition = TaskContext.get().partitionId()
    sequence, held, out = partition << SEQUENCE_BITS, [], []
    fill = 0

    def close(pieces):
        offset = 0
        for doc_id, start, ids, total in pieces:
            out.append((doc_id, start, len(ids), total, sequence, offset, ids.tobytes()))
            offset += len(ids)

    def emit():
        columns = list(zip(*out, strict=True))
        out.clear()
        kinds = [pa.int64()] * 6 + [pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
        )

    for batch in batches:
        for row in range(batch.num_rows):
            doc_id = batch.column("doc_id")[row].as_py()
            width = np.uint16 if batch.column("width")[row].as_py() == 2 else np.uint32
            ids = np.frombuffer(batch.column("ids")[row].as_buffer(), width).astype("<u4")
            at = 0
            while at < len(ids):
                part = ids[at : at + length - fill]
                held.append((doc_id, at, part, len(ids)))
                at += len(part)
                fill += len(part)
                if fill == length:
                    close(held)
                    sequence, held, fill = sequence + 1, [], 0
            if len(out) >= 1024:
                yield emit()
    size = 1 << max(length.bit_length() - 1, 0)
    while fill:
        while size > fill:
            size >>= 1
        part, need = [], size
        while need:
            doc_id, start, ids, total = held.pop(0)
            part.append((doc_id, start, ids[:need], total))
            if len(ids) > need:
                held.insert(0, (doc_id, start + need, ids[need:], total))
            need -= min(need, len(ids))
        close(part)
        sequence, fill = sequence + 1, fill - size
    if out:
        yield emit()


def pack(
    docs: DataFrame,
    path: str,
    length: int = 1024,
    end: int = 0,
    dimensions: int = DIMENSIONS,
    bits: int = BITS,
) -> DataFrame:
    """Pieces of all documents: where each starts in its document and in its sequence, and its ids.

    ``ids`` holds little-endian unsigned 32-bit integers. Every sequence has ``length`` ids but for
    the last few of each partition, whose lengths are powers of two.
    """
    places = [f"p{i}" for i in range(dimensions)]
    ready = staged(tokenised(docs, path, end, dimensions), "packing")
    moments = ready.select(
        *(F.avg(p).alias(f"mean_{p}") for p in places),
        *(F.stddev_pop(p).alias(f"dev_{p}") for p in places),
    ).first()
    middle = [moments[f"mean_{p}"] or 0.0 for p in places]
    spread = [moments[f"dev_{p}"] or 1.0 for p in places]

    @F.pandas_udf("long")
    def curve(*columns: pd.Series) -> pd.Series:
        cells = [
            np.clip(((c.to_numpy() - m) / s / 6 + 0.5) * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
            for c, m, s in zip(columns, middle, spread, strict=True)
        ]
        return pd.Series(hilbert_key(np.stack(cells, axis=1), bits))

    along = (
        ready.select(curve(*places).alias("curve"), "doc_id", "width", "ids")
        .repartitionByRange("curve", "doc_id")
        .sortWithinPartitions("curve", "doc_id", "ids")
    )
    return map_arrow(along, lambda batches: cut(batches, length), PIECES)


def unpack_ids(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u4")
