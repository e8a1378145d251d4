"""Token ids in a Re-Pair grammar file format.

Documents are range-sorted by doc_id; each partition is a shard, written as blocks of about
``BLOCK_IDS`` ids. A block replaces frequent pairs of neighbouring symbols by new symbols, again and
again, until no pair is worth a rule. Stored per block (a row of a Parquet file):

    shard, block, first_token   the place of the block; ids of the shard before it
    doc_ids, doc_nulls          the documents, and which of the ids are null
    doc_tokens                  ids of each document, with the end id
    doc_symbols                 symbols of each document: no symbol crosses a document's end
    rules                       two symbols per rule, rule k making symbol ``base`` + k
    expansions                  ids that each rule stands for, for access by position
    symbols                     the remaining sequence

All arrays are little-endian. A document is decoded alone through ``doc_symbols``, a range of ids
through the running sum of the expansion lengths.

Null texts are empty and hold the end id alone; null doc_ids come first. Repeated rows are kept.
An empty table gives no block. Extra columns are ignored. A block holds whole documents, so memory
follows ``BLOCK_IDS`` plus the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from depotlake.llm.common import binary_column, map_arrow, ragged_take, slices
from depotlake.llm.tokens import encode, tokenizer, with_end

BLOCK_IDS = 1 << 20
# A pair needs so many occurrences for a rule, and a round must shorten the sequence by this share.
MIN_PAIRS = 8
MIN_GAIN = 0.004
_TABLE_BITS = 18
_HASH = np.array([0x9E3779B1, 0x85EBCA77], np.uint32)

BLOCKS = (
    "shard int, block int, first_token long, n_tokens long, base int, doc_ids binary, doc_nulls binary, "
    "doc_tokens binary, doc_symbols binary, rules binary, expansions binary, symbols binary"
)
DOCUMENTS = "shard int, doc_id long, shard_start long, n_tokens long, ids binary"


def compress(ids: np.ndarray, base: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules (k x 2), their expansion lengths and the remaining symbols.

    Every round counts all pairs, gives rules to those within a quarter of the most frequent one,
    and replaces their occurrences from left to right. Pairs that start with a document's end get none.
    """
    seq = ids.astype(np.uint32)
    ends = np.flatnonzero(seq == end)
    sizes = np.ones(base, np.int64)
    rules = [np.zeros((0, 2), np.int64)]
    while len(seq) > 1:
        # Symbols of 32 bits, whose products wrap; pairs that get no rule share a slot behind the others.
        slot = ((seq[:-1] * _HASH[0] + seq[1:] * _HASH[1]) >> np.uint32(32 - _TABLE_BITS)).astype(np.intp)
        slot[ends[: np.searchsorted(ends, len(slot))]] = 1 << _TABLE_BITS
        count = np.bincount(slot, minlength=(1 << _TABLE_BITS) + 1)
        count[-1] = 0
        often = max(MIN_PAIRS, int(count.max(initial=0)) // 4)
        at = np.flatnonzero((count >= often)[slot])
        if not len(at):
            break
        run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        place = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
        at = at[place % 2 == 0]
        pair = (seq[at].astype(np.int64) << 32) | seq[at + 1]
        found, which, times = np.unique(pair, return_inverse=True, return_counts=True)
        good = times >= min(often, max(MIN_PAIRS, times.max() // 4))
        at, which = at[good[which]], (np.cumsum(good) - 1)[which[good[which]]]
        if not len(at):
            break
        made = np.stack([found[good] >> 32, found[good] & 0xFFFFFFFF], axis=1)
        first = len(sizes)
        sizes = np.append(sizes, sizes[made[:, 0]] + sizes[made[:, 1]])
        rules.append(made)
        seq[at] = first + which
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        # What closes a document moves to the front by what goes before it, or with it if it is a pair's second symbol.
        ends = ends - np.searchsorted(at + 1, ends, side="right")
        before, seq = len(seq), seq[keep]
        if often == MIN_PAIRS and before - len(seq) < MIN_GAIN * before:
            break
    return np.concatenate(rules), sizes[base:], seq.astype(np.int64)


def expand(symbols: np.ndarray, rules: np.ndarray, sizes: np.ndarray, base: int) -> np.ndarray:
    """The ids of a run of symbols. Long runs copy what each rule stands for, which is expanded once."""
    if len(symbols) > len(rules) > 0:
        made = _unfold(np.arange(base, base + len(rules)), rules, base)
        big = symbols >= base
        which = np.where(big, symbols - base, 0)
        starts = np.where(big, (np.cumsum(sizes) - sizes)[which], len(made) + np.arange(len(symbols)))
        return ragged_take(np.append(made, symbols.astype(np.uint32)), starts, np.where(big, sizes[which], 1))
    return _unfold(symbols, rules, base)


def _unfold(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids of symbols, by replacing all rules at once until none is left."""
    seq = symbols.astype(np.int64)
    while len(big := np.flatnonzero(seq >= base)):
        right = rules[seq[big] - base, 1]
        seq[big] = rules[seq[big] - base, 0]
        seq = np.insert(seq, big + 1, right)
    return seq.astype(np.uint32)


def decode_range(block: dict, start: int, length: int) -> np.ndarray:
    """Ids ``start`` to ``start + length`` of a block, expanding only the symbols that hold them."""
    rules, sizes, symbols = _grammar(block)
    lengths = np.where(symbols >= block["base"], sizes[np.maximum(symbols - block["base"], 0)] if len(sizes) else 1, 1)
    ends = np.cumsum(lengths)
    first, last = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, start + length, side="left") + 1
    ids = expand(symbols[first:last], rules, sizes, block["base"])
    skip = start - (ends[first - 1] if first else 0)
    return ids[skip : skip + length]


def _grammar(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rules = np.frombuffer(block["rules"], "<u4").astype(np.int64).reshape(-1, 2)
    return rules, np.frombuffer(block["expansions"], "<u4").astype(np.int64), np.frombuffer(block["symbols"], "<u4").astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], path: str, end: int) -> Iterator[pa.RecordBatch]:
    shard, block, first = TaskContext.get().partitionId(), 0, 0
    base = max(tokenizer(path).get_vocab_size(), end + 1)
    held, waiting = [], 0

    def write():
        nonlocal block, first, held, waiting
        doc_ids = np.concatenate([h[0] for h in held])
        nulls = np.concatenate([h[1] for h in held])
        ids = np.concatenate([h[2] for h in held])
        tokens = np.concatenate([h[3] for h in held])
        rules, sizes, symbols = compress(ids, base, end)
        ends = np.cumsum(np.where(symbols >= base, sizes[np.maximum(symbols - base, 0)] if len(sizes) else 1, 1))
        per_doc = np.diff(np.searchsorted(ends, np.cumsum(tokens)) + 1, prepend=0)
        values = [
            (shard, pa.int32()),
            (block, pa.int32()),
            (first, pa.int64()),
            (len(ids), pa.int64()),
            (base, pa.int32()),
            *((np.ascontiguousarray(a, t).tobytes(), pa.binary()) for a, t in (
                (doc_ids, "<i8"), (nulls, "u1"), (tokens, "<u4"), (per_doc, "<u4"),
                (rules, "<u4"), (sizes, "<u4"), (symbols, "<u4"),
            )),
        ]
        names = [c.split()[0] for c in BLOCKS.split(", ")]
        block, first, held, waiting = block + 1, first + len(ids), [], 0
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in values], names=names)

    for batch in slices(batches, "text"):
        ids, bounds = with_end(*encode(batch.column("text"), path), end)
        keys = batch.column("doc_id").cast(pa.int64())
        doc_ids, nulls = keys.fill_null(0).to_numpy(), keys.is_null().to_numpy(zero_copy_only=False)
        row = 0
        while row < batch.num_rows:
            stop = int(np.searchsorted(bounds, bounds[row] + BLOCK_IDS - waiting, side="left"))
            stop = min(max(stop, row + 1), batch.num_rows)
            held.append((doc_ids[row:stop], nulls[row:stop], ids[bounds[row] : bounds[stop]], np.diff(bounds[row : stop + 1])))
            waiting += int(bounds[stop] - bounds[row])
            row = stop
            if waiting >= BLOCK_IDS:
                yield write()
    if held:
        yield write()


def write_grammar(docs: DataFrame, folder: str, path: str, end: int = 2) -> None:
    """Encode all texts and write them in ascending doc_id order."""
    ordered = (
        docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    )
    blocks = map_arrow(ordered, lambda batches: _blocks(batches, path, end), BLOCKS)
    blocks.write.option("compression", "zstd").parquet(folder)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in batch.to_pylist():
            rules, sizes, symbols = _grammar(block)
            tokens = np.frombuffer(block["doc_tokens"], "<u4").astype(np.int64)
            bounds = np.append(0, np.cumsum(tokens))
            ids = expand(symbols, rules, sizes, block["base"])
            nulls = np.frombuffer(block["doc_nulls"], "u1").astype(bool)
            step = max(1, len(tokens) // max(1, len(ids) // BLOCK_IDS))
            for i in range(0, len(tokens), step):
                j = min(i + step, len(tokens))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block["shard"]] * (j - i), pa.int32()),
                        pa.array(np.frombuffer(block["doc_ids"], "<i8")[i:j], mask=nulls[i:j]),
                        pa.array(block["first_token"] + bounds[i:j]),
                        pa.array(tokens[i:j]),
                        binary_column(ids[bounds[i] : bounds[j]].astype("<u4"), bounds[i : j + 1] - bounds[i]),
                    ],
                    names=[c.split()[0] for c in DOCUMENTS.split(", ")],
                )


def read_grammar(spark: SparkSession, folder: str) -> DataFrame:
    """Every document: doc_id, start (ids of all documents before it), n_tokens and ids.

    The offsets of the shards come from one row per shard; there are as many as partitions.
    """
    blocks = spark.read.parquet(folder)
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_offset"))
    return (
        map_arrow(blocks, _documents, DOCUMENTS)
        .join(F.broadcast(offsets), "shard")
        .select("doc_id", (F.col("shard_offset") + F.col("shard_start")).alias("start"), "n_tokens", "ids", "shard")
    )
