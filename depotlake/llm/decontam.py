"""Benchmark decontamination by a broadcast set of test n-grams.

Words are runs of ASCII letters and digits and of non-ASCII characters, with A-Z lower-cased. An item
gives all its windows of ``window`` words, or one window of all its words when it has fewer. The words
of the benchmark are numbered; a training word outside that vocabulary has number 0 and breaks every
window. Remaining windows are looked up by a hash and verified number by number, which is exact.

The set goes to the tasks in blocks of at most ``MAX_BYTES`` of benchmark text (one item at least),
one pass over the documents per block; a benchmark that fits takes one pass and no shuffle.

Null and word-less texts have no words and no hits. Repeated rows, null ids and ties are handled row
by row. An empty benchmark hits nothing, an empty table gives no rows. Extra columns are carried.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlake.llm.common import as_rows, map_arrow, ragged_take, raw_texts, slices, staged, words_of

WINDOW = 13
MAX_BYTES = 32 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 32

HIT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        # Words hit, as pairs of first byte and byte after the last one in the UTF-8 text.
        T.StructField("spans", T.ArrayType(T.LongType())),
    ]
)


@dataclass
class Windows:
    """Windows of one length: their hashes in order, their word numbers, and the items of each."""

    length: int
    factor: np.uint64
    hashes: np.ndarray
    numbers: np.ndarray
    item_starts: np.ndarray
    item_counts: np.ndarray
    items: np.ndarray


def _hash(numbers: np.ndarray, at: np.ndarray, length: int, factor: np.uint64) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for k in range(length):
        out = (out + numbers[at + k].astype(np.uint64)) * factor
        out ^= out >> np.uint64(29)
    return out


def index_items(texts: list[str | None], window: int) -> tuple[dict[bytes, int], list[Windows]]:
    """The vocabulary and the windows of a block of items."""
    words, _, _, bounds = words_of(pa.array(texts, pa.string()), _FOLD)
    distinct = [w.rstrip(b" ") for w in words.dictionary.to_pylist()]
    vocabulary = {w: i + 1 for i, w in enumerate(dict.fromkeys(distinct))}
    flat = np.array([vocabulary[w] for w in distinct], np.int64)[words.indices.to_numpy()] if distinct else np.zeros(0, np.int64)
    by_length: dict[int, dict[tuple, set[int]]] = defaultdict(lambda: defaultdict(set))
    for item in range(len(texts)):
        own = flat[bounds[item] : bounds[item + 1]].tolist()
        length = min(window, len(own))
        for i in range(len(own) - length + 1) if own else ():
            by_length[length][tuple(own[i : i + length])].add(item)
    found = []
    for length, keyed in by_length.items():
        numbers = np.array(list(keyed), np.int64)
        for factor in (np.uint64(0x9E3779B97F4A7C15 + 2 * k) for k in range(1000)):
            hashes = _hash(numbers.reshape(-1), np.arange(len(numbers)) * length, length, factor)
            if len(np.unique(hashes)) == len(hashes):
                break
        order = np.argsort(hashes)
        groups = [sorted(keyed[tuple(row)]) for row in numbers[order].tolist()]
        counts = np.array([len(g) for g in groups])
        found.append(
            Windows(length, factor, hashes[order], numbers[order], np.cumsum(counts) - counts, counts, np.array([i for g in groups for i in g]))
        )
    return vocabulary, found


def _scan(column: pa.Array, vocabulary: dict[bytes, int], windows: list[Windows]):
    """Number of words per text; hit flags of all words; (text, item) pairs; words' bytes and bounds."""
    words, starts, ends, bounds = words_of(column, _FOLD)
    known = [vocabulary.get(w.rstrip(b" "), 0) for w in words.dictionary.to_pylist()]
    numbers = np.array(known, np.int64)[words.indices.to_numpy()] if known else np.zeros(0, np.int64)
    texts = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    seen = np.append(0, np.cumsum(numbers > 0))
    cover = np.zeros(len(numbers) + 1, np.int64)
    pairs = [np.zeros((0, 2), np.int64)]
    for w in windows:
        if len(numbers) < w.length:
            continue
        at = np.flatnonzero(seen[w.length :] - seen[: -w.length] == w.length)
        at = at[texts[at] == texts[at + w.length - 1]]
        hashes = _hash(numbers, at, w.length, w.factor)
        which = np.minimum(np.searchsorted(w.hashes, hashes), len(w.hashes) - 1)
        same = w.hashes[which] == hashes
        at, which = at[same], which[same]
        same = np.ones(len(at), bool)
        for k in range(w.length):
            same &= numbers[at + k] == w.numbers[which, k]
        at, which = at[same], which[same]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + w.length, -1)
        items = ragged_take(w.items, w.item_starts[which], w.item_counts[which])
        pairs.append(np.stack([np.repeat(texts[at], w.item_counts[which]), items], axis=1))
    return np.cumsum(cover[:-1]) > 0, np.unique(np.concatenate(pairs), axis=0), starts, ends, bounds


def _merge(spans: list[int]) -> list[int]:
    out: list[int] = []
    for start, end in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, carry: list[str] | None = None) -> DataFrame:
    """``row`` (the carried columns of each document) and ``hit``, see ``HIT``."""
    sized = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + 2 * size // MAX_BYTES
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    carry = docs.columns if carry is None else carry
    row = T.StructType([docs.schema[c] for c in carry])
    schema = T.StructType([T.StructField("row", row), T.StructField("hit", HIT)])

    def run_block(items: list, first: bool, last: bool):
        names = [i.item_id or "" for i in items]
        index = docs.sparkSession.sparkContext.broadcast(index_items([i.text for i in items], window))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, lambda b: pc.struct_field(b.column("row"), "text")):
                rows = batch.column("row")
                flags, pairs, starts, ends, bounds = _scan(pc.struct_field(rows, "text"), *index.value)
                total = np.append(0, np.cumsum(flags))[bounds]
                before = None if first else batch.column("hit").to_pylist()
                origin = raw_texts(pc.struct_field(rows, "text"))[0][:-1]
                by_text: dict[int, list[str]] = defaultdict(list)
                for text, item in pairs.tolist():
                    by_text[text].append(names[item])
                hits = []
                for i in range(batch.num_rows):
                    n_words, items_hit, spans = int(bounds[i + 1] - bounds[i]), by_text.get(i, []), []
                    n_hit = int(total[i + 1] - total[i])
                    old = before[i] if before else None
                    if n_hit or old and old["n_hit"]:
                        hit = np.flatnonzero(flags[bounds[i] : bounds[i + 1]]) + bounds[i]
                        spans = np.stack([starts[hit], ends[hit]], axis=1).reshape(-1) - origin[i]
                        spans = spans.tolist()
                        if old:
                            # Word spans of the blocks so far; equal words have equal spans.
                            words = set(zip(spans[::2], spans[1::2])) | set(zip(old["spans"][::2], old["spans"][1::2]))
                            spans, n_hit = [x for w in sorted(words) for x in w], len(words)
                            items_hit = items_hit + old["items"]
                    hits.append((n_words, n_hit, sorted(items_hit), spans))
                if not last:
                    kept = rows
                else:
                    kept = pa.StructArray.from_arrays([pc.struct_field(rows, c) for c in carry], names=carry)
                found = pa.StructArray.from_arrays(
                    [
                        pa.array([h[0] for h in hits], pa.int64()),
                        pa.array([h[1] for h in hits], pa.int64()),
                        pa.array([h[2] for h in hits], pa.list_(pa.string())),
                        pa.array([h[3] for h in hits], pa.list_(pa.int64())),
                    ],
                    names=HIT.names,
                )
                yield pa.RecordBatch.from_arrays([kept, found], names=["row", "hit"])

        return run

    out = as_rows(docs)
    whole = T.StructType([T.StructField("row", docs.schema), T.StructField("hit", HIT)])
    for i in range(blocks):
        items = sized.where(block == i).collect()
        last = i == blocks - 1
        out = map_arrow(out, run_block(items, i == 0, last), schema if last else whole)
        if not last:
            out = staged(out, "decontaminate")
    return out


def contaminated(hit: str = "hit"):
    """A document with hits in at least one word of twenty."""
    return (F.col(f"{hit}.n_hit") > 0) & (20 * F.col(f"{hit}.n_hit") >= F.col(f"{hit}.n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW) -> DataFrame:
    """The documents without contaminated ones, or with the words that were hit cut out of all texts."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be documents or spans, not {remove}")
    scanned = scan(docs, benchmark, window)
    if remove == "documents":
        return scanned.where(~contaminated()).select("row.*")

    columns = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, spans = batch.column("row"), pc.struct_field(batch.column("hit"), "spans").to_pylist()
            texts = pc.struct_field(rows, "text").to_pylist()
            for i, own in enumerate(spans):
                if own:
                    raw, at, parts = texts[i].encode(), 0, []
                    merged = _merge(own)
                    for start, end in zip(merged[::2], merged[1::2], strict=True):
                        parts.append(raw[at:start])
                        at = end
                    texts[i] = b"".join([*parts, raw[at:]]).decode()
            arrays = [pa.array(texts, pa.string()) if c == "text" else pc.struct_field(rows, c) for c in columns]
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(arrays, names=columns)], names=["row"])

    return map_arrow(scanned, cut, T.StructType([T.StructField("row", docs.schema)])).select("row.*")
