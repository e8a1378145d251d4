"""Periodic runs of words: maximal stretches in which every word equals the one a period before it.

1. Only stretches that can hold a long run get a tree. A run of at least ``times`` periods repeats each of
   its three-word sequences at least ``times - 1`` times, so a stretch is cut where a sequence is rarer in
   it, again and again until nothing changes. Runs lie whole inside stretches, with both their ends.
2. The stretches of a document, each ended by a symbol of its own, get two suffix trees by Ukkonen's
   algorithm, of the symbols and of their reversal. A tour of a tree notes for each pair of neighbouring
   leaves the depth where the walk turned; a table of minima over those answers the longest common
   extension of any two places in constant time.
3. Every run has a root that is the longest Lyndon word at its start in one of two orders, the
   alphabet's and its opposite. The longest Lyndon word ends where the next smaller suffix begins, so there are
   at most two candidates a place; each is extended in both directions by the trees.

Words are split at ASCII white space. Null, empty and white texts have no words and no runs. A text
is handled whole: time follows its length, memory the length of its periodic stretches (about 1 kB a word of
those while its trees are in use). Ties: runs with one start are ordered by period. Repeated rows
and null ids are handled row by row; all columns are carried in ``row``, whatever their names. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlake.llm.common import as_rows, map_arrow, slices

MIN_WORDS = 6
MIN_PERIODS = 4
# Text of a batch that is handled at once; results of so much wait in memory.
SLICE = 2 << 20

Edit = Callable[[int | None, list[bytes]], list[bytes]]
FOUND = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class SuffixTree:
    """Ukkonen's tree of a list of symbols whose last one occurs once.

    Node 0 is the root. Leaves come up in the order of their suffixes. ``edge`` finds a child by its
    parent and the first symbol of its label, ``symbols[start:end]``.
    """

    def __init__(self, symbols: list[int]):
        n, width = len(symbols), max(symbols) + 1
        start, end, link, edge = [0], [0], [0], {}
        leaves: list[int] = []
        node = first = length = waiting = 0
        for i, c in enumerate(symbols):
            waiting += 1
            made = 0
            while waiting:
                if not length:
                    first = i
                key = node * width + symbols[first]
                child = edge.get(key)
                if child is None:
                    edge[key] = len(start)
                    leaves.append(len(start))
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    if made:
                        link[made] = node
                        made = 0
                else:
                    at = start[child]
                    size = min(end[child], i + 1) - at
                    if length >= size:
                        node = child
                        length -= size
                        first += size
                        continue
                    if symbols[at + length] == c:
                        if made:
                            link[made] = node
                        length += 1
                        break
                    split = len(start)
                    edge[key] = split
                    start += (at, i)
                    end += (at + length, n)
                    link += (0, 0)
                    leaves.append(split + 1)
                    edge[split * width + c] = split + 1
                    start[child] = at + length
                    edge[split * width + symbols[at + length]] = child
                    if made:
                        link[made] = split
                    made = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    first = i - waiting + 1
        self.n, self.leaves = n, np.array(leaves, np.int64)
        self.size = np.array(end, np.int64) - np.array(start, np.int64)
        keys = np.fromiter(edge.keys(), np.int64, len(edge))
        self.parent, self.symbol = np.divmod(keys, width)
        self.child = np.fromiter(edge.values(), np.int64, len(edge))

    def tour(self, opposite: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the suffixes, and for each rank the depth where the walk turned before its leaf.

        The last symbol comes first in either order: a prefix of a text is smaller than the text.
        """
        last = self.symbol == self.symbol.max()
        place = np.where(last, -1, -self.symbol if opposite else self.symbol)
        if opposite:
            place = np.where(last, place.min() - 1, place)
        order = np.lexsort((place, self.parent))
        parent, child = self.parent[order], self.child[order]
        nodes = len(self.size)
        bounds = np.searchsorted(parent, np.arange(nodes + 1)).tolist()
        turns = np.ones(nodes, bool)
        turns[child[np.append(True, parent[1:] != parent[:-1])]] = False
        turns, kids, size = turns.tolist(), child.tolist(), self.size.tolist()
        above = np.zeros(nodes, np.int64)
        above[child] = parent
        above = above.tolist()
        depth = [0] * nodes
        walked, lows = [], []
        low = 0
        stack = kids[bounds[0] : bounds[1]][::-1]
        while stack:
            node = stack.pop()
            over = depth[above[node]]
            if turns[node]:
                low = over
            a, b = bounds[node], bounds[node + 1]
            if a == b:
                walked.append(node)
                lows.append(low)
            else:
                depth[node] = over + size[node]
                stack += kids[a:b][::-1]
        suffix = np.zeros(nodes, np.int64)
        suffix[self.leaves] = np.arange(self.n)
        rank = np.empty(self.n, np.int64)
        rank[suffix[np.array(walked)]] = np.arange(self.n)
        return rank, np.array(lows, np.int32)


class Extension:
    """Longest common extension of two places to the right, by minima over a tour of the tree."""

    def __init__(self, rank: np.ndarray, lows: np.ndarray):
        self.rank, self.tables = rank, [lows]
        step = 1
        while 2 * step <= len(lows):
            before = self.tables[-1]
            self.tables.append(np.minimum(before[:-step], before[step:]))
            step *= 2

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level).tolist():
            at = level == k
            table = self.tables[k]
            out[at] = np.minimum(table[a[at]], table[b[at] - (1 << k)])
        return out


def _next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each suffix the next one that is smaller; the end where there is none."""
    ranks, n = rank.tolist(), len(rank)
    out = [n] * n
    for i in range(n - 2, -1, -1):
        j, r = i + 1, ranks[i]
        while j < n and ranks[j] > r:
            j = out[j]
        out[i] = j
    return np.array(out, np.int64)


def runs_of(symbols: Sequence[int], min_words: int, min_periods: int) -> np.ndarray:
    """Rows (start, end, period) of all runs of a list of small numbers, by the method of this module."""
    n = len(symbols)
    last = max(symbols) + 1
    forward = SuffixTree([*symbols, last])
    rank, lows = forward.tour()
    right = Extension(rank, lows)
    back = SuffixTree([*reversed(symbols), last])
    left = Extension(*back.tour())
    found = []
    for order in (rank, forward.tour(opposite=True)[0]):
        # The end symbol's suffix is the smallest: no Lyndon word reaches beyond it.
        j = _next_smaller(order)[:n]
        i = np.arange(n)
        ends = j + np.where(j < n, right(i, np.minimum(j, n)), 0)
        # Place k of the text is place n - 1 - k of its reversal, and place n there is the end.
        starts = i - left(n - i, n - j)
        found.append(np.stack([starts, ends, j - i], axis=1))
    both = np.concatenate(found)
    size = both[:, 1] - both[:, 0]
    return np.unique(both[(size >= min_words) & (size >= min_periods * both[:, 2])], axis=0)


def _stretches(ids: np.ndarray, min_words: int, min_periods: int) -> list[tuple[int, int]]:
    """Disjoint or touching (start, end) of the places that can hold runs."""
    n = len(ids)
    least = min(min_periods - 1, min_words - 2)
    if n < min_words:
        return []
    width = int(ids.max()) + 1
    _, pairs = np.unique(ids[:-1] * width + ids[1:], return_inverse=True)
    _, grams, counts = np.unique(pairs[:-1].astype(np.int64) * width + ids[2:], return_inverse=True, return_counts=True)
    held = counts[grams] >= least
    while True:
        edge = np.flatnonzero(np.diff(np.concatenate([[0], held.view(np.int8), [0]])))
        starts, ends = edge[::2], edge[1::2]
        long = ends - starts + 2 >= min_words
        starts, ends = starts[long], ends[long]
        if not len(starts):
            return []
        # Count each sequence within its stretch only.
        places = np.concatenate([np.arange(a, b) for a, b in zip(starts, ends, strict=True)])
        inside = np.repeat(np.arange(len(starts)), ends - starts)
        _, same, counts = np.unique(inside * n + grams[places], return_inverse=True, return_counts=True)
        kept = counts[same] >= least
        if kept.all() and long.all():
            return [(a, b + 2) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        held = np.zeros(len(grams), bool)
        held[places[kept]] = True


def word_runs(words: list[bytes], min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> np.ndarray:
    """Rows (start, end, period) of a text's runs, by start, then period."""
    none = np.zeros((0, 3), np.int64)
    if len(words) < min_words:
        return none
    codes: dict[bytes, int] = {}
    ids = np.array([codes.setdefault(w, len(codes)) for w in words], np.int64)
    stretches = _stretches(ids, min_words, min_periods)
    if not stretches:
        return none
    symbols: list[int] = []
    origin = []
    for k, (a, b) in enumerate(stretches):
        origin.append(np.arange(a, b + 1))
        # A separator of its own ends each stretch, so no run reaches over it.
        symbols += [*ids[a:b].tolist(), len(codes) + k]
    _, dense = np.unique(np.array(symbols), return_inverse=True)
    found = runs_of(dense.tolist(), min_words, min_periods)
    shift = np.concatenate(origin)
    starts = shift[found[:, 0]]
    found = np.stack([starts, starts + found[:, 1] - found[:, 0], found[:, 2]], axis=1)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def collapse(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """The words without what runs repeat: of each run its first period stays, unless another run drops it."""
    if not len(found):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    return [w for w, k in zip(words, kept.tolist(), strict=True) if k]


def scan(
    docs: DataFrame,
    edit: Edit | None = None,
    min_words: int = MIN_WORDS,
    min_periods: int = MIN_PERIODS,
    carry: list[str] | None = None,
) -> DataFrame:
    """``row`` (the columns of ``carry``, else all), n_words, runs (start, length, period), the collapsed text.

    Runs have at least ``min_words`` words and ``min_periods`` (2 or more) periods. ``edit`` may change a
    document's words, given its doc_id, before they are searched.
    """
    if min_periods < 2 or min_words < 3:
        raise ValueError("a run has at least two periods and three words")
    carry = docs.columns if carry is None else carry
    row = T.StructType([docs.schema[c] for c in carry])
    doc_id = F.col("row.doc_id").cast("long") if edit else F.lit(None).cast("long")
    rows = as_rows(docs).select(
        F.struct(*(F.col("row").getField(c).alias(c) for c in carry)).alias("row"),
        F.col("row.text").cast("string").alias("text"),
        doc_id.alias("doc_id"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            sizes, bounds, parts, kept = [], [0], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                words = (text or b"").split()
                if edit:
                    words = edit(doc_id, words)
                found = word_runs(words, min_words, min_periods)
                sizes.append(len(words))
                parts.append(found)
                bounds.append(bounds[-1] + len(found))
                kept.append(b" ".join(collapse(words, found)))
            found = np.concatenate(parts)
            columns = [pa.array(c) for c in (found[:, 0], found[:, 1] - found[:, 0], found[:, 2])]
            structs = pa.StructArray.from_arrays(columns, names=["start", "length", "period"])
            arrays = [
                batch.column("row"),
                pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), structs),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "n_words", "runs", "collapsed"])

    return map_arrow(rows, run, T.StructType([T.StructField("row", row), *T.StructType.fromDDL(FOUND)]))


def best_run(runs: Column) -> Column:
    """Of an array of runs the one with the greatest exact length / period; then the first start, then period."""

    def better(one: Column, other: Column) -> Column:
        gain = other["length"] * one["period"] - one["length"] * other["period"]
        first = (other["start"] < one["start"]) | ((other["start"] == one["start"]) & (other["period"] < one["period"]))
        return F.when(one.isNull() | (gain > 0) | ((gain == 0) & first), other).otherwise(one)

    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)
