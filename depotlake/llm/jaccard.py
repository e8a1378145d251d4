"""Near-duplicate groups by a grouped prefix join on word shingles.

A document is the set of its distinct shingles of ``size`` words; a shorter one is a single shingle
of all its words. Documents link when ``100 * intersection >= percent * union``.

1. Every shingle is counted in a table of fixed size, over all documents. Its counts order the
   shingles from rare to frequent; any order is right, a good one keeps prefixes selective.
2. Equal sets are one class. The prefix of a set is so long that two linked sets share a shingle
   of their prefixes. Classes with the same prefix and size are one group, which posts the prefix once.
3. Groups that share a prefix shingle and are of like size meet in a bucket; those without a partner there
   go before groups are expanded to their classes. Pairs of classes that pass the position filter are
   compared by parity bitmaps, which bound the intersection from above, and what remains is verified on
   the whole sets.
4. Only connectivity is asked for, so each bucket first compares its classes with one leader, which is
   then done. What is connected needs no further comparison: classes outside a bucket's largest
   component are compared with those of other components, block by block inside the tasks, first
   with the likeliest partners, then with all that are left.

A class has its smallest doc_id as its node; rows that share a doc_id count as one document. Rows without
doc_id are grouped with rows of equal words but link to nothing else. Documents without words are
alone. Repeated rows are one class. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.config import conf
from depotlake.llm.common import Scratch, map_arrow, ship, slices, staged, words_of
from depotlake.llm.components import components

# Cells of the table of counts, sent around in blocks: 8 MB in all, whatever the data.
CELL_BITS = 20
BLOCK_CELLS = 1 << 14
MIN_BITMAP = 512
# Bits of the filter for the sets that a round needs.
FILTER_BITS = 25
# One round with a leader per shingle, one with the likeliest partners, one with all that is left.
ROUNDS = 3
# Parts, by token, in which postings are shuffled; each one's shuffle files go before the next ones are written.
POSTING_PARTS = 4
# Rows of a block when what is left of a bucket is compared.
BLOCK_ROWS = 512

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9:14] = 32
_MIX = np.uint64(0x9E3779B97F4A7C15)

SKETCH = "salt int, block int, counts binary"
SETS = "doc_id long, n long, k1 long, k2 long, prefix_key long, prefix array<long>, bitmap array<long>"


@dataclass(frozen=True)
class Rule:
    """Linked: 100 * intersection >= percent * union of shingles of ``size`` words."""

    size: int = 5
    percent: int = 80

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1


def _blend(state: np.ndarray, value: np.ndarray) -> np.ndarray:
    state = (state ^ value) * _MIX
    return state ^ (state >> np.uint64(32))


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes (uint64) of every text."""
    words, _, _, bounds = words_of(column, _FOLD)
    hashes = [xxhash.xxh3_64_intdigest(w.rstrip(b" ")) for w in words.dictionary.to_pylist()]
    flat = np.array(hashes, np.uint64)[words.indices.to_numpy()] if hashes else np.zeros(0, np.uint64)
    count = max(len(flat) - size + 1, 0)
    grams = np.full(count, size, np.uint64)
    for k in range(size):
        grams = _blend(grams, flat[k : k + count])
    out = []
    for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if j - i >= size:
            out.append(np.unique(grams[i : j - size + 1]))
        elif j > i:
            whole = np.full(1, j - i, np.uint64)
            for k in range(i, j):
                whole = _blend(whole, flat[k : k + 1])
            out.append(whole)
        else:
            out.append(flat[:0])
    return out


def _cell(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << CELL_BITS, np.int64)
    for batch in slices(batches, "text"):
        sets = shingle_sets(batch.column("text"), size)
        counts += np.bincount(_cell(np.concatenate(sets)), minlength=1 << CELL_BITS)
    yield from _sketch_rows({i: c for i, c in enumerate(counts.reshape(-1, BLOCK_CELLS)) if c.any()})


def _sketch_rows(blocks: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    salt = TaskContext.get().partitionId() % 64
    for block, counts in blocks.items():
        narrow = counts.astype("<i4") if counts.max(initial=0) < 1 << 31 else counts.astype("<i8")
        yield pa.RecordBatch.from_arrays(
            [pa.array([salt], pa.int32()), pa.array([block], pa.int32()), pa.array([narrow.tobytes()])],
            names=["salt", "block", "counts"],
        )


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            found = np.frombuffer(counts, f"<i{len(counts) // BLOCK_CELLS}")
            total[block] = total.get(block, 0) + found.astype(np.int64)
    yield from _sketch_rows(total)


def shingle_counts(docs: DataFrame, rule: Rule) -> np.ndarray:
    """How many documents have a shingle of each cell; added up in two steps of fixed-size blocks."""
    parts = map_arrow(docs.select("text"), lambda b: _count(b, rule.size), SKETCH)
    parts = map_arrow(parts.repartition("block", "salt"), _add_up, SKETCH)
    whole = map_arrow(parts.repartition("block"), _add_up, SKETCH)
    counts = np.zeros(((1 << CELL_BITS) // BLOCK_CELLS, BLOCK_CELLS), np.int64)
    for _, block, found in whole.collect():  # as many rows as blocks
        counts[block] += np.frombuffer(found, f"<i{len(found) // BLOCK_CELLS}")
    return counts.reshape(-1)


def bitmap(grams: np.ndarray) -> np.ndarray:
    """Parity of the shingles per bit. Differing bits of two maps are at most the symmetric difference."""
    bits = max(MIN_BITMAP, 1 << (len(grams) - 1).bit_length())
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def describe(docs: DataFrame, counts: np.ndarray, rule: Rule) -> DataFrame:
    """The set of each document by its key, size, prefix and bitmap, see ``SETS``."""
    order = docs.sparkSession.sparkContext.broadcast(np.minimum(counts, (1 << 31) - 1).astype(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            columns: list[list] = [[], [], [], [], [], []]
            for grams in shingle_sets(batch.column("text"), rule.size):
                key = xxhash.xxh3_128_digest(grams.tobytes())
                k1, k2 = np.frombuffer(key, np.int64).tolist()
                first = grams[:0]
                if len(grams):
                    # Grams are sorted, so a stable sort breaks ties by hash.
                    first = grams[np.argsort(order.value[_cell(grams)], kind="stable")[: rule.prefix(len(grams))]]
                prefix_key = xxhash.xxh3_64_intdigest(first.tobytes() + len(grams).to_bytes(8, "little"))
                values = (len(grams), k1, k2, prefix_key - (1 << 63), first.view(np.int64), bitmap(grams) if len(grams) else first.view(np.int64))
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            ids = batch.column("doc_id").cast(pa.int64())
            yield pa.RecordBatch.from_arrays([ids, *arrays], names=[c.split()[0] for c in SETS.split(", ")])

    return map_arrow(docs.select("doc_id", "text"), run, SETS)


def _fits(rule: Rule, n: Column, m: Column, i: Column, j: Column) -> Column:
    """Sizes n, m and the places i, j of a shared shingle still allow a link."""
    most = F.least(i, j) + 1 + F.least(n - i - 1, m - j - 1)
    large, small = F.greatest(n, m), F.least(n, m)
    return (100 * small >= rule.percent * large) & ((100 + rule.percent) * most >= rule.percent * (n + m))


def classes_of(filled: DataFrame) -> DataFrame:
    """node (the smallest doc_id), key and prefix key of each distinct set; numbers only."""
    own = filled.where("doc_id IS NOT NULL").groupBy("k1", "k2", "n")
    return own.agg(F.min("doc_id").alias("node"), F.first("prefix_key").alias("prefix_key"))


def groups_of(filled: DataFrame) -> DataFrame:
    """group (the smallest doc_id, as small numbers take less room than keys), n and prefix of each prefix and size."""
    found = filled.where("doc_id IS NOT NULL").groupBy("prefix_key", "n")
    return found.agg(F.min("doc_id").alias("group"), F.min("prefix").alias("prefix")).select("group", "n", "prefix")


def shared_postings(groups: DataFrame, scratch: Scratch) -> DataFrame:
    """(token, group, n, place) of the prefix shingles that several groups have; reads from ``scratch``.

    Shared shingles and their postings are written one after the other and part by part, so that their
    shuffle files never lie side by side.
    """
    postings = groups.select("group", "n", F.posexplode("prefix").alias("place", "token"))
    parts = []
    for i in range(POSTING_PARTS):
        some = postings.where(F.pmod("token", F.lit(POSTING_PARTS)) == i)
        shared = scratch.staged(some.groupBy("token").count().where("count > 1").select("token"), "shared")
        parts.append(scratch.staged(some.join(shared, "token"), "met"))
    return reduce(DataFrame.union, parts)


def expanded(met: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """(token, node, n, place) of the classes of all groups that meet one of like size."""
    key = ["prefix_key", "n"]
    # Sizes that allow a link are at most one class apart, so two such groups share a key.
    width = -math.log(rule.percent / 100) if rule.percent < 100 else 1e-9
    step = F.floor(F.log(F.col("n").cast("double")) / (width * (1 + 1e-9)))
    sized = met.select("group", "place", F.explode(F.array(*(F.xxhash64("token", step + i) for i in (0, 1)))).alias("token"))
    several = sized.groupBy("token").count().where("count > 1").select("token")
    named = classes.groupBy(*key).agg(F.min("node").alias("group"), F.count("*").alias("members"))
    members = classes.select(*key, "node").join(named, key)
    spread = sized.join(several, "token").join(members.select("group", "node", "n"), "group")
    own = members.where("members > 1").select(F.col("prefix_key").alias("token"), "node", "n", F.lit(0).alias("place"))
    return spread.select("token", "node", "n", "place").union(own)


def entries(filled: DataFrame, classes: DataFrame, rule: Rule = Rule(), scratch: Scratch | None = None) -> DataFrame:  # noqa: B008
    """(token, node, n, place): classes in buckets of at least two, by shared prefix shingle and size.

    A group, all classes of one prefix and size, posts its prefix once. Groups alone with a shingle are
    dropped, and so are pairs of groups of too unlike sizes: sizes fall into classes, each a factor of
    ``percent`` wide, and a group meets those of its own and the neighbouring classes only. What is left is
    expanded to its classes, which also meet in a bucket of their own. The result reads from ``scratch``.
    """
    scratch = scratch or Scratch(filled.sparkSession)
    return expanded(shared_postings(scratch.staged(groups_of(filled), "groups"), scratch), classes, rule)


def _leaders(found: DataFrame) -> DataFrame:
    """One class of each bucket, chosen by hash, so that it is no other's choice of a common kind."""
    return found.groupBy("token").agg(F.min_by(F.struct("node", "n", "place"), F.xxhash64("node")).alias("l"))


def _against_leader(found: DataFrame, leaders: DataFrame, rule: Rule) -> DataFrame:
    """Each class of a bucket with the bucket's leader."""
    pairs = found.join(leaders, "token").where(F.col("node") != F.col("l.node"))
    pairs = pairs.where(_fits(rule, F.col("n"), F.col("l.n"), F.col("place"), F.col("l.place")))
    return pairs.select(F.least("node", "l.node").alias("a"), F.greatest("node", "l.node").alias("b")).distinct()


def _without_leaders(found: DataFrame, leaders: DataFrame) -> DataFrame:
    """What is left to compare: leaders have met everyone, and buckets of two are done."""
    left = found.join(leaders, "token").where(F.col("node") != F.col("l.node")).drop("l")
    several = left.groupBy("token").count().where("count > 1").select("token")
    return left.join(several, "token")


def _across(found: DataFrame, described: DataFrame, rule: Rule, best: bool) -> DataFrame:
    """Plausible pairs of a bucket in different components: those outside its largest one with all.

    A bucket is cut into blocks of some hundred rows, every block of outsiders meets every block of
    the bucket, and pairs are compared by size, place and bitmap inside a task; only what
    remains becomes a row. ``best`` keeps the likeliest partner of each outsider and block.
    """
    parts = found.groupBy("token", "component").agg(F.count("*").alias("size"))
    buckets = parts.groupBy("token").agg(
        F.max_by("component", "size").alias("major"),
        F.sum("size").alias("rows"),
        F.max("size").alias("most"),
        F.count("*").alias("parts"),
    )
    cuts = buckets.where("parts > 1").select(
        "token",
        "major",
        F.ceil((F.col("rows") - F.col("most")) / BLOCK_ROWS).alias("outside"),
        F.ceil(F.col("rows") / BLOCK_ROWS).alias("whole"),
    )
    maps = described.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("node"), "bitmap")
    rows = found.join(cuts, "token").join(maps, "node")
    spread = F.xxhash64("node", F.lit("block"))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))
    own = ["token", "node", "n", "place", "component", "bitmap"]
    outsiders = rows.where("component <> major").select(
        *own, F.pmod(spread, F.col("outside")).alias("i"), every("whole").alias("j"), F.lit(True).alias("outsider")
    )
    others = rows.select(
        *own, every("outside").alias("i"), F.pmod(spread, F.col("whole")).alias("j"), F.lit(False).alias("outsider")
    )
    blocks = outsiders.unionByName(others).repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("token", "i", "j")], axis=1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            pairs = []
            for x, y in zip(edges[:-1], edges[1:], strict=True):
                if key is not None and (keys[x] != key).any():
                    pairs += _compare(held, rule, best)
                    held = []
                key = keys[x]
                held.append(batch.slice(x, y - x))
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs, strict=True)], names=["a", "b"])
        if held and (pairs := _compare(held, rule, best)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs, strict=True)], names=["a", "b"])

    return map_arrow(blocks, run, "a long, b long").distinct()


def _compare(held: list[pa.RecordBatch], rule: Rule, best: bool) -> list[tuple[int, int]]:
    """The plausible pairs of one block of outsiders with one block of the bucket."""
    table = pa.Table.from_batches(held).combine_chunks()
    node, n, place, component = (table.column(c).to_numpy() for c in ("node", "n", "place", "component"))
    outsider = table.column("outsider").to_numpy(zero_copy_only=False).astype(bool)
    # Unsigned: numpy counts the bits of a signed word's absolute value.
    maps = [np.asarray(m, np.int64).view(np.uint64) for m in table.column("bitmap").to_numpy(zero_copy_only=False)]
    widths = np.array([len(m) for m in maps])
    others = np.flatnonzero(~outsider)
    stacked = {w: np.stack([maps[k] for k in others[widths[others] == w]]) for w in set(widths[others].tolist())}
    pairs = []
    for x in np.flatnonzero(outsider).tolist():
        small, large = np.minimum(n[x], n[others]), np.maximum(n[x], n[others])
        most = np.minimum(place[x], place[others]) + 1 + np.minimum(n[x] - place[x], n[others] - place[others]) - 1
        both = n[x] + n[others]
        fits = (component[others] != component[x]) & (100 * small >= rule.percent * large)
        fits &= (100 + rule.percent) * most >= rule.percent * both
        if not fits.any():
            continue
        # Maps of another width decide nothing.
        differing = np.zeros(len(others), np.int64)
        if widths[x] in stacked:
            differing[widths[others] == widths[x]] = np.bitwise_count(stacked[widths[x]] ^ maps[x]).sum(axis=1)
        fits &= (100 + rule.percent) * (both - differing) >= 2 * rule.percent * both
        hits = others[fits]
        if best and len(hits):
            hits = hits[[int(np.argmin(differing[fits] / both[fits]))]]
        pairs += [(min(node[x], node[y]), max(node[x], node[y])) for y in hits.tolist()]
    return pairs


def _plausible(pairs: DataFrame, described: DataFrame, rule: Rule) -> DataFrame:
    """Pairs whose bitmaps allow a link; maps of different widths decide nothing."""
    side = described.select("doc_id", "n", "bitmap")
    joined = pairs.join(side.toDF("a", "n_a", "map_a"), "a").join(side.toDF("b", "n_b", "map_b"), "b")
    differing = F.aggregate(
        F.zip_with("map_a", "map_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x
    )
    both = F.col("n_a") + F.col("n_b")
    # intersection = (both - difference) / 2 must reach percent / (100 + percent) of both.
    enough = (100 + rule.percent) * (both - differing) >= 2 * rule.percent * both
    return joined.where((F.size("map_a") != F.size("map_b")) | enough).select("a", "b").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for row in range(batch.num_rows):
                x = np.frombuffer(batch.column("set_a")[row].as_buffer(), np.uint64)
                y = np.frombuffer(batch.column("set_b")[row].as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= rule.percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    joined = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    return map_arrow(joined.select("a", "b", "set_a", "set_b"), run, "a long, b long")


def _marked(nodes: DataFrame) -> np.ndarray:
    """A table of 2 ** FILTER_BITS bits with those of the nodes' hashes set: 4 MB, whatever the data."""
    bit = F.pmod(F.xxhash64("node"), F.lit(1 << FILTER_BITS))
    words = nodes.select(F.shiftright(bit, 6).alias("word"), F.expr("shiftleft(1L, cast(pmod(xxhash64(node), 64) AS INT))").alias("mask"))
    marks = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for word, mask in words.groupBy("word").agg(F.bit_or("mask")).collect():  # at most a row per word
        marks[word] = mask
    return marks


def _is_marked(marks: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    words = (hashed % (1 << FILTER_BITS)) >> 6
    return (marks[words] >> (hashed % 64)) & 1 == 1


def whole_sets(docs: DataFrame, nodes: DataFrame, rule: Rule) -> tuple[DataFrame, Broadcast]:
    """(node, set) of the given nodes, computed from their texts, and of a few others; and what to destroy afterwards.

    The nodes are told by a filter of fixed size, so no text is shuffled; what it lets through
    besides is not asked for. The fuller it gets, the more sets are made in vain.
    """
    marks = docs.sparkSession.sparkContext.broadcast(_marked(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashed = batch.column("hashed").to_numpy()
            batch = batch.filter(pa.array(_is_marked(marks.value, hashed)))
            for part in slices(iter([batch]), "text"):
                sets = [x.tobytes() for x in shingle_sets(part.column("text"), rule.size)]
                ids = part.column("doc_id").cast(pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pa.array(sets, pa.binary())], names=["node", "set"])

    named = docs.where("doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64(F.col("doc_id").cast("long")).alias("hashed"))
    return map_arrow(named, run, "node long, set binary"), marks


def without(docs: DataFrame, away: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is not among those of ``away``.

    Rows that a filter of fixed size tells to stay are not shuffled with their texts; the others, those to go
    and the fuller the filter is the more besides, are joined.
    """
    ship(docs.sparkSession)
    marks = docs.sparkSession.sparkContext.broadcast(_marked(away.select(F.col("doc_id").cast("long").alias("node"))))

    @F.arrow_udf("boolean")
    def marked(hashed: pa.Array) -> pa.Array:
        return pa.array(_is_marked(marks.value, hashed.to_numpy(zero_copy_only=False)))

    maybe = marked(F.xxhash64(F.col("doc_id").cast("long")))
    asked = docs.where(maybe).join(away, "doc_id", "left_anti").select(docs.columns)
    return docs.where(~maybe).unionByName(asked)


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:  # noqa: B008
    """doc_id, n_shingles and component_id, the smallest doc_id that links reach, of every row."""
    # Every step is at rest once it is written; the shuffle files of its jobs go at once, not when the driver collects garbage.
    with conf(docs.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        return _near_duplicates(docs, rule)


def _near_duplicates(docs: DataFrame, rule: Rule) -> DataFrame:
    scratch = Scratch(docs.sparkSession)
    # A table is deleted as soon as what is made of it is at rest, so that few lie beside the next step's shuffle files.
    whole, own, held = (Scratch(docs.sparkSession) for _ in range(3))
    described = whole.staged(describe(docs, shingle_counts(docs, rule), rule), "described")
    filled = described.where("n > 0")
    classes = scratch.staged(classes_of(filled), "classes")
    groups = own.staged(groups_of(filled), "groups")
    # Only groups post prefixes, which are most of the table.
    described = scratch.staged(described.drop("prefix", "prefix_key"), "sets")
    filled = described.where("n > 0")
    whole.clear()
    met = shared_postings(groups, whole)
    own.clear()
    found = held.staged(expanded(met, classes, rule), "entries")
    whole.clear()
    links: DataFrame | None = None
    labels: DataFrame | None = None
    for turn in range(ROUNDS):
        # What a round has staged is of no use to the next one, but for its links and what is left.
        own = Scratch(docs.sparkSession)
        if turn == 0:
            leaders = own.staged(_leaders(found), "leaders")
            pairs = _plausible(_against_leader(found, leaders, rule), filled, rule)
        else:
            here = found.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
            pairs = _across(here, filled, rule, best=turn < ROUNDS - 1)
        pairs = own.staged(pairs, "pairs")
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        sets, marks = whole_sets(docs, nodes, rule)
        more = scratch.staged(_verified(pairs, own.staged(sets, "whole"), rule), "links")
        marks.destroy()
        links = more if links is None else links.union(more)
        if turn == 0:
            found = scratch.staged(_without_leaders(found, leaders), "entries")
            held.clear()
        own.clear()
        labels = components(links, scratch)
    node = classes.select("k1", "k2", "n", "node").join(labels, "node", "left")
    node = node.select("k1", "k2", "n", F.coalesce("component", "node").alias("component_id"))
    grouped = filled.select("doc_id", "n", "k1", "k2").join(node, ["k1", "k2", "n"], "left")
    alone = described.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    result = staged(grouped.select("doc_id", F.col("n").alias("n_shingles"), "component_id").union(alone), "groups")
    scratch.clear()
    return result
