"""Resharding that moves the fewest bytes.

A document's old shard is given by a column; within it, a hash of the document puts it into one of
``blocks`` blocks. Only the sizes of blocks reach the driver. There a minimum-cost flow from the old
shards' sizes to the new capacities says how many bytes go from where to where; staying costs
nothing. Each old shard's blocks are laid out in a row and cut into stretches of those lengths. A block that
a cut runs through is split between two documents. Every document is written to the files of its new
shard with its text; ``moved`` tells those that came from another shard.

Capacities differ by a byte at most; a shard's size differs from its capacity by less than the
documents at its cuts: a cut document goes where its middle lies.

A null text has no bytes and size 1. A null old shard counts as shard ``null_shard``. Null and
repeated doc_ids and repeated rows are placed row by row. An empty table gives an empty layout.
Extra columns are not read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from depotlake.config import scratch_dir

# A block holds about so many bytes, but an old shard has at least so many blocks.
BLOCK_BYTES = 256 << 20
MIN_BLOCKS = 1024


def capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (i < total % shards) for i in range(shards)]


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Units from each source to each sink at the least total cost, by successive shortest paths.

    The graph has one node per shard: as small as the number of shards, whatever the data.
    """
    sources, sinks = len(supply), len(capacity)
    nodes = sources + sinks + 2
    start, end = nodes - 2, nodes - 1
    arcs: list[list[int]] = []  # to, room, cost; the reverse arc is the neighbour by index ^ 1
    out: list[list[int]] = [[] for _ in range(nodes)]

    def arc(a: int, b: int, room: int, price: int) -> None:
        out[a].append(len(arcs))
        arcs.append([b, room, price])
        out[b].append(len(arcs))
        arcs.append([a, 0, -price])

    for i, units in enumerate(supply):
        arc(start, i, units, 0)
    for j, units in enumerate(capacity):
        arc(sources + j, end, units, 0)
    first = len(arcs)
    for i in range(sources):
        for j in range(sinks):
            arc(i, sources + j, supply[i], cost[i][j])
    potential = [0] * nodes
    while True:
        far = [float("inf")] * nodes
        via = [-1] * nodes
        far[start] = 0
        queue = [(0, start)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for e in out[a]:
                b, room, price = arcs[e]
                reached = d + price + potential[a] - potential[b]
                if room and reached < far[b]:
                    far[b], via[b] = reached, e
                    heapq.heappush(queue, (reached, b))
        if via[end] < 0:
            break
        potential = [p + (f if f < float("inf") else 0) for p, f in zip(potential, far, strict=True)]
        path, at = [], end
        while at != start:
            path.append(via[at])
            at = arcs[via[at] ^ 1][0]
        units = min(arcs[e][1] for e in path)
        for e in path:
            arcs[e][1] -= units
            arcs[e ^ 1][1] += units
    return [[arcs[first + 2 * (i * sinks + j) + 1][1] for j in range(sinks)] for i in range(sources)]


def stretches(
    blocks: list[tuple[int, int, int]], flow: list[list[int]]
) -> list[tuple[int, int, int, int, int]]:
    """(old, block, from, to, shard) in bytes of the block, from (old, block, size) and the flow.

    What stays comes first. Every block's last stretch is open-ended.
    """
    out = []
    by_old: dict[int, list[tuple[int, int]]] = {}
    for old, block, size in sorted(blocks):
        by_old.setdefault(old, []).append((block, size))
    for old, own in by_old.items():
        order = sorted(range(len(flow[old])), key=lambda shard: (shard != old, shard))
        left = [[shard, flow[old][shard]] for shard in order if flow[old][shard]]
        for block, size in own:
            at = 0
            while at < size and left:
                take = min(size - at, left[0][1])
                out.append([old, block, at, at + take, left[0][0]])
                at += take
                left[0][1] -= take
                if not left[0][1]:
                    left.pop(0)
            out[-1][3] = 1 << 62
    return [tuple(x) for x in out]


def reshard(
    docs: DataFrame,
    old_shard: Column,
    old_shards: int,
    new_shards: int,
    folder: str | None = None,
    null_shard: int = 0,
) -> DataFrame:
    """Write the new shards with all texts below ``folder`` and return the new layout.

    Columns: doc_id, size, text_crc32, old_shard, shard, slot (gapless from 0 in each shard), moved.
    Size and checksum are those of the text that was written. An old shard that is not
    among the ``old_shards`` fails the job; a null one is ``null_shard``.
    """
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "reshard")
    text = F.col("text").cast("string")
    old = F.coalesce(old_shard.cast("int"), F.lit(null_shard))
    outside = F.concat(F.lit(f"old shards are 0 to {old_shards - 1}, found "), old.cast("string"))
    rows = docs.select(
        "doc_id",
        text.alias("text"),
        F.when(old.between(0, old_shards - 1), old).otherwise(F.raise_error(outside).cast("int")).alias("old"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    per_shard = max(MIN_BLOCKS, -(-total // old_shards // BLOCK_BYTES))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(per_shard)).cast("int"))
    sizes = [tuple(r) for r in rows.groupBy("old", "block").agg(F.sum("size")).collect()]
    supply = [0] * old_shards
    for old, _, size in sizes:
        supply[old] += size
    cost = [[int(i != j) for j in range(new_shards)] for i in range(old_shards)]
    flow = min_cost_flow(supply, capacities(total, new_shards), cost)
    plan = stretches(sizes, flow)
    _write(spark, rows, plan, folder)
    return read_layout(spark, folder)


def _write(spark: SparkSession, rows: DataFrame, plan: list[tuple], folder: str) -> None:
    """The new shards, with the text of each document. Blocks are small and many, so the windows over them are too."""
    schema = "old int, block int, first long, last long, shard int"
    cuts = spark.createDataFrame(plan, schema)
    stays = cuts.groupBy("old", "block").agg(
        F.sort_array(F.collect_list(F.struct("first", "last", "shard"))).alias("stretches")
    )
    # As many rows as blocks, whose number is bounded by total / BLOCK_BYTES + shards * MIN_BLOCKS.
    placed = rows.join(F.broadcast(stays), ["old", "block"])
    # Large documents first, so a cut through a block falls between small ones if it can.
    order = Window.partitionBy("old", "block").orderBy(F.col("size").desc(), "doc_id", "text_crc32")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    narrow = placed.select("old", "block", "doc_id", "size", "text_crc32", "stretches", "text")
    # A document goes where its middle lies.
    middle = F.col("at") + F.floor(F.col("size") / 2)
    at = narrow.withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0).cast("long"))).withColumn(
        "shard", F.filter("stretches", lambda s: (s["first"] <= middle) & (middle < s["last"]))[0]["shard"]
    )
    ranked = at.withColumn(
        "place",
        F.row_number().over(Window.partitionBy("old", "block", "shard").orderBy(F.col("size").desc(), "doc_id", "text_crc32")),
    )
    moved = F.col("old") != F.col("shard")
    ranked.select(
        "old", "block", "shard", "place", "doc_id", "size", "text_crc32", moved.alias("moved"), "text"
    ).write.option("compression", "zstd").partitionBy("shard").parquet(folder)


def read_layout(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest with slots; all documents are measured anew from the files that hold them."""
    schema = "old int, block int, place int, doc_id long, moved boolean, text string, shard int"
    manifest = spark.read.schema(schema).parquet(folder)
    counts = manifest.groupBy("shard", "old", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("old", "block").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long"))).drop("n")
    own = F.coalesce("text", F.lit(""))
    return manifest.join(F.broadcast(bases), ["shard", "old", "block"]).select(
        "doc_id",
        (F.octet_length(own).cast("long") + 1).alias("size"),
        F.crc32(own.cast("binary")).alias("text_crc32"),
        F.col("old").alias("old_shard"),
        "shard",
        (F.col("base") + F.col("place") - 1).alias("slot"),
        "moved",
    )
