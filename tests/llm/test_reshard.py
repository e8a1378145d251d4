import itertools
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from depotlake.llm import reshard



def reshard_by_source(docs, old, new):
    return reshard.reshard(docs, F.pmod(F.crc32(F.col("source").cast("binary")), F.lit(old)), old, new)


def test_flow_is_the_cheapest():
    supply, capacity, cost = [3, 4], [2, 3, 2], [[0, 1, 4], [2, 0, 1]]
    flow = reshard.min_cost_flow(supply, capacity, cost)
    assert [sum(r) for r in flow] == supply and [sum(c) for c in zip(*flow, strict=True)] == capacity
    price = lambda f: sum(f[i][j] * cost[i][j] for i in range(2) for j in range(3))
    every = []
    for a, b in itertools.product(range(3), repeat=2):
        first = [a, b, 3 - a - b]
        second = [c - x for c, x in zip(capacity, first, strict=True)]
        if min(first + second) >= 0:
            every.append([first, second])
    assert price(flow) == min(map(price, every))


def test_flow_moves_only_the_surplus():
    supply = [100, 10, 40]
    capacity = reshard.capacities(150, 4)
    flow = reshard.min_cost_flow(supply, capacity, [[int(i != j) for j in range(4)] for i in range(3)])
    moved = sum(flow[i][j] for i in range(3) for j in range(4) if i != j)
    assert moved == sum(max(0, s - c) for s, c in zip(supply, capacity, strict=False))


def check_layout(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))


def test_layout_of_corner_rows(corners, corner_rows, clashing, nothing):
    rows = reshard_by_source(corners, 3, 4).collect()
    check_layout(rows, 4)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in corner_rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    assert sorted(map(tuple, reshard_by_source(clashing, 3, 4).collect()), key=repr) == sorted(map(tuple, rows), key=repr)
    assert reshard_by_source(nothing, 3, 4).count() == 0


def test_bytes_are_near_equal_and_stay_where_they_can(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("x"), (F.col("id") * 37 % 90 + 10).cast("int")).alias("text"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
    )
    rows = reshard_by_source(docs, 3, 5).collect()
    check_layout(rows, 5)
    new, old = Counter(), Counter()
    for r in rows:
        new[r.shard] += r["size"]
        old[r.old_shard] += r["size"]
        assert r.moved == (r.shard != r.old_shard)
    assert max(new.values()) - min(new.values()) <= 2 * 101
    least = sum(max(0, old[i] - sum(new.values()) // 5) for i in range(3))
    assert abs(sum(r["size"] for r in rows if r.moved) - least) <= 5 * 101


@pytest.mark.parametrize("outside", [7, -1, 6])
def test_old_shards_outside_the_range_are_refused(corners, outside):
    with pytest.raises(Exception, match=f"old shards are 0 to 5, found {outside}"):
        reshard.reshard(corners, F.lit(outside), 6, 8).collect()


def test_every_text_is_written_to_its_new_shard(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}" if i % 9 else None) for i in range(300)], "doc_id long, text string")
    layout = reshard.reshard(docs, F.lit(0), 2, 3, f"{tmp_path}/new").collect()
    written = {r.doc_id: (r.text, r.shard) for r in spark.read.parquet(f"{tmp_path}/new").collect()}
    assert any(r.moved for r in layout) and not all(r.moved for r in layout)
    assert written == {r.doc_id: (f"text {r.doc_id}" if r.doc_id % 9 else None, r.shard) for r in layout}
    assert len(written) == 300
