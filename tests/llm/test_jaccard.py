import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from depotlake.llm import jaccard
from depotlake.llm.components import components
from tests.llm.conftest import prose


def brute(rows, size, percent):
    sets = {}
    for i, text in rows:
        words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
        count = max(len(words) - size + 1, 1 if words else 0)
        sets[i] = {tuple(words[k : k + size]) for k in range(count)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {(i, len(s), find(i)) for i, s in sets.items()}


def edited(text, chance, edits):
    words = text.split()
    for _ in range(edits):
        words[chance.randrange(len(words))] = f"new{chance.randrange(10**6)}"
    if chance.random() < 0.3:
        words = words[chance.randrange(3) :]
    return " ".join(words)


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_groups_equal_brute_force(spark, size, percent):
    chance = random.Random(size)
    bases = [prose(n, 50 + n) for n in (9, 40, 41, 160, 700)]
    shared = prose(60, 99)
    texts = []
    for base in bases:
        texts += [edited(base, chance, chance.randrange(0, 1 + len(base.split()) // 12)) for _ in range(25)]
    # A passage that many otherwise different documents share, and a chain of small edits.
    texts += [prose(80, 500 + k) + " " + shared for k in range(25)]
    link = prose(100, 3)
    for _ in range(12):
        link = edited(link, chance, 1)
        texts.append(link)
    texts += [texts[0], texts[30], None, "", "one", "One", "one two"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {tuple(r) for r in jaccard.near_duplicates(docs, jaccard.Rule(size, percent)).collect()}
    assert found == brute(rows, size, percent)


def small_words(chance, count=400):
    """Few words, so buckets hold many components and bitmaps differ in every bit, the top one included."""
    vocabulary = [f"w{k}" for k in range(60)]
    bases = [[chance.choice(vocabulary) for _ in range(60)] for _ in range(12)]
    for _ in range(count):
        words = list(chance.choice(bases))
        for _ in range(chance.randrange(4)):
            words[chance.randrange(60)] = chance.choice(vocabulary)
        yield " ".join(words[: chance.choice([60, 60, 58, 55])])


@pytest.mark.parametrize("block_rows", [512, 3])
def test_crowded_buckets_equal_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block_rows)
    rows = list(enumerate(small_words(random.Random(7), 400 if block_rows > 3 else 150)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {tuple(r) for r in jaccard.near_duplicates(docs, jaccard.Rule(3, 90)).collect()}
    assert found == brute(rows, 3, 90)


def test_compare_counts_unsigned_bits():
    """The top bit of a word set on one side only."""
    np = jaccard.np
    grams = np.arange(1, 58, dtype=np.uint64) + np.uint64(1 << 40)
    one, other = np.append(grams, np.uint64(63)), np.append(grams, np.uint64(64))
    maps = [jaccard.bitmap(np.unique(g)).tolist() for g in (one, other)]
    held = jaccard.pa.table(
        {"token": [1, 1], "i": [0, 0], "j": [0, 0], "node": [1, 2], "n": [58, 58], "place": [0, 0], "component": [1, 2], "bitmap": maps, "outsider": [True, False]}
    )
    assert jaccard._compare(held.to_batches(), jaccard.Rule(3, 90), False) == [(1, 2)]


def test_corner_rows(corners, clashing, nothing):
    rows = jaccard.near_duplicates(corners, jaccard.Rule(5, 80)).collect()
    groups = {r.doc_id: r.component_id for r in rows}
    assert len(rows) == corners.count()
    assert groups[1] == groups[2] == groups[3] == 1 and groups[4] == 4
    assert groups[8] == groups[9] == 8
    assert groups[5] == 5 and groups[6] == 6 and groups[None] is None
    assert sorted(map(repr, jaccard.near_duplicates(clashing).collect())) == sorted(map(repr, rows))
    assert jaccard.near_duplicates(nothing).count() == 0


def test_bitmaps_never_reject_a_link():
    chance = random.Random(1)
    grams = jaccard.np.array([chance.getrandbits(64) for _ in range(600)], jaccard.np.uint64)
    for k in range(0, 600, 50):
        a, b = jaccard.bitmap(grams[: 600 - k]), jaccard.bitmap(grams)
        if len(a) == len(b):
            assert sum(bin(x & (2**64 - 1)).count("1") for x in (a ^ b).tolist()) <= k


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (None, 3), (201, 200)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 1 for i in range(1, 41)} | {100 + k: 100 for k in range(30)} | {200: 200, 201: 200}
    empty = spark.createDataFrame([], "a long, b long")
    assert components(empty).count() == 0


def test_a_shared_prefix_is_posted_once(spark):
    rows = [(k, 20, 10 + k, 0, 7, [1, 2], [0]) for k in range(3)] + [(9, 20, 20, 0, 8, [2, 3], [0])]
    # Too small to be near one of 20 shingles at 80 %, and one that is near in the next class of sizes.
    rows += [(11, 10, 30, 0, 5, [1, 2], [0]), (12, 24, 31, 0, 6, [3, 4], [0])]
    described = spark.createDataFrame(rows, jaccard.SETS)
    found = jaccard.entries(described, jaccard.classes_of(described)).collect()
    buckets = {}
    for r in found:
        buckets.setdefault(r.token, set()).add(r.node)
    # Shingle 2 is shared with another group, 3 with a larger one; the classes of one prefix meet under its key.
    assert set(map(frozenset, buckets.values())) == {frozenset({0, 1, 2, 9}), frozenset({9, 12}), frozenset({0, 1, 2})}
    assert buckets[7] == {0, 1, 2}


def test_sizes_that_allow_a_link_share_a_key(spark):
    """Every pair of sizes at the edge of the rule, for several rules."""
    for percent in (50, 80, 90, 99, 100):
        rule = jaccard.Rule(3, percent)
        sizes = sorted({m for n in range(1, 400, 7) for m in (n, n + 1, -(-n * percent // 100), n * 100 // percent)})
        rows = [(k, n, k, 0, k, [1], [0]) for k, n in enumerate(sizes) if n]
        described = spark.createDataFrame(rows, jaccard.SETS)
        met = {}
        for r in jaccard.entries(described, jaccard.classes_of(described), rule).collect():
            met.setdefault(r.token, set()).add(r.node)
        together = {(a, b) for nodes in met.values() for a in nodes for b in nodes if a < b}
        want = {(i, j) for i, n, *_ in rows for j, m, *_ in rows if i < j and 100 * min(n, m) >= percent * max(n, m)}
        assert want <= together, percent


def test_shuffle_files_of_a_step_go_with_it(spark, corners, monkeypatch):
    """They are deleted as each step is at rest, and sessions get their own setting back."""
    name, seen, real = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", [], jaccard.Scratch.staged

    def staged(self, df, label):
        seen.append((label, spark.conf.get(name)))
        return real(self, df, label)

    monkeypatch.setattr(jaccard.Scratch, "staged", staged)
    before = spark.conf.get(name)
    assert jaccard.near_duplicates(corners).count() == corners.count()
    assert {"sets", "met", "entries", "links"} <= {label for label, _ in seen} and {on for _, on in seen} == {"true"}
    assert spark.conf.get(name) == before


def test_few_tables_lie_beside_the_shuffle_files_of_a_step(spark, corners, monkeypatch):
    """Postings go part by part, prefixes with the groups, and groups before their classes are spread out."""
    seen, real = [], jaccard.Scratch.staged

    def staged(self, df, label):
        there = {name for name, path in made if os.path.exists(path.removeprefix("file:"))}
        found = real(self, df, label)
        made.append((label, self.paths[-1]))
        seen.append((label, there, df.columns))
        return found

    made = []
    monkeypatch.setattr(jaccard.Scratch, "staged", staged)
    assert jaccard.near_duplicates(corners).count() == corners.count()
    assert [label for label, *_ in seen].count("met") == jaccard.POSTING_PARTS
    there = {label: names for label, names, _ in reversed(seen)}
    assert "described" not in there["met"] and not {"described", "groups"} & there["entries"]
    assert "met" not in there["pairs"]
    assert "prefix" not in next(columns for label, _, columns in seen if label == "sets")


@pytest.mark.parametrize("full", [False, True])
def test_rows_are_left_out_with_few_texts_shuffled(spark, monkeypatch, full):
    rows = [(k % 40 if k % 7 else None, f"text {k}") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    away = spark.createDataFrame([(k,) for k in (0, 3, 39, 1000)], "doc_id long")
    if full:  # a filter that tells nothing
        monkeypatch.setattr(jaccard, "_marked", lambda nodes: np.full(1 << (jaccard.FILTER_BITS - 6), -1))
    left = jaccard.without(docs, away)
    assert left.columns == docs.columns
    want = [r for r in rows if r[0] not in (0, 3, 39)]
    assert sorted(left.collect(), key=repr) == sorted((spark.createDataFrame(want, docs.schema)).collect(), key=repr)
    if not full:
        hashed = F.xxhash64(F.col("doc_id").cast("long"))
        asked = jaccard._is_marked(jaccard._marked(away.withColumnRenamed("doc_id", "node")), np.array([r[0] for r in docs.select(hashed).collect()]))
        assert asked.sum() == len(rows) - len(want)
