import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from depotlake.llm import queries, runs
from tests.llm.conftest import prose


def brute(words, min_words=6, min_periods=4):
    """Every period tried at every place; a stretch counts under its smallest period only."""
    n, found, seen = len(words), [], set()
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_words, min_periods * q) and (i, j + q) not in seen:
                found.append((i, j + q, q))
            if j > i:
                seen.add((i, j + q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    away = {i for a, b, q in found for i in range(a + q, b)}
    return [w for i, w in enumerate(words) if i not in away]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), st.integers(2, 5), st.integers(3, 7))
def test_runs_of_few_words_equal_brute_force(words, times, least):
    found = [tuple(r) for r in runs.word_runs(words, least, times).tolist()]
    assert found == brute(words, least, times)
    assert runs.collapse(words, runs.word_runs(words, least, times)) == collapsed(words, found)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 4), min_size=1, max_size=5), st.integers(1, 7), st.integers(0, 4)), max_size=8))
def test_repeated_blocks_equal_brute_force(blocks):
    words = [b"w%d" % x for block, times, extra in blocks for x in block * times + [9] * extra]
    assert [tuple(r) for r in runs.word_runs(words).tolist()] == brute(words)


def test_extensions_and_orders_of_a_tree():
    chance = random.Random(3)
    text = [chance.randrange(3) for _ in range(120)]
    tree = runs.SuffixTree([*text, 3])
    suffixes = [tuple(x + 1 for x in text[i:]) + (0,) for i in range(121)]
    rank, lows = tree.tour()
    assert [int(rank[i]) for i in range(121)] == [sorted(suffixes).index(s) for s in suffixes]
    other = [tuple(-x if x else -9 for x in s) for s in suffixes]
    assert tree.tour(opposite=True)[0].tolist() == [sorted(other).index(s) for s in other]
    extend = runs.Extension(rank, lows)
    for i in range(0, 121, 7):
        for j in range(i + 1, 121):
            k = 0
            while max(i, j) + k < 120 and text[i + k] == text[j + k]:
                k += 1
            assert extend(runs.np.array([i]), runs.np.array([j]))[0] == k


def test_long_texts_of_one_word_and_of_one_block():
    for words in ([b"x"] * 30_000, [b"w%d" % (i % 700) for i in range(30_000)]):
        (found,) = runs.word_runs(words).tolist()
        assert found == [0, 30_000, len(set(words))]
        assert runs.collapse(words, runs.np.array([found])) == words[: len(set(words))]


def digest(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    best = min(found, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    lines = "".join(f"{a},{b - a},{q}\n" for a, b, q in found)
    first = (None,) * 4 if best is None else (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
    return (doc_id, len(found), *first, sha(lines.encode()), sha(b" ".join(collapsed(words, found))))


def test_query_equals_brute_force(spark, corners, clashing, nothing, tmp_path, corner_rows):
    chance = random.Random(8)
    rows = [(100 + i, prose(chance.randrange(1, 90), i), "en", "s", 1) for i in range(120)]
    rows += [(300 + i, " ".join(["a b c", "a", "b a"][i % 3].split() * (i + 2)) + " end", "en", "s", 1) for i in range(12)]
    rows += [(400, "same line here\n" * 50 + "x\x0by\x0cz w", None, None, None), *(r for r in corner_rows if r[0] != 10)]
    spark.createDataFrame(rows, corners.schema).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op12_periodic_runs(spark, str(tmp_path))
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert found.columns == names
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(repr(digest(r[0], r[1])) for r in rows)
    # All columns are carried, whatever their names; without an edit no doc_id is needed.
    assert runs.scan(clashing).select("row.*").columns == clashing.columns
    assert runs.scan(corners.select("text")).count() == len(corner_rows)
    assert runs.scan(nothing).count() == 0
    with pytest.raises(ValueError, match="two periods"):
        runs.scan(corners, min_periods=1)
