import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from depotlake.llm import queries, spelling


def apart_by_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abcé", max_size=6), max_size=40))
def test_accepted_pairs_are_those_one_edit_apart(words):
    listed = sorted(words)
    machine = spelling.Acceptor(listed)
    found = [tuple(sorted(p)) for p in machine.near_pairs()]
    want = [(a, b) for i, a in enumerate(listed) for b in listed[i + 1 :] if apart_by_one(a, b)]
    assert sorted(found) == want
    # Minimal: no two reachable states accept the same words.
    reached, todo = {0}, [0]
    while todo:
        for to in machine.moves[todo.pop()].values():
            if to not in reached:
                reached.add(to)
                todo.append(to)
    assert len({tuple(sorted(machine.shared(s, s))) for s in reached}) == len(reached)


def brute(counts, ratio=10):
    words = sorted(counts)
    near = {w: [v for v in words if apart_by_one(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in words}


@pytest.mark.parametrize("part_words", [20_000, 5])
def test_near_words_equal_brute_force(spark, part_words):
    """Few symbols, so every part is crowded; with five words a part is taken apart to its ends."""
    chance = random.Random(part_words)
    words = {"".join(chance.choice("abé") for _ in range(chance.randrange(1, 8))) for _ in range(150 if part_words > 5 else 60)}
    counts = {w: chance.choice([2, 3, 30, 300, 3000]) for w in words}
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r.word: (r.n_near, r.best.word) for r in spelling.near_words(vocabulary, part_words).collect()}
    near = {w: [v for v in words if apart_by_one(w, v)] for w in words}
    assert found == {w: (len(vs), min(vs, key=lambda v: (-counts[v], v))) for w, vs in near.items() if vs}


def test_chains_end_at_their_roots(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("x", "w30"), ("y", "z")]
    found = {r.word: r.root for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert found == {f"w{i}": "w37" for i in range(37)} | {"x": "w37", "y": "z"}


def vocabulary(rows):
    counts = Counter()
    for doc_id, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), word)
            h = 1 if doc_id is None else zlib.crc32(f"{doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 7:
                counts[word] += 1
    return {w: n for w, n in counts.items() if n > 1}


def test_query_equals_brute_force(spark, corners, corner_rows, clashing, nothing, tmp_path):
    chance = random.Random(4)
    stems = ["syllable", "Straße", "señales", "éclairage", "mountain", "mountains", "fountain", "ÀLPHABET", "alphabet", "window"]
    rows = []
    for i in range(150):
        words = [chance.choice(stems) + chance.choice(["", "", "s", "ing"]) for _ in range(40)]
        words[3] = words[3][:4] + chance.choice("xyz") + words[3][5:]
        rows.append((i, " ".join(words) + "," + words[0].upper() + "×÷ tail_word9word"))
    long = "a" * 5_000 + "b" * 5_000
    rows += [(900, f"{long} {long}"), (901, f"{long[:-1]} {long} {long[1:]} {long[1:]}"), (902, None), (903, ""), (None, "mountain " * 30)]
    rows += [rows[0], rows[0], *((r[0], r[1]) for r in corner_rows)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op13_spelling_variants(spark, str(tmp_path))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(vocabulary(rows))
    assert {tuple(r) for r in found.collect()} == want and any(r[1] for r in want)
    assert sorted(map(repr, spelling.variants(clashing).collect())) == sorted(map(repr, spelling.variants(corners).collect()))
    assert spelling.variants(nothing).count() == 0
    with pytest.raises(ValueError, match="twice as frequent"):
        spelling.variants(nothing, ratio=1)
