"""Spelling variants: pairs of vocabulary words one edit apart, and each word's form and root.

The acceptor of the vocabulary is composed with a transducer that makes exactly one edit, and with the
acceptor again; the composed machine accepts the pairs (word, near word).

1. Words are counted over whole texts, in the tasks first. What is left after the cut by length and count is
   the vocabulary, one row per word.
2. The composed machine is taken apart at its initial state. Before the edit both acceptors are in one
   state, the one a common prefix leads to. From there either both read the same symbol, which is the
   initial state of a smaller part, or the edit is made, and what follows must be equal: words that share the
   prefix and what comes after the edit meet in a small group, at most one word per symbol of the alphabet
   and one without. Parts are taken apart until they hold few words, so a prefix that a third of
   the vocabulary begins with costs some more rounds, not one large task.
3. For each remaining part a task builds the minimised acceptor of its words (incrementally from the sorted
   words), composes it lazily and enumerates the accepted pairs. Edits are looked up once per state of the
   acceptor, not once per prefix. A pair is accepted at the first place where its words differ, so once.
4. Pairs are reduced in the tasks to the number of near words and the best one of each word.

Null and empty texts have no words; rows without doc_id are counted like others, but ``edit`` does not change them.
Texts and words may be of any length. Ties: the first word in the order of code points. Repeated rows are counted
each time. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlake.llm.common import map_arrow, slices, staged

# Distinct words a task holds while it counts.
WORDS_HELD = 300_000
# The machine is taken apart at the first symbols at least, and further where a part has more words.
DEPTH = 2
PART_WORDS = 20_000
# A form must be so many times as frequent as its variant.
RATIO = 10

_RUN = "[A-Za-zÀ-ÿ]"
_LOWER = {upper: upper + 32 for upper in range(65, 91)}
NEAR = "word string, n_near long, best struct<neg:long,word:string>"

Edit = Callable[[int | None, str], str]


def count_words(docs: DataFrame, least: int, edit: Edit | None = None) -> DataFrame:
    """word, n: runs of at least ``least`` letters, A-Z lower-cased, after ``edit`` of each (doc_id, word)."""
    pattern = re.compile(f"{_RUN}{{{least},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                if edit is None:
                    held.update(word.translate(_LOWER) for word in pattern.findall(text))
                else:
                    own: Counter[str] = Counter()
                    for word, n in Counter(pattern.findall(text)).items():
                        own[word.lower() if word.isascii() else word.translate(_LOWER)] += n
                    for word, n in own.items():
                        changed = edit(doc_id, word)
                        if len(changed) >= least:
                            held[changed] += n
                if len(held) >= WORDS_HELD:
                    yield _counted(held)
                    held.clear()
        yield _counted(held)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = map_arrow(rows, run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(held: Counter[str]) -> pa.RecordBatch:
    columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n"])


class Acceptor:
    """The minimal acyclic acceptor of sorted distinct words, built word by word; state 0 is initial."""

    def __init__(self, words: list[str]):
        self.moves: list[dict[str, int]] = [{}]
        self.final = [False]
        known: dict[tuple, int] = {}
        path, before = [0], ""
        for word in words:
            shared = 0
            for x, y in zip(word, before, strict=False):
                if x != y:
                    break
                shared += 1
            self._settle(path, before, shared, known)
            for symbol in word[shared:]:
                self.moves.append({})
                self.final.append(False)
                self.moves[path[-1]][symbol] = len(self.final) - 1
                path.append(len(self.final) - 1)
            self.final[path[-1]] = True
            before = word
        self._settle(path, before, 0, known)

    def _settle(self, path: list[int], word: str, shared: int, known: dict[tuple, int]) -> None:
        """States beyond the shared prefix change no more: equal ones become one."""
        for i in range(len(word), shared, -1):
            state = path.pop()
            like = known.setdefault((self.final[state], tuple(self.moves[state].items())), state)
            if like != state:
                self.moves[path[-1]][word[i - 1]] = like

    def shared(self, p: int, q: int, but: str | None = None) -> list[str]:
        """The words that both states accept, those beginning with ``but`` left out: the copying part."""
        out, path = [], []
        todo: list[tuple[int, int, int, str]] = [(p, q, 0, "")]
        while todo:
            p, q, depth, symbol = todo.pop()
            if depth:
                del path[depth - 1 :]
                path.append(symbol)
            if self.final[p] and self.final[q]:
                out.append("".join(path))
            other = self.moves[q]
            for c, target in self.moves[p].items():
                to = other.get(c)
                if to is not None and (depth or c != but):
                    todo.append((target, to, depth + 1, c))
        return out

    def edits(self, state: int) -> list[tuple[str, str]]:
        """Pairs of words after a state whose first symbols are the edit: one replaced, or one put in."""
        moves = list(self.moves[state].items())
        pairs = []
        for i, (a, p) in enumerate(moves):
            for b, q in moves[i + 1 :]:
                pairs += [(a + rest, b + rest) for rest in self.shared(p, q)]
            # Without it the word goes on with another symbol, else the edit would lie further on.
            pairs += [(rest, a + rest) for rest in self.shared(state, p, but=a)]
        return pairs

    def near_pairs(self) -> Iterator[tuple[str, str]]:
        """All pairs of accepted words that differ by one inserted, deleted or replaced symbol, once each."""
        known: dict[int, list[tuple[str, str]]] = {}
        path: list[str] = []
        todo: list[tuple[int, int, str]] = [(0, 0, "")]
        while todo:
            state, depth, symbol = todo.pop()
            if depth:
                del path[depth - 1 :]
                path.append(symbol)
            found = known.get(state)
            if found is None:
                found = known[state] = self.edits(state)
            if found:
                prefix = "".join(path)
                for u, v in found:
                    yield prefix + u, prefix + v
            todo += [(to, depth + 1, c) for c, to in self.moves[state].items()]


def _reduced(words: list[str], counts: list[int]) -> Iterator[tuple[str, int, int, str]]:
    """word, number of near words in this part, the best one's negative count and itself."""
    n = dict(zip(words, counts, strict=True))
    near: dict[str, int] = {}
    best: dict[str, tuple[int, str]] = {}
    for pair in Acceptor(words).near_pairs():
        for word, other in (pair, pair[::-1]):
            near[word] = near.get(word, 0) + 1
            found = (-n[other], other)
            if word not in best or found < best[word]:
                best[word] = found
    for word, k in near.items():
        yield word, k, *best[word]


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (part, skip, word, n) rows, part by part; ``skip`` symbols are common to a part."""

    def batch(rows: list[tuple[str, int, int, str]]) -> pa.RecordBatch:
        word, near, neg, other = zip(*rows, strict=True)
        best = pa.StructArray.from_arrays([pa.array(neg, pa.int64()), pa.array(other, pa.string())], names=["neg", "word"])
        return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.int64()), best], names=["word", "n_near", "best"])

    def results(part: str, words: list[str], counts: list[int]) -> Iterator[pa.RecordBatch]:
        rows = [(part + w, k, neg, part + o) for w, k, neg, o in _reduced(words, counts)] if len(words) > 1 else []
        for i in range(0, len(rows), 10_000):
            yield batch(rows[i : i + 10_000])

    part, words, counts = "", [], []
    for found in batches:
        columns = (found.column(c).to_pylist() for c in ("part", "word", "n"))
        for own, word, n in zip(*columns, strict=True):
            if own != part:
                yield from results(part, words, counts)
                part, words, counts = own, [], []
            words.append(word[len(own) :])
            counts.append(n)
    yield from results(part, words, counts)


def _edited_here(left: DataFrame, depth: int) -> DataFrame:
    """Near words whose first difference is symbol ``depth``, of words that share the symbols before.

    A group has a word for each symbol at that place and at most one without a symbol there, so its size is
    bounded by the alphabet. The word without is no partner of one whose symbol it goes on with: those
    differ further on.
    """
    at = lambda k: F.substring("word", k + 1, 1)
    rest = lambda k: F.expr(f"substring(word, {k + 1})")
    own = F.struct(F.col("n"), F.col("word"), F.when(F.length("word") > depth, at(depth)).alias("symbol"))
    without = F.struct(F.col("n"), F.col("word"), F.lit(None).cast("string").alias("symbol"))
    key = lambda k: F.struct(F.substring("word", 1, depth).alias("before"), rest(k).alias("after"))
    places = F.array(
        F.when(F.length("word") > depth, F.struct(key(depth + 1).alias("key"), own.alias("member"))),
        F.struct(key(depth).alias("key"), without.alias("member")),
    )
    rows = left.select(F.explode(F.filter(places, lambda p: p.isNotNull())).alias("p")).select("p.*")
    groups = rows.groupBy("key").agg(F.collect_list("member").alias("members")).where(F.size("members") > 1)
    first = F.substring("key.after", 1, 1)

    def partners(m):
        goes_on = lambda x, y: x["symbol"].isNull() & (y["symbol"] == first)
        apart = lambda o: ~o["symbol"].eqNullSafe(m["symbol"]) & ~F.coalesce(goes_on(m, o) | goes_on(o, m), F.lit(False))
        others = F.filter("members", apart)
        best = F.array_min(F.transform(others, lambda o: F.struct((-o["n"]).alias("neg"), o["word"].alias("word"))))
        return F.struct(m["word"].alias("word"), F.size(others).cast("long").alias("n_near"), best.alias("best"))

    return groups.select(F.explode(F.transform("members", partners)).alias("m")).select("m.*").where("n_near > 0")


def near_words(vocabulary: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """word, n_near, best (neg: its negative count, word) of every word with near words."""
    left, found, parts = vocabulary, [], []
    for depth in count():
        found.append(_edited_here(left, depth))
        # What begins with the same symbol too is the initial state of a smaller machine.
        part = F.substring("word", 1, depth + 1)
        onward = left.where(F.length("word") > depth).withColumn("part", part)
        if depth + 1 < DEPTH:
            left = onward.drop("part")
            continue
        large = staged(onward.groupBy("part").count().where(F.col("count") > part_words).select("part"), "large-parts")
        if large.isEmpty():
            parts.append(onward)
            break
        parts.append(onward.join(large, "part", "left_anti").select("word", "n", "part"))
        left = staged(onward.join(large, "part", "left_semi").select("word", "n"), "large")
    rows = parts[0].select("part", "word", "n")
    for more in parts[1:]:
        rows = rows.unionByName(more.select("part", "word", "n"))
    rows = rows.repartition("part").sortWithinPartitions("part", "word")
    every = map_arrow(rows, _compose, NEAR)
    for more in found:
        every = every.unionByName(more)
    return every.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of rows (word, form): the end of each chain, found by doubling steps.

    Forms are more frequent than their words, so chains end; each round halves what is left of them.
    """
    reached = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = reached.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = staged(step, "roots")
        reached = step.select("word", "root")
        if step.where("moved").isEmpty():
            return reached


def variants(
    docs: DataFrame, least: int = 7, occurrences: int = 2, ratio: int = RATIO, edit: Edit | None = None, part_words: int = PART_WORDS
) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of at least ``least`` letters and ``occurrences``.

    The form is the most frequent near word, if it is at least ``ratio`` (2 or more) times as frequent.
    """
    if ratio < 2:
        raise ValueError("a form is at least twice as frequent as its variant")
    vocabulary = staged(count_words(docs, least, edit).where(F.col("n") >= occurrences), "vocabulary")
    near = vocabulary.join(near_words(vocabulary, part_words), "word", "left")
    formed = (-F.col("best.neg")) >= ratio * F.col("n")
    with_forms = staged(
        near.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("best.word")).alias("form"),
            F.when(formed, -F.col("best.neg")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(with_forms.where("form IS NOT NULL").select("word", "form"))
    return with_forms.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
