"""Quality rules whose strictness is chosen by a risk bound on labelled documents.

Each document gets counts and ratios. A ladder of levels, from lax to strict, has one cutoff per rule
and level; ``level`` is the first at which any rule rejects the document. On the labelled documents of
each stratum (the language), the number of good ones rejected up to a level is tested against the
allowed share by the exact binomial tail. Levels are tested from lax to strict and the first that fails
ends the climb, which needs no correction within a stratum; across strata the error is divided by
their number (Bonferroni). With the given confidence, in no stratum are more than ``max_rejected`` of
the good documents rejected. A stratum with too few labels certifies nothing and rejects nothing.

Everything is built-in column functions. Texts are scanned whole, null counts as empty. Documents without words have zero counts
and fail the base rule. A null language is a stratum of its own; labels without a document or with a
null quality count for nothing; a document counts once, with the level that rejects it first, however
often it is labelled or repeated, and as good only if none of its labels denies it. Repeated rows are
judged row by row. Empty labels reject nothing beyond the base rule. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotlake.llm.common import staged

WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20

# Shares at which a rule rejects, from the lax to the strict level. ``above`` rejects larger values.
LADDER: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbol_share": ("above", (0.50, 0.40, 0.30, 0.25, 0.20, 0.15, 0.12, 0.10, 0.08, 0.06, 0.05, 0.04)),
    "upper_share": ("above", (0.90, 0.80, 0.70, 0.65, 0.60, 0.55, 0.50, 0.45, 0.40, 0.35, 0.30, 0.25)),
    "repeat_share": ("above", (0.50, 0.40, 0.30, 0.20, 0.18, 0.16, 0.14, 0.12, 0.10, 0.08, 0.06, 0.05)),
    "dup_line_share": ("above", (0.90, 0.80, 0.70, 0.60, 0.50, 0.45, 0.40, 0.35, 0.30, 0.25, 0.20, 0.15)),
    "distinct_share": ("below", (0.002, 0.005, 0.01, 0.02, 0.03, 0.05, 0.07, 0.10, 0.15, 0.20, 0.25, 0.30)),
    "mean_word": ("above", (60.0, 50.0, 40.0, 35.0, 30.0, 25.0, 22.0, 20.0, 18.0, 16.0, 15.0, 14.0)),
}
LEVELS = 12
MAX_REJECTED = 0.05
CONFIDENCE = 0.95

_SPACES = "\t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute ``value`` once and use it in ``body`` more than once."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur twice or more in the same text.

    Windows are hashed and sorted with their places; equal neighbours are repeats. The repeated
    windows, in the order of their places, cover ``min(window, distance to the next)`` words each.
    """
    last = F.size(words) - window

    def hashed(i: Column) -> Column:
        return F.xxhash64(*(F.get(words, i + k) for k in range(window)))

    def covered(keys: Column) -> Column:
        placed = F.sort_array(F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeats(order: Column) -> Column:
            return F.filter(
                order,
                lambda e, k: (F.get(order, k - 1)["h"] == e["h"]) | (F.get(order, k + 1)["h"] == e["h"]),
            )

        def total(places: Column) -> Column:
            gaps = F.transform(
                places,
                lambda p, k: F.least(F.lit(window), F.coalesce(F.get(places, k + 1) - p, F.lit(window))),
            )
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

        found = let(placed, repeats)
        return let(F.sort_array(F.transform(found, lambda e: e["i"])), total)

    def count(keys: Column) -> Column:
        return F.when(F.size(F.array_distinct(keys)) < F.size(keys), covered(keys)).otherwise(F.lit(0).cast("long"))

    windows = F.transform(F.sequence(F.lit(0), last), hashed)
    return F.when(last >= 1, let(windows, count)).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, stratum and the counts and shares of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum"), text.alias("text"))
    spaced = F.translate("text", _SPACES, " " * len(_SPACES))
    split = plain.select("doc_id", "stratum", "text", F.array_remove(F.split(spaced, " "), "").alias("words"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.trim(F.translate(x, _SPACES, " " * len(_SPACES))) != "")
    symbols = F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))
    counted = split.select(
        "doc_id",
        "stratum",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", " " + _SPACES, "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).alias("lines"), F.size(F.array_distinct(x)).alias("distinct"))).alias("l"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
        F.size(F.array_distinct("words")).alias("distinct_words"),
        F.regexp_count("text", F.lit("[A-Z]")).alias("upper"),
    )
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return counted.select(
        "doc_id",
        "stratum",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.col("l.lines") - F.col("l.distinct")).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        (F.col("n_symbols") / chars).alias("symbol_share"),
        (F.col("upper") / chars).alias("upper_share"),
        (F.col("n_repeat_words") / words).alias("repeat_share"),
        ((F.col("l.lines") - F.col("l.distinct")) / F.greatest("l.lines", F.lit(1))).alias("dup_line_share"),
        (F.when(F.col("n_words") > 0, F.col("distinct_words") / words).otherwise(1.0)).alias("distinct_share"),
        (F.col("word_chars") / words).alias("mean_word"),
    )


def base_failed() -> Column:
    repeated = 100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    return (F.col("n_words") < MIN_WORDS) | repeated


def level(ladder: dict = LADDER) -> Column:
    """The first level at which a rule rejects; one more than the last if none does."""
    out = F.when(F.lit(False), F.lit(0))
    for i in range(LEVELS):
        at = F.lit(False)
        for rule, (side, cutoffs) in ladder.items():
            at = at | (F.col(rule) > cutoffs[i] if side == "above" else F.col(rule) < cutoffs[i])
        out = out.when(at, F.lit(i + 1))
    return out.otherwise(F.lit(LEVELS + 1))


def binomial_tail(n: Column, k: Column, share: float) -> Column:
    """P(X <= k) of X binomial in n draws with the given share, summed exactly in logarithms."""
    odds = math.log(share / (1 - share))
    first = F.struct((n * F.lit(math.log1p(-share))).alias("log_term"), F.lit(0.0).alias("total"))

    def add(state: Column, i: Column) -> Column:
        grown = state["log_term"] + F.log((n - i).cast("double") / (i + 1)) + odds
        # The last factor is zero past n draws; its logarithm is never used again.
        return F.struct(F.coalesce(grown, F.lit(-1e308)).alias("log_term"), (state["total"] + F.exp(state["log_term"])).alias("total"))

    return F.aggregate(F.sequence(F.lit(0).cast("long"), k), first, add, lambda s: s["total"])


def certify(
    labelled: DataFrame, max_rejected: float = MAX_REJECTED, confidence: float = CONFIDENCE
) -> DataFrame:
    """stratum, level: the strictest certified level, from (stratum, level, good) rows.

    Labelled rows are reduced to a count per stratum and level before anything else.
    """
    counts = labelled.groupBy("stratum", "level").agg(F.sum(F.col("good").cast("long")).alias("n"))
    good = counts.groupBy("stratum").agg(
        F.sum("n").alias("good"),
        F.collect_list(F.struct("level", "n")).alias("at"),
    )
    rejected = F.transform(
        F.sequence(F.lit(1), F.lit(LEVELS)),
        lambda x: F.aggregate(F.filter("at", lambda e: e["level"] <= x), F.lit(0).cast("long"), lambda a, e: a + e["n"]),
    )
    # One row per stratum, so this window is as small as the list of languages.
    strata = F.count("stratum").over(Window.partitionBy(F.lit(0)))
    counted = good.select("stratum", "good", rejected.alias("rejected"), strata.alias("strata"))
    tests = counted.select("stratum", "good", "strata", F.posexplode("rejected").alias("i", "rejected"))
    passed = tests.select(
        "stratum",
        (F.col("i") + 1).alias("level"),
        (binomial_tail(F.col("good"), F.col("rejected"), max_rejected) <= (1 - confidence) / F.col("strata")).alias("passed"),
    )
    # All levels below the first that fails.
    return passed.groupBy("stratum").agg(
        (F.coalesce(F.min(F.when(~F.col("passed"), F.col("level"))), F.lit(LEVELS + 1)) - 1).alias("certified")
    )


def judge(
    measured: DataFrame, labels: DataFrame, max_rejected: float = MAX_REJECTED, confidence: float = CONFIDENCE
) -> DataFrame:
    """The measured documents with level, certified, base_failed and kept.

    The base rule rejects by definition and is not part of the risk: what it rejects is left out
    of the count, so the bound holds for the good documents that pass it.
    """
    # At rest first: rules and labels both read the counts, which are the costly part.
    ranked = staged(measured, "quality").withColumn("base_failed", base_failed()).withColumn("level", level())
    # The tail needs independent draws: a document counts once, however often it is labelled or repeated.
    held = labels.groupBy("doc_id").agg((F.min(F.col("quality").cast("double")) == 1).alias("good")).where("good")
    labelled = ranked.where(~F.col("base_failed")).join(held, "doc_id")
    strictest = F.min(F.struct("level", "stratum")).alias("drawn")
    drawn = labelled.groupBy("doc_id").agg(strictest).select("drawn.*", F.lit(True).alias("good"))
    certified = certify(drawn, max_rejected, confidence)
    return (
        ranked.join(certified, "stratum", "left")
        .withColumn("certified", F.coalesce("certified", F.lit(0)))
        .withColumn("kept", ~F.col("base_failed") & (F.col("level") > F.col("certified")))
    )
