import math
import re
from collections import Counter

from pyspark.sql import functions as F

from depotlake.llm import quality
from tests.llm.conftest import prose


def brute(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if times[g] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(spark, corners, corner_rows):
    loops = "a b c d e " * 3 + "x " + "a b c d e f"
    extra = [
        (20, loops, "en", None, None),
        (21, "l1\nl1\n\n \nl2\r\nl2\nl1", "en", None, None),
        (22, "#*$ %& |<> " * 9, "en", None, None),
        (23, "w " * 5, None, None, None),
        (24, "w " * 6, None, None, None),
        (25, "a\x0bb\x0cc\x1cd e", None, None, None),
    ]
    docs = corners.union(spark.createDataFrame(extra, corners.schema))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = sorted(((r.doc_id, *(r[n] for n in names)) for r in quality.measure(docs).collect()), key=repr)
    assert found == sorted(((r[0], *brute(r[1])) for r in [*corner_rows, *extra]), key=repr)


def test_binomial_tail_is_exact(spark):
    rows = [(n, k) for n in (1, 7, 90, 400, 20_000) for k in (0, 1, 5, 30, 1000) if k <= n]
    found = spark.createDataFrame(rows, "n long, k long").select("n", "k", quality.binomial_tail(F.col("n"), F.col("k"), 0.05).alias("p"))
    for r in found.collect():
        terms = [
            math.exp(math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1) + i * math.log(0.05) + (r.n - i) * math.log(0.95))
            for i in range(r.k + 1)
        ]
        assert abs(r.p - math.fsum(terms)) < 1e-9


def test_climb_ends_before_the_first_level_that_fails(spark):
    # 300 good documents: 2 fall at level 3, 20 more at level 6; 20 labels certify nothing.
    rows = [("en", 13, True)] * 278 + [("en", 3, True)] * 2 + [("en", 6, True)] * 20 + [("fr", 13, True)] * 20
    labelled = spark.createDataFrame(rows, "stratum string, level int, good boolean")
    assert {r.stratum: r.certified for r in quality.certify(labelled).collect()} == {"en": 5, "fr": 0}


def test_more_strata_need_more_evidence(spark):
    one = [("s0", 13, True)] * 65
    certified = lambda rows: {r[0]: r[1] for r in quality.certify(spark.createDataFrame(rows, "stratum string, level int, good boolean")).collect()}
    assert certified(one)["s0"] == quality.LEVELS
    many = one + [(f"s{k}", 13, True) for k in range(1, 60)]
    assert certified(many)["s0"] == 0


def test_junk_goes_and_good_documents_stay(spark):
    good = [(i, prose(60, i), "en") for i in range(300)]
    junk = [(1000 + i, " ".join(w + "###" for w in prose(60, i).split()), "en") for i in range(20)]
    docs = spark.createDataFrame(good + junk, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i, *_ in good] + [(i, 0) for i, *_ in junk] + [(9, None), (None, 1)], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in quality.judge(quality.measure(docs), labels).collect()}
    assert not any(kept[i] for i, *_ in junk)
    assert sum(not kept[i] for i, *_ in good) <= quality.MAX_REJECTED * len(good)


def test_corner_rows(spark, corners, clashing, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (99, 1)], "doc_id long, quality int")
    rows = quality.judge(quality.measure(corners), labels).collect()
    assert len(rows) == corners.count()
    failed = {r.doc_id: r.base_failed for r in rows}
    assert failed[5] and failed[6] and failed[8] and not failed[10]
    assert sorted(map(repr, quality.judge(quality.measure(clashing), labels).collect())) == sorted(map(repr, rows))
    assert quality.judge(quality.measure(nothing), labels).count() == 0
    none = labels.where("false")
    assert all(r.kept != r.base_failed for r in quality.judge(quality.measure(corners), none).collect())


def test_repeating_labels_changes_nothing(spark):
    docs = spark.createDataFrame([(i, prose(60, i), "en") for i in range(40)], "doc_id long, text string, lang string")
    once = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")
    certified = lambda docs, labels: {r.certified for r in quality.judge(quality.measure(docs), labels).collect()}
    assert certified(docs, once) == certified(docs, once.union(once).union(once)) == certified(docs.union(docs), once) == {0}
    # A document with both labels is not good and counts for nothing.
    many = docs.union(spark.createDataFrame([(i, prose(60, i), "en") for i in range(40, 70)], docs.schema))
    good = spark.createDataFrame([(i, 1) for i in range(70)], "doc_id long, quality int")
    denied = spark.createDataFrame([(i, 0) for i in range(30)] + [(5, None)], "doc_id long, quality int")
    assert certified(many, good) == {quality.LEVELS} and certified(many, good.union(denied)) == {0}


def test_kept_equals_brute_force(spark):
    """Whole: levels from the counts, exact tails on one label per document, and the climb."""
    chance = __import__("random").Random(5)
    texts = []
    for i in range(260):
        words = prose(60, i).split()
        share = chance.random() * 0.5
        texts.append((i, " ".join(w + "#%" if chance.random() < share and i % 3 == 0 else w for w in words), ("en", "fr", None)[i % 7 % 3]))
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    labels = [(i, int(chance.random() < 0.8)) for i in range(260) for _ in range(1 + i % 2)]
    found = {r.doc_id: r for r in quality.judge(quality.measure(docs), spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    good = {i for i, _ in labels if all(q == 1 for j, q in labels if j == i)}
    strata = {i: found[i].stratum for i in found}
    names = {strata[i] for i in good if not found[i].base_failed}
    for s in names:
        levels = [found[i].level for i in good if strata[i] == s and not found[i].base_failed]
        n, certified = len(levels), 0
        for x in range(1, quality.LEVELS + 1):
            k = sum(v <= x for v in levels)
            tail = math.fsum(math.comb(n, i) * 0.05**i * 0.95 ** (n - i) for i in range(k + 1))
            if tail > 0.05 / len(names):
                break
            certified = x
        assert all(found[i].certified == certified for i in found if strata[i] == s)
    for i, text, _ in texts:
        n, _, _, _, covered = brute(text)
        base = n < 10 or 100 * covered > 20 * n
        assert found[i].base_failed == base and found[i].kept == (not base and found[i].level > found[i].certified)
