import re

import pytest
from pyspark.sql import functions as F

from depotlake.llm import decontam
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [(1, prose(30, 4)), (2, "two words"), (3, None), (4, " ... "), (5, "É ü"), (6, prose(30, 4)), (7, prose(20, 1) + " 中文")]


def fold(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(documents, items, window=13):
    windows = {}
    for item, text in items:
        words = fold(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1) if words else ():
            windows.setdefault(tuple(words[i : i + n]), set()).add(str(item))
    out = []
    for doc_id, text in documents:
        words, hit, found = fold(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(words[i : i + n])]
        out.append((doc_id, len(words), len(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.fixture
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("limit", [decontam.MAX_BYTES, 300])
def test_hits_equal_brute_force(spark, corners, corner_rows, items, monkeypatch, limit):
    monkeypatch.setattr(decontam, "MAX_BYTES", limit)
    extra = [(20, "x; Two-WORDS, É. Ü two"), (21, "a " + prose(30, 4) + " b " + prose(20, 1)), (22, prose(12, 4))]
    docs = corners.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    found = decontam.scan(docs, items, carry=["doc_id"]).select("row.doc_id", "hit.*").collect()
    found = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found), key=repr)
    assert found == brute([(r[0], r[1]) for r in corner_rows] + extra, ITEMS)


def test_documents_or_spans_go(spark, items):
    rows = [(1, "Keep É, two-WORDS ü end", "x"), (2, prose(400, 9) + " two words", "x"), (3, "clean", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hit string")
    assert {r.doc_id for r in decontam.decontaminate(docs, items).collect()} == {2, 3}
    cut = {r.doc_id: r.text for r in decontam.decontaminate(docs, items, remove="spans").collect()}
    assert cut[1] == "Keep É, - ü end" and cut[3] == "clean" and cut[2] == prose(400, 9) + "  "
    assert decontam.decontaminate(docs, items).columns == docs.columns
    with pytest.raises(ValueError, match="documents or spans"):
        decontam.decontaminate(docs, items, remove="words")


def test_empty_and_clashing(spark, items, corners, clashing, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.scan(corners, none).where("hit.n_hit > 0").count() == 0
    assert decontam.scan(nothing, items).count() == 0
    kept = decontam.decontaminate(clashing, items)
    assert kept.columns == clashing.columns
    assert sorted(map(repr, kept.select(corners.columns).collect())) == sorted(
        map(repr, decontam.decontaminate(corners, items).collect())
    )


def test_a_window_does_not_cross_documents(spark, items):
    words = prose(30, 4).split()
    docs = spark.createDataFrame([(1, " ".join(words[:12])), (2, " ".join(words[12:24]))], "doc_id long, text string").coalesce(1)
    assert decontam.scan(docs, items).where(F.col("hit.n_hit") > 0).count() == 0
