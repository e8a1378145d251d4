"""The queries: equal to their SQL, and whole; the pipeline against its stages by brute force."""

from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from depotlake.llm import oracles, queries
from tests.llm.test_decontam import brute as hits
from tests.llm.test_jaccard import brute as groups

duckdb = pytest.importorskip("duckdb")

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'").fetchall()
    return connection


def test_all_thirteen_are_registered():
    names = contract.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(oracles.ORACLES) <= set(names)


@pytest.mark.parametrize("name", oracles.ORACLES)
def test_query_equals_its_sql(spark, oracle, name):
    result = queries.QUERIES[name](spark, str(TABLES))
    columns = sorted(result.columns)
    found = sorted(map(repr, (tuple(r) for r in result.select(*columns).collect())))
    listed = ", ".join(f'"{c}"' for c in columns)
    assert found == sorted(map(repr, oracle.execute(f"SELECT {listed} FROM ({oracles.ORACLES[name]})").fetchall()))


def test_stages_keep_what_brute_force_keeps(spark):
    documents = spark.read.parquet(f"{TABLES}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{TABLES}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    docs = stages["language ID"](spark, documents, str(TABLES))
    assert docs.columns == documents.columns
    assert docs.count() == documents.where("text rlike '[a-zA-Z]{3}'").count()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    kept = stages["n-gram Jaccard join"](spark, docs, str(TABLES))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, root in groups(texts, 5, 80) if i == root)
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    clean = stages["benchmark decontamination"](spark, kept, str(TABLES))
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, n, hit, _ in hits(texts, items) if not (hit and 20 * hit >= n))
    safe = stages["secret scans"](spark, clean, str(TABLES))
    assert safe.columns == documents.columns and safe.count() == clean.count()
    packed = stages["packing"](spark, safe, str(TABLES)).collect()
    found = Counter()
    for r in packed:
        found[r.doc_id] += r.length
    assert found == {r.doc_id: r.doc_tokens for r in packed} and set(found) == {r.doc_id for r in safe.collect()}


def test_stages_on_corner_rows(spark, corners, nothing):
    for docs in (corners, nothing):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(TABLES))
            if name == "n-gram Jaccard join" and docs.count():
                ids = Counter(r.doc_id for r in docs.collect())
                assert ids[1] == 1 and not ids[2] and not ids[3] and ids[4] == 1 and ids[None] == 1
        assert docs.columns[0] == "doc_id"
