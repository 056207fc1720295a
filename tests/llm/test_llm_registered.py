"""Queries of this package with reference SQL, and the pipeline against brute force on its stages."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check
import corpus_pipeline
from riskweave.llm import queries, tables
from test_llm_operators import near_by_hand, words_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_reference_sql(spark, con, name):
    verdict, _ = check.compare(spark, con, name, queries.QUERIES[name], queries.ORACLES[name], SF)
    assert verdict.startswith("ok"), verdict


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_copies", "near_copies", "source_mix", "tokens"]


def test_pipeline_stages(spark):
    docs = tables.read(spark, SF, "documents")
    odd = spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "!!", None, None, 2), (None, "the of and by", "en", None, 13)],
                                docs.schema)
    docs = docs.union(odd)
    made = []
    for name, stage in corpus_pipeline.STAGES:
        docs = tables.store(spark, stage(spark, docs, SF), name)
        made.append([r.asDict() for r in docs.collect()])
    spoken, single, apart, mixed, done = made
    assert {r["doc_id"] for r in spoken} >= {None} and not {9001, 9002} & {r["doc_id"] for r in spoken}
    best = {}
    for r in spoken:
        best[r["text"]] = max(best.get(r["text"], -1), -1 if r["doc_id"] is None else r["doc_id"])
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in single) == sorted(best.values())
    hand = near_by_hand([(10**9 if r["doc_id"] is None else r["doc_id"], r["text"]) for r in single], 5, 80)
    assert sorted(10**9 if r["doc_id"] is None else r["doc_id"] for r in apart) == sorted({c for _, c in hand.values()})
    known = {r["doc_id"]: r for r in apart}
    assert all(known[r["doc_id"]] == r for r in mixed)
    total = sum(len(words_of(r["text"])) for r in apart)
    assert abs(sum(len(words_of(r["text"])) for r in mixed) - total) < 0.2 * total
    assert sorted((str(r["doc_id"]), r["text_sha256"]) for r in done) == sorted(
        (str(r["doc_id"]), hashlib.sha256(r["text"].encode()).hexdigest()) for r in mixed)


def test_empty_documents_pass_every_stage(spark):
    docs = tables.read(spark, SF, "documents").where(F.lit(False))
    for name, stage in corpus_pipeline.STAGES:
        docs = tables.store(spark, stage(spark, docs, SF), name)
    assert docs.count() == 0
