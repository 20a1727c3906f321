"""The registered queries on the small tables: against their SQL, and held-out
accuracy of the trained ones."""

import os
import zlib

import duckdb
import pytest
from conftest import rows

import __spark_entry__ as E
import corpus_pipeline
from titlematch.llm.queries import ORACLE_SQL, QUERIES

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_all_are_registered():
    names = E.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(ORACLE_SQL[name])
    columns = sorted(d[0] for d in res.description)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    want = res.to_arrow_table().select(columns).to_pylist()
    assert rows(got.select(columns)) == sorted((tuple(r.values()) for r in want), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name, label, folds, held_out", [("op6_toxicity", "toxic", 5, 0), ("op7_quality", "quality", 3, 1)])
def test_held_out_accuracy(spark, name, label, folds, held_out):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    right = total = ones = 0
    for r in QUERIES[name](spark, LARGER).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held_out)
        if r.held_out and r.doc_id in labels:
            total += 1
            ones += labels[r.doc_id]
            right += r.predicted == labels[r.doc_id]
    assert right / total >= max(ones, total - ones) / total + 0.02


def test_pipeline(spark):
    docs, counts = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        counts[name] = docs.count()
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
        if name in ("quality", "exact_dedup", "near_dedup"):
            assert out.exceptAll(docs).isEmpty()
        docs = out
    assert counts["quality"] > counts["exact_dedup"] > counts["near_dedup"]
    assert docs.groupBy("sequence_id").agg({"length": "sum"}).filter("`sum(length)` > 2048").isEmpty()
