"""The trained operators and the pipeline against plain evaluation."""

import math

import pytest
from llm.test_edge_rows import SCHEMA, _pieces, _rows, classes, fold, key
from pyspark.sql import functions as F

import corpus_pipeline
from titlematch.llm import mixing, quality, toxicity

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_rules_evaluate_plainly(given):
    docs, labels = given
    stats = quality.described(docs)
    model = quality.train(stats, labels)
    assert model.rules
    for r in stats.select("*", model.score().alias("own_score")).collect():
        total = model.intercept
        for weight, rule in model.rules:
            total += weight * all(r[n] <= b if sign == "<=" else r[n] > b for n, sign, b in rule.terms)
        assert r.own_score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-12)


def test_accepted_are_those_predicted(given):
    docs, labels = given
    want = {r.doc_id for r in quality.quality_scores(docs, labels).filter("predicted = 1").collect()}
    assert {r.doc_id for r in quality.accepted(docs, labels).collect()} == want and 0 < len(want) < docs.count()


def test_toxic_scores_and_offsets_text_by_text(spark):
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    some = 0
    for r in toxicity.toxicity(docs, labels).collect():
        x, tagged = model.tag([texts[r.doc_id]])
        spans = toxicity.spans_of(texts[r.doc_id], *tagged[0])
        assert r.score == pytest.approx(float(model.scores(x)[0]), abs=1e-9)
        assert r.spans == ",".join(f"{a}:{b}" for a, b in spans)
        before = 0
        for a, b in spans:
            assert before <= a < b <= len(texts[r.doc_id])
            assert texts[r.doc_id][a:b].strip() == texts[r.doc_id][a:b]
            before, some = b, some + 1
    assert some


def test_pipeline_of_odd_rows(spark, tmp_path, given):
    """Odd rows among given ones: every stage keeps what its plain version keeps."""
    docs, labels = given
    odd = spark.createDataFrame(_rows(), SCHEMA).withColumn("doc_id", F.col("doc_id") + 1_000_000)
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars").union(odd.select("doc_id", "text", "lang", "source", "n_chars"))
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    now, sf = spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)
    stages = dict(corpus_pipeline.STAGES)

    def step(name, df):
        path = f"{tmp_path}/{name}"
        stages[name](spark, df, sf).write.parquet(path)
        return spark.read.parquet(path)

    scored = {}
    for r in quality.quality_scores(now, labels).collect():
        scored.setdefault(r.doc_id, []).append(r.predicted)
    good = step("quality", now)
    assert good.count() == sum(sum(v) for v in scored.values())

    single = step("exact_dedup", good)
    groups = {}
    for r in good.collect():
        groups.setdefault(fold(r.text), []).append(r.doc_id)
    kept = single.collect()
    assert sorted(fold(r.text) for r in kept) == sorted(groups)
    assert all(r.doc_id == max((i for i in groups[fold(r.text)] if i is not None), default=None) for r in kept)

    near = step("near_dedup", single)
    want = [i for i, _, _, k in classes([(r.doc_id, r.text) for r in kept], 5) if k]
    assert sorted(key([r.doc_id]) for r in near.collect()) == sorted(key([i]) for i in want)

    mixed = step("mixing", near)
    copies = {}
    for r in mixing.mix(near).collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + r.copies
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in copies.items() if n}

    pieces = step("packing", mixed).collect()
    assert sorted(key(r[:5]) for r in pieces) == sorted(map(key, _pieces([(r.doc_id, r.text) for r in mixed.collect()], 2048, "<u4")))
