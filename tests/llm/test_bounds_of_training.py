"""What the trained operators learn from, and what a worker remembers."""

import numpy as np

from titlematch.llm import quality, toxicity


def test_quality_learns_from_a_bounded_sample(spark, monkeypatch):
    labels = spark.range(6000).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")
    whole = {r._id for r in quality.learnt(labels).collect()}
    assert len(whole) == labels.filter(quality.fold_of(labels.doc_id, 3) != 1).count()
    monkeypatch.setattr(quality, "SAMPLE", 500)
    some = {r._id for r in quality.learnt(labels).collect()}
    assert some < whole and 350 < len(some) < 650
    assert some == {r._id for r in quality.learnt(labels.repartition(5)).collect()}


def test_toxicity_remembers_no_long_tokens():
    model = toxicity.ToxicModel({"bad": 3, "5 worse": 2}, None, np.zeros(5))
    long = "worse" + "x" * 200
    classes, again = model.classes(f"a bad {long} {long} bad")
    assert classes.tolist() == [0, 3, 2 + toxicity.LEVELS, 2 + toxicity.LEVELS, 3] and again == [3]
    assert max(map(len, model._known)) <= toxicity.LONGEST


def test_every_leaning_feature_is_in_the_lexicon(spark):
    docs = spark.createDataFrame([(i, f"foul{i % 40} thing" if i % 2 else "fine thing") for i in range(4000)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS int) AS toxic")
    lexicon = toxicity.train(docs, labels).lexicon
    assert {f"foul{i}" for i in range(1, 40, 2)} <= set(lexicon) and "thing" not in lexicon and "fine" not in lexicon
