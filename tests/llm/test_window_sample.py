"""The bounded sample of windows has the mix of all windows."""

import pytest

from titlematch.llm import toxicity


@pytest.mark.parametrize("share", [0.2, 0.6])
def test_equal_windows_are_sampled(spark, monkeypatch, share):
    docs = [(i, "plain words only" if i % 2 else f"plain slur{i % 3} words") for i in range(2400)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i, _ in docs], "doc_id long, toxic int")
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    seen, fit = [], toxicity.Crf.fit

    def kept(x, y, classes):
        seen.append(x)
        return fit(x, y, classes)

    monkeypatch.setattr(toxicity.Crf, "fit", kept)
    toxicity.train(docs, labels)
    every = seen[-1]
    monkeypatch.setattr(toxicity, "WINDOWS", int(share * len(every)))
    toxicity.train(docs, labels)
    assert len(seen[-1]) == int(share * len(every))
    clean = [(x == 0).all(axis=1).mean() for x in (every, seen[-1])]
    assert 0.3 < clean[0] < 0.7 and abs(clean[1] - clean[0]) < 0.12
