"""Bounds and blocks of the top-k search."""

import numpy as np
import pandas as pd
import pytest

from titlematch.llm import topk_search as search


def _block(x):
    centre = np.rint(x.mean(axis=0))
    radius = int(np.ceil(np.sqrt(((x - centre) ** 2).sum(axis=1).max())))
    return x.max(axis=0), x.min(axis=0), centre.astype(np.int64), radius


@pytest.mark.parametrize("scale", [1, 1000, 1 << 24])
def test_no_score_exceeds_its_bound(scale):
    rng = np.random.default_rng(scale)
    parts = [rng.integers(-scale, scale + 1, (n, 9)) + rng.integers(-5 * scale, 5 * scale, 9) for n in (1, 2, 40, 128)]
    q = np.concatenate([rng.integers(-scale, scale + 1, (30, 9)), np.zeros((1, 9), np.int64), parts[2][:3]])
    largest, smallest, centre, radius = (np.array(c) for c in zip(*map(_block, parts), strict=True))
    most = search.bounds(q, largest, smallest, centre, radius)
    for j, x in enumerate(parts):
        assert (search.products(q, x).max(axis=1) <= most[:, j]).all()


def test_only_blocks_that_may_hold_a_result_are_sent():
    rng = np.random.default_rng(1)
    near, far = rng.integers(900, 1000, (50, 8)), -rng.integers(900, 1000, (50, 8))
    largest, smallest, centre, radius = zip(*map(_block, (near, far)), strict=True)
    raw = {name: [np.asarray(v).astype("<i2").tobytes() for v in of] for name, of in (("largest", largest), ("smallest", smallest), ("centre", centre))}
    group = pd.DataFrame({"block": [5, 9], "radius": radius} | raw)
    asked = pd.DataFrame({"vector": [near[0].astype("<i2").tobytes()], "kth": [int(np.sort(near @ near[0])[-11])]})
    assert search.needed(asked, group, 8, "<i2").tolist() == [5]
    asked["kth"] = search._LOWEST
    assert search.needed(asked, group, 8, "<i2").tolist() == [5, 9]


def test_many_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(search, "QUERIES", 3)
    monkeypatch.setattr(search, "GROUP", 2)
    monkeypatch.setattr(search, "BLOCK", 16)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 10)) * 4
    rows = [(i, [float(v) for v in centres[i % 12] + rng.normal(size=10) * 0.1]) for i in range(1500)]
    found = search.top_scores(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=50).collect()
    x = np.floor(np.array([v for _, v in rows]) * 1024).astype(np.int64)
    want = []
    for i in range(0, 1500, 50):
        scores = x @ x[i]
        order = [int(j) for j in np.lexsort((np.arange(1500), -scores)) if j != i][:10]
        want += [(i, k + 1, j, int(scores[j])) for k, j in enumerate(order)]
    assert sorted(map(tuple, found)) == want


@pytest.mark.parametrize("value", [2.0**43, -1e300])
def test_components_beyond_exact_integers_raise(spark, value):
    rows = spark.createDataFrame([(1, [value]), (2, [0.5])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="would not be exact"):
        search.top_scores(rows).collect()


def test_products_beyond_64_bits_raise():
    with pytest.raises(ValueError, match="64 bits"):
        search.products(np.array([[1 << 40]]), np.array([[1 << 40]]))
