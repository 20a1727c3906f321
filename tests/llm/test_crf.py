"""The CRF against sums over all label paths."""

from itertools import product

import numpy as np

from titlematch.llm.crf import Crf


def paths(model, window):
    for labels in product((0, 1), repeat=len(window)):
        score = model.initial[labels[0]] + sum(model.emission[c, y] for c, y in zip(window, labels, strict=True))
        yield labels, score + sum(model.transition[a, b] for a, b in zip(labels, labels[1:], strict=False))


def random_model(seed):
    rng = np.random.default_rng(seed)
    return Crf(rng.normal(size=(4, 2)) * 3, rng.normal(size=(2, 2)), rng.normal(size=2))


def test_marginals_equal_sums_over_paths():
    model, rng = random_model(1), np.random.default_rng(2)
    windows = rng.integers(0, 4, (5, 7)).astype(np.uint8)
    got = model.marginals(windows)
    for row, window in zip(got, windows, strict=True):
        weight = {labels: np.exp(s) for labels, s in paths(model, window)}
        z = sum(weight.values())
        for t in range(7):
            assert np.isclose(row[t], sum(w for y, w in weight.items() if y[t]) / z)


def test_long_windows_do_not_underflow():
    got = random_model(3).marginals(np.full((2, 5000), 2, dtype=np.uint8))
    assert np.isfinite(got).all() and ((got >= 0) & (got <= 1)).all()


def test_fit_raises_the_likelihood_and_learns():
    rng = np.random.default_rng(5)
    windows = rng.integers(0, 4, (300, 12)).astype(np.uint8)
    labels = (windows == 3).astype(np.int64)
    model = Crf.fit(windows, labels, 4)

    def likelihood(m):
        out = 0.0
        for window, y in zip(windows[:20, :8], labels[:20, :8], strict=True):
            scores = dict(paths(m, window))
            out += scores[tuple(y)] - np.logaddexp.reduce(list(scores.values()))
        return out

    assert likelihood(model) > likelihood(Crf(np.zeros((4, 2)), np.zeros((2, 2)), np.zeros(2))) + 50
    assert ((model.marginals(windows) > 0.5) == (labels == 1)).mean() > 0.99
    assert Crf.fit(windows[:0], labels[:0], 4).marginals(windows[:0]).shape == (0, 12)
