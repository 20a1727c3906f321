"""The prefix-tree join against brute force."""

import random

import numpy as np
import pytest
from llm.test_edge_rows import key, shingles

from titlematch.llm import jaccard_join


def components(rows, words, percent):
    """Rows one by one; rows that repeat an id stand for themselves."""
    sets = [shingles(t, words) if i is not None else set() for i, t, *_ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    least = {}
    for x, (i, *_) in enumerate(rows):
        if i is not None:
            least[root(x)] = min(i, least.get(root(x), i))
    return [(i, len(shingles(t, words)), None if i is None else least[root(x)]) for x, (i, t, *_) in enumerate(rows)]


def edited(seed, copies=120, length=150):
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(length)]
    out = []
    for i in range(copies):
        words = list(base)
        for k in rng.sample(range(length), rng.choice([0, 1, 2, 3, 5, 8])):
            words[k] = rng.choice([f"e{rng.randrange(10**6)}", "the"])
        out.append((i, " ".join(words)))
    out += [(1000 + i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))) for i in range(100)]
    out += [(2000 + i, " ".join(base[:100]) + " " + " ".join(f"t{i}x{k}" for k in range(rng.choice([3, 60])))) for i in range(60)]
    return out


@pytest.mark.parametrize("words, percent", [(3, 90), (2, 50), (3, 80)])
def test_components(spark, words, percent, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    rows = edited(words * percent)
    got = jaccard_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), words, percent).collect()
    assert sorted(map(key, got)) == sorted(map(key, components(rows, words, percent)))


def test_odd_rows(spark):
    from llm.test_edge_rows import SCHEMA, _rows

    rows = _rows() + [(66, "another text under an id that repeats", "en", "s", -1, 7, "f", "n", "s", "r")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = jaccard_join.jaccard_classes(docs).collect()
    assert sorted(map(key, got)) == sorted(map(key, components(rows, 3, 90)))
    assert jaccard_join.jaccard_classes(docs.limit(0)).collect() == []


def test_frequent_shingles_are_looked_up_by_broadcast(spark, monkeypatch):
    from titlematch.llm import base

    monkeypatch.setattr(base, "HOT_ROWS", 20)
    rows = edited(4)
    got = jaccard_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(key, got)) == sorted(map(key, components(rows, 3, 90)))


@pytest.mark.parametrize("percent", [50, 70, 90, 100])
def test_tree_finds_all_components(percent):
    rng = random.Random(percent)
    for _ in range(40):
        base = rng.sample(range(200), rng.randint(1, 60))
        sets = {tuple(sorted({*rng.sample(base, rng.randint(max(1, len(base) - 6), len(base))), *rng.sample(range(200), rng.choice([0, 1, 4]))})) for _ in range(30)}
        sets = [np.array(s) for s in sets]
        every = list(range(len(sets)))
        links = jaccard_join.tree_links(sets, every, every, every, percent)
        want = {(i, j) for i in every for j in every[:i] if 100 * len(set(sets[i]) & set(sets[j])) >= percent * len(set(sets[i]) | set(sets[j]))}
        assert all(tuple(sorted(x, reverse=True)) in want for x in links)

        def parts(pairs):
            parent = dict(zip(every, every, strict=True))

            def root(x):
                while parent[x] != x:
                    x = parent[x]
                return x

            for a, b in pairs:
                parent[root(a)] = root(b)
            groups = {}
            for x in every:
                groups.setdefault(root(x), set()).add(x)
            return sorted(map(sorted, groups.values()))

        assert parts(links) == parts(want)
        assert len(links) == len(sets) - len(parts(links))
