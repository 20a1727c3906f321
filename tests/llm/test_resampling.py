"""Resampling against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from llm.test_edge_rows import SCHEMA, _rows, fold, key

from titlematch.llm import resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    w = WORD.findall(fold(text))
    return len(w), [zlib.crc32(f.encode()) % 10_000 for f in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))]]


def brute(rows, target):
    own = [(i, *features(t)) for i, t, *_ in rows]
    s, t = Counter(b for *_, f in own for b in f), Counter(b for x in target for b in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for i, n_words, f in own:
        gain = [math.floor(1000 * math.log((t[b] + 1.0) * (big_s + 10_000.0) / ((s[b] + 1.0) * (big_t + 10_000.0)))) for b in f]
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain) // len(gain) if gain else 0
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    drawn = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    ranks = {id(r): k for k, r in enumerate(drawn[: 25 * len(drawn) // 100], 1)}
    return [(*r[:4], ranks.get(id(r))) for r in out]


@pytest.mark.parametrize("target", [["w1 w2 w3", None, "", "w1 w2 Über"], [None], []])
def test_odd_rows(spark, target):
    rows = _rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    wanted = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = resampling.resampled(docs, wanted).collect()
    assert sorted(map(key, got)) == sorted(map(key, brute(rows, target)))
    assert resampling.resampled(docs.limit(0), wanted).collect() == []


@pytest.mark.parametrize("window", [1, 7, 64, 1 << 20])
def test_windows_do_not_show(window):
    texts = [t for t in ("a b c", "", "word", "x" * 50, "é日 ü-ö a1 b2", "...", "a a a a a a a a", "last one")]
    words, n, places = resampling.batch_features([t.encode() for t in texts], window=window)
    want = [features(t) for t in texts]
    assert list(words) == [w for w, _ in want] and list(n) == [len(f) for _, f in want]
    at = 0
    for k, (_, f) in zip(n, want, strict=True):
        assert sorted(places[at : at + k]) == sorted(f)
        at += k
