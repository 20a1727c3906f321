"""The peeled trie against a trie made turn by turn."""

import hashlib
import random
import zlib

import pytest
from llm.test_edge_rows import key

from titlematch.llm import base, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, path string, level string, n string"


def brute(rows):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            token = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, token, len(text)))
    members, lengths, ends = {}, {}, {}
    for c in own:
        own[c].sort()
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (c % 100 if c >= 0 else -(-c % 100))
        path = tuple((t, n) for *_, t, n in [*own.get(first, [])[:h], *mine[h:]])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
            lengths[path[:d]] = path[d - 1][1] if d else 0
        ends.setdefault(path, []).append(c)
    stats = {}
    for path in sorted(members, key=len, reverse=True):
        children = [p for p in stats if len(p) == len(path) + 1 and p[: len(path)] == path]
        leaves = sum(stats[p][1] for p in children) or 1
        saved = sum(stats[p][2] for p in children) + (len(members[path]) - 1) * lengths[path]
        stats[path] = (len(children), leaves, saved)
    out = []
    for path, (children, leaves, saved) in stats.items():
        parent = min(members[path[:-1]]) if path else None
        listed = ",".join(map(str, sorted(ends.get(path, []))))
        out.append((min(members[path]), len(path), parent, len(members[path]), children, leaves, saved, hashlib.sha256(listed.encode()).hexdigest()))
    return out


def conversations(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(-5, n):
        k = rng.choice([1, 2, 3, 5, 8, longest])
        for t in range(k):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "user", None]), rng.choice(["a", "bb", "é日", None, ""]) if rng.random() < 0.9 else f"own {c} {t}"))
    return rows


def extra(rows):
    return [(*r, "d", "p", "l", "n") for r in rows]


def run(spark, rows, parts=3):
    return prefix_trie.prefix_trie(spark.createDataFrame(extra(rows), SCHEMA).repartition(parts)).collect()


@pytest.mark.parametrize("hot", [1000, 3])
def test_short_conversations(spark, hot, monkeypatch):
    monkeypatch.setattr(base, "HOT_ROWS", hot)
    monkeypatch.setattr(prefix_trie, "PIECE", 4)
    rows = conversations(3, 140, 12) + [(None, 0, "user", "a"), (200, None, None, None)] * 2
    # many equal conversations, whose first has no turns beyond those taken from it
    rows += [(c, t, "user", "same") for c in range(300, 360) for t in range(7)]
    assert sorted(map(key, run(spark, rows))) == sorted(map(key, brute(rows)))


def test_long_conversations(spark, monkeypatch):
    """Solitary tails of many segments, two long ones that agree for a while, one
    that ends inside another, and equal ones."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 2)
    rows = [(c, t, "user", f"t{t}" if t < 30 or c != 8 else f"other {t}") for c in (7, 8, 9, 10) for t in range(60 if c != 9 else 41)]
    rows += [(50, t, "user", f"alone {t} " + "x" * (t % 5)) for t in range(75)]
    rows += [(c, t, "system", f"twin {t}") for c in (1001, 2002) for t in range(33)]
    assert sorted(map(key, run(spark, rows, 8))) == sorted(map(key, brute(rows)))


def test_one_conversation_and_none(spark):
    rows = [(3, 0, "user", "x" * 50_000)]
    assert sorted(map(key, run(spark, rows))) == sorted(map(key, brute(rows)))
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "a")]) == []
