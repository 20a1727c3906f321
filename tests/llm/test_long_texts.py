"""Work grows with the length of one text, not with its square."""

import random
import re
import time

import pytest
from llm.test_edge_rows import SCHEMA, _rows

from titlematch.llm import secrets, token_counts

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)


@pytest.mark.parametrize("text", ["q" * 5_000_000, " " * 5_000_000, "q" * 2_000_000 + " w" * 1_500_000, ("ab" * 40_000 + " ") * 60, "word " * 1_000_000])
def test_chunks_of_any_text_cover_it_about_once(text):
    cuts = list(token_counts.chunks(text, token_counts.CHUNK, token_counts.OVERLAP))
    assert cuts[0][0] == 0 and cuts[-1][1] == len(text)
    assert all(a < c <= b for (a, b), (c, _) in zip(cuts, cuts[1:], strict=False))
    assert sum(b - a for a, b in cuts) <= 1.1 * len(text)


def test_many_secrets_in_one_text(spark):
    def seconds(n):
        text = "".join(f"token=abcdefgh{i} " for i in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        begun = time.monotonic()
        row = secrets.secrets(df).collect()[0]
        assert row.n_assign == n and row.spans.endswith(f"assign:{text.rindex('token')}:{len(text) - 1}")
        return time.monotonic() - begun

    seconds(100)
    assert seconds(32_000) < 4 * max(seconds(8_000), 1.0)


def base_spans(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found))


def test_secrets_of_odd_rows(spark):
    rng = random.Random(11)
    parts = ["token=abcdefgh", "AKIA" + "Z9" * 8, "AKIA123", "0af9" * 8, "ab" * 20, "Secret : 'x_y.z-00'", "é😀", " ", "\n", "password=short", "x"]
    rows = [list(r) for r in _rows()]
    for r in rows[:40]:
        r[1] = "".join(rng.choice(parts) for _ in range(rng.choice([3, 30, 400])))
    rows += [rows[0], rows[0], [None, *rows[1][1:]]]
    df = spark.createDataFrame([tuple(r) for r in rows], SCHEMA).repartition(4)
    got = secrets.secrets(df).collect()
    kinds = ("assign", "access", "hex")
    own = [(r.doc_id, ",".join(s for s in r.spans.split(",") if s.split(":")[0] in kinds)) for r in got]
    assert sorted(map(str, own)) == sorted(str((r[0], base_spans(r[1] or ""))) for r in rows)
    assert secrets.secrets(df.limit(0)).collect() == []
