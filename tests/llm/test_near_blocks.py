"""Blocks between components: texts travel only where the screen lets two meet."""

import random

import pandas as pd
import pytest
from llm.test_edge_rows import classes

from titlematch.llm import near_dedup


def _texts():
    """Families of near copies that share a long passage, and rows apart from them."""
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(5000)}"
    out = []
    for _ in range(5):
        shared = [word() for _ in range(60)]
        for _ in range(14):
            own = list(shared)
            for _ in range(rnd.randrange(0, 5)):
                own[rnd.randrange(len(own))] = word()
            out.append(" ".join(own))
    return out + [" ".join(word() for _ in range(60)) for _ in range(20)]


@pytest.mark.parametrize("block", [4, 512])
def test_classes_in_small_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = list(enumerate(_texts()))
    got = {r.doc_id: r.component_id for r in near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), 5).collect()}
    want = {i: c for i, _, c, _ in classes(rows, 5)}
    assert got == want and len(set(want.values())) < len(rows)


def test_candidates_need_a_band_another_label_and_a_signature():
    def row(node, label, size, lanes, *bands):
        return {"node": node, "label": label, "_main": 9, "n_shingles": size, "marks": [lanes] * near_dedup.SIG_LONGS + list(bands)}

    left = pd.DataFrame([row(1, 1, 50, 0, 1, 2)])
    right = pd.DataFrame([row(2, 9, 50, 0, 1, 7), row(3, 9, 50, 0, 2, 1), row(4, 1, 50, 0, 1, 2), row(5, 9, 50, -1, 1, 2), row(6, 9, 20, 0, 1, 2)])
    assert [(i, j.tolist()) for i, j in near_dedup._candidates(left, right, 80)] == [(0, [0])]
