"""Unit-wise encoding equals the library's on whole texts."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from titlematch.llm import tokens
from titlematch.llm.tokens import Encoder, bare, default_path, id_bytes, slices, spaced

CASES = {"byte_bpe_50k.json": (spaced, False), "word_bpe_49k.json": (bare, True)}
ODD = list(" \n\t\r\x0b\x0c\x1c\x1f\x85\xa0\u1680\u2003\u2028\u3000\u200b\u0301'!") + [
    "a", "B", "é", "É", "ß", "İ", "7", "٣", "!", "###", ",", "'s", "don't", "DON'T", "<|endoftext|>", "<|startoftext|>", "<|STARTOFTEXT|>", "<|EndOfText|>", "word", "Tokens", "日本", "😀", "api_key",
]


@pytest.fixture(scope="module")
def pairs():
    return {f: (Encoder(default_path(f), u, id_bytes, lo), Tokenizer.from_file(default_path(f))) for f, (u, lo) in CASES.items()}


@pytest.mark.parametrize("name", CASES)
@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=40).map("".join))
def test_equal_to_library(pairs, name, text):
    own, library = pairs[name]
    (got,) = own.each([text], b"".join)
    assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", CASES)
def test_long_texts_go_in_parts(pairs, name, monkeypatch):
    own, library = pairs[name]
    monkeypatch.setattr(tokens, "SLICE", 50)
    rng = random.Random(3)
    for _ in range(40):
        text = "".join(rng.choice(ODD) for _ in range(300))
        assert "".join(slices(text, 50)) == text
        (got,) = own.each([text], b"".join)
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
