"""Ids by pieces against the tokenizer on whole texts."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import tokens

ENCODER = tokens.encoder(tokens.tokenizer_path())


def whole(text):
    return ENCODER.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(
    "text",
    ["", " ", "  a", "a\n\n b", "it's 'S we'll", " 's", "x²½ a", "été Ñandú_1 __", "\t\r\n", "a b", "日本語 text", "<|endoftext|> a",
     "é", "a" * 5000, "1234 12a", "...!?  ''ll", "\x1c\x1f\x0b", "ﬀ ſt ĳ"],
)
def test_same_ids(text):
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == whole(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab Zé'sñ12_.\n\t!ſ×"), max_size=40) | st.text(max_size=30))
def test_same_ids_of_any_text(text):
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == whole(text)


def test_null_and_long():
    assert ENCODER.encode(None) == b""
    text = "word soup with étude, " * 30_000
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == whole(text)
