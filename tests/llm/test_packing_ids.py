"""Token ids of the packer against the library, for texts in which folding or cutting words could change them."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from catchment.llm import packing

IDS = packing.word_ids(public_tokenizers.path(packing.TOKENIZER))


def ours(*texts):
    return [np.frombuffer(ids, "<u4").tolist() for ids in IDS.encode(list(texts))]


def library(text):
    return IDS.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(("text", "number"), [("<|ENDOFTEXT|>", 6), ("x <|EndOfText|> y", 8), ("<|StartOfText|>", 7), ("İ;", 4), ("<|endoftext|>", 1)])
def test_special_strings_and_marks(text, number):
    assert ours(text) == [library(text)] and len(library(text)) == number


PART = st.sampled_from(["<|", "|>", "<|endoftext|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "İ", "é", "é", "ß", "ǅ", "ŉ", "ſ", "x", "Word", "it's", "1", ".", ";", "!?", "'", " ", "\n", " ", "漢", "😀", "ǰ", "́"]) | st.characters()


@given(st.lists(st.lists(PART, max_size=8).map("".join), min_size=1, max_size=5))
@settings(max_examples=500, deadline=None)
def test_ids_are_the_librarys(texts):
    assert ours(*texts) == [library(text) for text in texts]


def test_what_is_remembered_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBER", 1000)
    encoder = packing.WordIds(public_tokenizers.path(packing.TOKENIZER))
    texts = [f"word{n}. other{n} {'x' * n}" for n in range(200)]
    for text in texts:
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library(text)
        assert encoder.held < 4000 and len(encoder.words) < 40
