"""Remembered chunks against the library on whole texts."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kempt.llm.tokens import encoder, vocabulary

NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
_PIECES = ["the", "Ered.", " ", "  ", "\n", "\n\n", "\t", "word,", "it's", "'s", "don't", "'", "é", "ñandú", "1234", "²x", "__",
           "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "###", "a.b", " ", "́", "é", "İ", "漢字", "🙂", "\r\n", "x\ny", "!\n", " ", "ß", "½", "I'LL", "$'s"]


def direct(path, text, plain=True):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    if plain:
        t.encode_special_tokens = True
    return [t.encode(x, add_special_tokens=False).ids for x in text]


def ids(path, text, plain=True):
    return np.frombuffer(encoder(path, plain=plain)(text), "<u2").tolist()


@pytest.mark.parametrize("name", NAMES)
def test_mixed_pieces(name):
    rng = random.Random(3)
    texts = ["".join(rng.choice(_PIECES) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    path = vocabulary(name)
    for plain in (True, False):
        for t, want in zip(texts, direct(path, texts, plain), strict=True):
            assert ids(path, t, plain) == want, repr(t)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=40))
def test_any_text(text):
    for name in NAMES:
        path = vocabulary(name)
        e = encoder(path, plain=True)
        assert np.frombuffer(e(text), "<u2").tolist() == e.bare.tokenizer.encode(text, add_special_tokens=False).ids
