"""What the encoder does per new piece."""

from __future__ import annotations

import cProfile
import pstats

import numpy as np
import public_tokenizers
import pytest

from flowlens.llm import tokens


@pytest.mark.parametrize("name, most", [("byte_bpe_50k.json", 21), ("word_bpe_49k.json", 10.5)])
def test_new_pieces_take_few_calls(name, most):
    words = ["".join(chr(97 + (i >> s & 15)) for s in (0, 4, 8, 12)) for i in range(20_000)]
    text = " ".join(w + ("," if i % 9 == 0 else "") for i, w in enumerate(words)) + " " + "x" * 60
    encoder = tokens.Encoder(public_tokenizers.path(name))
    plain = encoder._tokenizer.encode(text, add_special_tokens=False).ids
    profile = cProfile.Profile()
    profile.enable()
    raw = encoder.encode(text)
    profile.disable()
    assert np.frombuffer(raw, "<u4").tolist() == plain
    assert pstats.Stats(profile).total_calls < most * len(words)
    assert max(map(len, encoder._new)) <= tokens.LONGEST_KEPT


@pytest.mark.parametrize("name, most_new, most_texts", [("byte_bpe_50k.json", 7, 14), ("word_bpe_49k.json", 7.5, 6)])
def test_pieces_and_texts_are_handled_by_columns(name, most_new, most_texts):
    words = ["".join(chr(97 + (i >> s & 15)) for s in (0, 4, 8, 12)) + ("," if i % 9 == 0 else "") for i in range(20_000)]
    encoder = tokens.Encoder(public_tokenizers.path(name))
    plain = [e.ids for e in encoder._tokenizer.encode_batch(words, add_special_tokens=False)]
    for texts, most in (([" ".join(words)], most_new), (words, most_texts)):
        profile = cProfile.Profile()
        profile.enable()
        found = list(encoder.encode_all(texts))
        profile.disable()
        assert pstats.Stats(profile).total_calls < most * len(words)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == plain
