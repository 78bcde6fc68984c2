"""Texts are encoded by their distinct words, with the ids of the whole text."""

import random

import numpy as np
import pytest

from textspark.llm import encoding


@pytest.fixture
def encoder():
    model = encoding.read_model(encoding.DEFAULT_MODEL)
    assert encoding.word_by_word(model)
    return encoding._Encoder(encoding.rebuilt(model).to_str(), model.SerializeToString(), True, 1)


def test_each_word_is_encoded_once(encoder):
    asked, ids = [], encoder._ids
    encoder._ids = lambda texts: asked.extend(texts) or ids(texts)
    for _ in range(2):
        encoder.encode(["to be or not to be", "to be", ""])
    assert sorted(asked) == ["be", "not", "or", "to"]


@pytest.mark.parametrize("remembered", [3, encoding.REMEMBERED])
def test_ids_are_those_of_whole_texts(encoder, monkeypatch, remembered):
    monkeypatch.setattr(encoding, "REMEMBERED", remembered)
    draw = random.Random(5)
    parts = ["a", "the", "Straße", "日本語", "🙂", " ", "  ", "\n", "\t", "▁", "▁▁x", " ", "<s>", "<0x41>", "don't", "x" * 300, "\x00"]
    texts = ["", " ", "   ", *("".join(draw.choices(parts, k=draw.randint(1, 12))) for _ in range(400))]
    for k in range(0, len(texts), 50):
        some = texts[k : k + 50]
        flat, ends, parity, _ = encoder.encode(some)
        got = [x.tolist() for x in np.split(flat, ends)[:-1]]
        assert got == encoder._ids(some) == encoder.pieces.encode(some)
        assert all(parity)
    assert len(encoder.words) < 1000


def test_a_differing_word_marks_its_texts_only(encoder):
    theirs = encoder.pieces

    class Other:
        def encode(self, texts, num_threads):
            return [[0] if t == "odd" else x for t, x in zip(texts, theirs.encode(texts))]

    encoder.pieces = Other()
    assert encoder.encode(["an odd one", "", "even", "odd"])[2] == [False, True, True, False]
    assert encoder.encode(["even odd", "one"])[2] == [False, True]
