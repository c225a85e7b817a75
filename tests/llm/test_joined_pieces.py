"""New pieces that go to the tokenizer together have the ids they have alone."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest

from shelfcast.llm import tokens
from shelfcast.llm.textscan import Words


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))


ODD = ["a", "\x01", "x\x01y", "\x01\x01", "\x02", "</s>", "don't", "café", "é", "́a"]


@pytest.mark.parametrize("pieces", [[], ODD[4:], ODD, ["word"] * 200 + ODD[:2], ODD[4:] * 1500])
def test_joined_pieces_have_their_own_ids(encoder, pieces):
    ids, counts = encoder._pieces(pieces)
    alone = [encoder.tokenizer.encode(one, add_special_tokens=False).ids for one in pieces]
    assert counts.tolist() == [len(one) for one in alone]
    assert ids.tolist() == [number for one in alone for number in one]


def test_pieces_are_not_sent_one_by_one(encoder, monkeypatch):
    sent, library = [], encoder._library
    monkeypatch.setattr(encoder, "_library", lambda texts: [sent.append(len(texts)), library(texts)][1])
    encoder.forget()
    data = " ".join(f"w{chr(97 + n % 26)}{chr(97 + n // 26)}" for n in range(600)).encode()
    encoder.encode(np.frombuffer(data, np.uint8), np.array([0, len(data)]), 1)
    assert sum(sent) < 20


def test_words_are_compared_whole():
    data = np.frombuffer(b"a" * 256 + b" " + b"c", np.uint8)
    words = Words(data, np.array([0, len(data)]), np.arange(256) != 0x20)
    pool = np.frombuffer(b"b" * 256 + b"c", np.uint8)
    at, sizes = np.array([0, 256]), np.array([256, 1])
    text = words.hashed()[1]
    assert words.same(np.arange(2), pool, at, sizes).tolist() == [False, True]
    assert words.all_same(text, pool, at, sizes).tolist() == [False, True]
