"""The tokenization automaton against the tokenizers library and a small hand-made vocabulary."""

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from leafstat.llm import bpe_automaton as b

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both():
    return b.Codec(PATH), Tokenizer.from_file(PATH)


def merged(word, merges):
    """Plain BPE: the earliest merge first, from left to right."""
    parts = list(word)
    for u, v in merges:
        out, i = [], 0
        while i < len(parts):
            if parts[i:i + 2] == [u, v]:
                out.append(u + v)
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out
    return parts


def test_gadgets_on_all_short_words():
    r = random.Random(5)
    for _ in range(60):
        tokens, merges = ["a", "b", "c"], []
        for _ in range(9):
            u, v = r.choice(tokens), r.choice(tokens)
            if u + v not in tokens and len(u + v) < 6:
                merges.append((u, v))
                tokens.append(u + v)
        found = b.Automaton({t: i for i, t in enumerate(tokens)}, merges)
        for n in range(1, 7):
            for word in map("".join, itertools.product("abc", repeat=n)):
                ids = found.encode(word.encode())
                assert [tokens[i] for i in ids] == merged(word, merges)
                assert found.decode(ids) == word.encode()


def agree(both, text):
    codec, library = both
    want = library.encode(text, add_special_tokens=False).ids
    found = codec.encode(text)
    assert np.frombuffer(found, "<u4").tolist() == want
    assert codec.decode(found) == library.decode(want, skip_special_tokens=False).encode()


@settings(max_examples=400, deadline=None)
@given(text=st.text(max_size=60))
def test_any_text(both, text):
    agree(both, text)


@pytest.mark.parametrize("text", ["", " ", "a" * 500, "aaaa bbbb", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "<|endo",
                                  "I'll don't 'S", "tabs\t\n  end  ", "naïve ÀÉ ×÷", "漢字かな 😀👩‍👩‍👧", "\x00\x85\xa0"])
def test_cases(both, text):
    agree(both, text)


def test_half_characters_decode_to_the_replacement(both):
    codec, library = both
    ids = codec.encode("漢")
    for n in range(1, len(ids) // 4):
        part = np.frombuffer(ids, "<u4")[:n]
        assert codec.decode(part.astype("<u4").tobytes()) == library.decode(part.tolist(), skip_special_tokens=False).encode()


def test_documents(spark, odd, odd_rows, empty, both):
    got = {hashlib.sha256(r.decoded).hexdigest(): r for r in b.coded(odd, PATH).collect()}
    for _, text in odd_rows:
        r = got[hashlib.sha256((text or "").encode()).hexdigest()]
        assert np.frombuffer(r.ids, "<u4").tolist() == both[1].encode(text or "", add_special_tokens=False).ids
    assert b.coded(odd, PATH).count() == len(odd_rows) and b.coded(empty, PATH).count() == 0
