"""Encoders of words: which path takes a word, and that its ids don't depend on it."""

import random

import numpy as np
import public_tokenizers
import pytest

from lakeops.llm import lexicon_bpe, packing

ODD = [chr(c) for c in range(256)] + list("aaabbbeee    'stdréñß 19.,") * 4 + [
    "中", "é", "́", "😀", "İ", "ſ", "Ω", " ", " the", " don't", "<|endoftext|>", "The,&&&"]


@pytest.fixture
def texts():
    rng = random.Random(3)
    return ["".join(rng.choices(kind, k=rng.randint(0, 30)))
            for kind in (ODD, [c for c in ODD if c.isascii()], [c for c in ODD if len(c) == 1 and c < "\x80" or c in "éñß"])
            for _ in range(1000)]


def test_ids_of_words_are_those_of_the_library(texts, monkeypatch):
    coder = packing.PieceCoder(public_tokenizers.path("word_bpe_49k.json"))
    want = [np.array(e.ids, "<u2").tobytes() for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert coder.encode(texts) == want == coder.encode(texts)
    monkeypatch.setattr(packing, "CACHED_WORDS", 40)  # generations follow each other
    assert coder.encode(texts) == want and len(coder) < 200


def test_plain_words_never_take_the_whole_tokenizer(monkeypatch):
    coder = packing.PieceCoder(public_tokenizers.path("word_bpe_49k.json"))
    text = "Plain words, größer öffentlich: toonlyntst eroronsh"
    want = np.array(coder.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
    coder.encode([", :"])
    coder.tokenizer = None
    assert coder.encode([text]) == [want]


def test_latin_texts_are_split_by_the_plain_pattern(texts, monkeypatch):
    latin = [t for t in texts if all(c <= "\xff" for c in t)]
    want = [lexicon_bpe._SPLIT.findall(t) for t in latin]
    monkeypatch.setattr(lexicon_bpe, "_SPLIT", None)
    splitter = lexicon_bpe.Splitter(None, "")
    assert [[w for run in splitter.runs(t) for w in run] for t in latin] == want
