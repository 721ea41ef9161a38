"""Ids of the word encoder against the tokenizer library."""

import random

import pytest
from tokenizers import Tokenizer

from trendloom.llm.merges import BatchMerges
from trendloom.llm.tokens import LONGEST, WordEncoder, byte_letters, default_tokenizer


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer())


def test_batch_merges_equal_the_library(library):
    rng = random.Random(5)
    words = ["a", "aaaaaaaaaaaa", "ababababab", "$$$", "...", "über", "naïve"]
    words += ["".join(rng.choice(["th", "er", "in", "an", "e", "s", "q", "ü"]) for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    ids, sizes = BatchMerges(default_tokenizer(), byte_letters()).encode([w.encode() for w in words])
    expected = [library.encode(w, add_special_tokens=False).ids for w in words]
    assert sizes.tolist() == [len(x) for x in expected]
    assert ids.tolist() == [i for x in expected for i in x]


def test_texts_with_marks_equal_the_library(library):
    rng = random.Random(6)
    parts = ["Word", "word", "ÜBER", "straße", "don't", "it's.", "e.g.", "x..", "7.", "3,5,", "'s,", "a$$$", "b.%%%,", "é.", "İx.",
             "q" * (LONGEST + 9), "<|endoftext|>", "a<|b|>.", "中文,", "é.", " y.", "_z_,", ".", ",", "(ok),"]
    texts = ["".join(rng.choice(parts) + rng.choice([" ", " ", "\n", "\t", "", "\x0b", ". ", ","]) for _ in range(60)) for _ in range(300)]
    texts += ["", None, " ", "end.", "end,\r\n"]
    got = WordEncoder(default_tokenizer()).encode_all(texts)
    for text, ids in zip(texts, got):
        assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_words_are_learned_once_whatever_mark_follows():
    """Full stops and commas made words of their own; each cost a learning and an entry of the memory."""
    encoder = WordEncoder(default_tokenizer())
    encoder.encode("alpha alpha. alpha, Alpha. beta, beta")
    assert sorted(encoder._code) == [b",", b".", b"alpha", b"beta"]


def test_words_go_to_the_library_one_by_one_only_if_they_must(monkeypatch):
    encoder, asked = WordEncoder(default_tokenizer()), []
    by_library = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda tokenizer, words, texts: (asked.extend(words), by_library(tokenizer, words, texts)))
    encoder.encode("plain words, Capitals ÜBER and symbols$$$ are merged in a batch, don't.")
    assert sorted(asked) == [b",", b".", b"don't"]
