"""Token ids of whole texts, computed word by word inside a task.

The word-level vocabulary drops white space, so the ids of a text are the ids of its words one after
another. Words repeat a lot; each distinct word is encoded once in a worker process.
"""

from __future__ import annotations

import os
import re
from itertools import chain, repeat

import numpy as np

from trendloom.llm.merges import BatchMerges

# Bytes of known words kept per worker process (about six share an executor); beyond it the memory is emptied
# and filled anew. Ids do not depend on it.
BYTES_KEPT = 96 << 20
# Bytes a dictionary entry of one known word costs beyond the word itself (key object, slot, index)
ENTRY_BYTES = 120
# Words of these letters with nothing but ASCII marks behind them: their ids are those of the word in lower
# case and of the marks, which the vocabulary takes as one unit each. All other words take the long way.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
# A full stop or comma by itself at the end of a word is a unit of its own, so the word is known without it.
LAST_MARK = re.compile(rb"[.,](?<=[a-z0-9][.,])(?!\S)")
# Longer units are left to the tokenizer library: the steps of a batch are as many as its longest word has merges.
LONGEST = 64


def units_of(text: str | None) -> list[bytes]:
    """The parts of a text between white space that are encoded one by one.

    A to Z become lower case, as in the vocabulary, and a last full stop or comma is a part of its own,
    unless the text may name a special token.
    """
    if not text:
        return []
    raw = text.encode("utf-8")
    return raw.split() if b"<|" in raw else LAST_MARK.sub(rb" \g<0>", raw.lower()).split()


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(others)}


def default_tokenizer() -> str:
    """Place of the public word-level vocabulary; callers may pass any other file of its kind."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Encodes texts with a tokenizer file whose pieces never span ASCII white space."""

    def __init__(self, path: str, bytes_kept: int = BYTES_KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._units = Tokenizer(self._tokenizer.model)
        self._letter = byte_letters()
        self._merges = BatchMerges(path, self._letter) if BatchMerges.holds(path) else None
        self._kept = bytes_kept
        self._reset()

    def _reset(self) -> None:
        self._code: dict[bytes, int] = {}
        self._flat = np.empty(1 << 16, np.uint32)
        self._used = 0
        self._first = np.empty(1 << 14, np.int64)
        self._size = np.empty(1 << 14, np.int64)
        self._keys = 0

    def held(self) -> int:
        """Bytes held for known words: their keys, dictionary entries and id arrays."""
        arrays = self._flat.nbytes + self._first.nbytes + self._size.nbytes
        return self._keys + ENTRY_BYTES * len(self._code) + arrays

    def _store(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Remember new words, whose ids lie one after another in ``ids``."""
        at, used = len(self._code), self._used + len(ids)
        if used > len(self._flat):
            self._flat = np.resize(self._flat, 2 * used)
        if at + len(words) > len(self._first):
            self._first = np.resize(self._first, 2 * (at + len(words)))
            self._size = np.resize(self._size, 2 * (at + len(words)))
        self._flat[self._used : used] = ids
        self._first[at : at + len(words)] = self._used + np.cumsum(sizes) - sizes
        self._size[at : at + len(words)] = sizes
        self._used = used
        self._keys += sum(map(len, words))
        self._code.update(zip(words, range(at, at + len(words))))

    def _gather(self, codes: np.ndarray) -> np.ndarray:
        """Ids of known words, one after another."""
        size = self._size[codes]
        ends = np.cumsum(size)
        place = np.repeat(self._first[codes] - (ends - size), size)
        return self._flat[place + np.arange(len(place))]

    def _encode(self, tokenizer, words: list[bytes], texts: list[str]) -> None:
        found = [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self._store(words, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes)

    def _encode_units(self, units: list[bytes]) -> None:
        """Remember new units, words the vocabulary does not cut before it merges."""
        short = [u for u in units if len(u) <= LONGEST] if self._merges else []
        if short:
            self._store(short, *self._merges.encode(short))
        long = [u for u in units if len(u) > LONGEST] if self._merges else units
        self._encode(self._units, long, ["".join(map(self._letter.__getitem__, u)) for u in long])

    def _learn(self, words: list[bytes]) -> None:
        long_way, plain, stems = [], [], {}
        for word in words:
            if word.isalpha() and word.islower():
                stems[word] = None
                continue
            match = PLAIN.fullmatch(word.decode("utf-8"))
            if match is None:
                long_way.append(word)
                continue
            key, marks = match[1].lower().encode("utf-8"), match[2].encode()
            if key == word:
                stems[key] = None
                continue
            plain.append((word, key, marks))
            if key not in self._code:
                stems[key] = None
            if marks and marks not in self._code:
                stems[marks] = None
        self._encode(self._tokenizer, long_way, [w.decode("utf-8") for w in long_way])
        self._encode_units([u for u in stems if u not in self._code])
        if plain:
            code = self._code
            # Every word is its stem and its marks; where there are none, the stem alone.
            parts = np.array([x for _, stem, marks in plain for x in (code[stem], code[marks] if marks else -1)], np.int64)
            sizes = np.where(parts < 0, 0, self._size[parts]).reshape(-1, 2).sum(axis=1)
            self._store([w for w, _, _ in plain], self._gather(parts[parts >= 0]), sizes)

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text as uint32; empty for null and white space."""
        if self.held() > self._kept:
            self._reset()
        split = [units_of(text) for text in texts]
        words = [w for text in split for w in text]
        codes = np.fromiter(map(self._code.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(codes < 0).tolist()
        if new:
            self._learn(list(dict.fromkeys([words[k] for k in new])))
            codes[new] = [self._code[words[k]] for k in new]
        flat = self._gather(codes)
        ends = np.concatenate([[0], np.cumsum(self._size[codes])])[np.cumsum([0, *map(len, split)])]
        if self.held() > self._kept:
            # give the memory back now, not when the next task of this process starts
            self._reset()
        return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]


def process_encoder(path: str) -> WordEncoder:
    """The encoder of this worker process, used by one task after another.

    It is kept with the imported tokenizer library: this package's own modules travel with each task.
    """
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_word_encoders", {})
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]
