"""Byte-pair ids of many words at once: the merges of a tokenizer file, applied to whole arrays."""

from __future__ import annotations

import json

import numpy as np


class BatchMerges:
    """Applies the merges of a byte-level model to words, each word one unit.

    As in the tokenizer library, the pair of the lowest rank is merged first and the leftmost one if it occurs
    again, until no pair of the word has a merge. One step does that for all words at once.
    """

    def __init__(self, path: str, letters: dict[int, str]):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        self._inner = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self._last = np.array([vocab[letters[b] + end] for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self._keys, self._rank = keys[order], order.astype(np.int32)
        self._made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self._none = len(pairs)

    @staticmethod
    def holds(path: str) -> bool:
        """True for byte-pair models without choices that the arrays do not know of."""
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
        return model["type"] == "BPE" and plain and len(model["merges"]) > 0

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self._keys, key), self._none - 1)
        return np.where(self._keys[at] == key, self._rank[at], np.int32(self._none))

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of non-empty words one after another, and their number by word."""
        if not words:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(size)
        ids, word = self._inner[raw], np.repeat(np.arange(len(words)), size)
        ids[ends - 1] = self._last[raw[ends - 1]]
        rank = np.empty(len(ids), np.int32)
        rank[:-1] = self._ranks(ids[:-1], ids[1:])
        rank[ends - 1] = self._none  # the rank of a pair stands at its left part
        done = []
        while True:
            first = np.cumsum(size) - size
            best = np.minimum.reduceat(rank, first)
            live = best < self._none
            if not live.all():
                spread = np.repeat(live, size)
                done.append((ids[~spread], word[~spread]))
                if not live.any():
                    break
                ids, word, rank, best, size = ids[spread], word[spread], rank[spread], best[live], size[live]
            at = np.flatnonzero(rank == np.repeat(best, size))
            owner = word[at]
            at = at[np.concatenate([[True], owner[1:] != owner[:-1]])]
            ids[at] = self._made[best]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            rank[at] = rank[at + 1]  # that of a last part stays as it is
            ids, word, rank = ids[keep], word[keep], rank[keep]
            size = size - 1
            at = at - np.arange(len(at))
            near = np.concatenate([at, at[at > 0] - 1])
            near = near[near + 1 < len(ids)]
            near = near[word[near] == word[near + 1]]
            rank[near] = self._ranks(ids[near], ids[near + 1])
        ids, word = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
        return ids[np.argsort(word, kind="stable")].astype(np.uint32), np.bincount(word, minlength=len(words))
