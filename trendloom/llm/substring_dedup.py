"""Repeated passages by fixed-block anchors.

Every text is an index of its non-overlapping blocks of 7 words and is probed with each of its rolling
7-word windows. Any 13 words hold a whole block of the text they come from, so whatever occurs in two texts
gives a hit. Hits are extended to windows of 13 words, compared by 96-bit fingerprints, and windows that
overlap join to maximal exact repeats. Blocks, probes and windows travel packed (see ``keys``), with one
entry per chunk for each distinct content, so a passage that every text shares is no hot key.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm import keys
from trendloom.llm.word_hashes import MIX_TOO, WordHasher, runs

WINDOW = 13
# The longest block that any WINDOW words contain whole, wherever blocks begin.
BLOCK = (WINDOW + 1) // 2
LAST = np.iinfo(np.int64).max
SHA = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, repeats array<struct<first:bigint,words:bigint>>, kept binary"


class Chunk:
    """Words, anchors and windows of the texts of one chunk."""

    def __init__(self, table, hasher: WordHasher):
        self.doc_ids = table.column("doc_id").to_pylist()
        self.words = [(t or b"").split() for t in table.column("text").to_pylist()]
        self.count = np.array([len(w) for w in self.words], np.int64)
        self.first = np.cumsum(self.count) - self.count
        self.hashes = hasher([w for words in self.words for w in words])
        self.text_of = np.repeat(np.arange(len(self.words)), self.count)
        # A text without id is no text's predecessor and comes after all others.
        ids = np.array([LAST if d is None else d for d in self.doc_ids], np.int64)
        self.id_of = ids[self.text_of]

    def inside(self, length: int) -> np.ndarray:
        """The places where ``length`` words of one text begin."""
        n = max(len(self.text_of) - length + 1, 0)
        return np.flatnonzero(self.text_of[:n] == self.text_of[len(self.text_of) - n :])

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct 48-bit keys of the rolling windows of BLOCK words, flags (1: also a block, 2: in several
        texts here), the windows' places, and the key of each."""
        at = self.inside(BLOCK)
        key = runs(self.hashes, BLOCK)[at] >> np.uint64(64 - keys.KEY_BITS)
        distinct, which = np.unique(key, return_inverse=True)
        block = (at - self.first[self.text_of[at]]) % BLOCK == 0
        flags = np.zeros(len(distinct), np.uint8)
        flags[which[block]] = 1
        low, high = np.full(len(distinct), len(self.words)), np.full(len(distinct), -1)
        np.minimum.at(low, which, self.text_of[at])
        np.maximum.at(high, which, self.text_of[at])
        flags[high > low] |= 2
        return distinct, flags, at, which

    def windows(self, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For windows of WINDOW words that hold a hit anchor: distinct fingerprints (64 and 32 bits), the
        least id here, the windows' places, and the fingerprint of each. ``hit`` marks words."""
        at = self.inside(WINDOW)
        upto = np.concatenate([[0], np.cumsum(hit)])
        at = at[upto[at + WINDOW - BLOCK + 1] > upto[at]]
        if not len(at):
            none = np.empty(0, np.int64)
            return none.astype(np.uint64), none.astype(np.uint32), none, none, none
        high = runs(self.hashes, WINDOW)[at]
        low = (runs(self.hashes, WINDOW, MIX_TOO)[at] >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((low, high))
        new = np.ones(len(at), bool)
        new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
        starts = np.flatnonzero(new)
        which = np.empty(len(at), np.int64)
        which[order] = np.cumsum(new) - 1
        least = np.minimum.reduceat(self.id_of[at][order], starts)
        return high[order][starts], low[order][starts], least, at, which


def _rows(rows: list[tuple], kinds: list, names: list[str]):
    import pyarrow as pa

    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


PACKED = "bucket int, chunk int, kind int, payload binary"


def _packed(rows: list[tuple]):
    import pyarrow as pa

    return _rows(rows, [pa.int32(), pa.int32(), pa.int32(), pa.binary()], ["bucket", "chunk", "kind", "payload"])


def drop_repeats(docs: DataFrame, chunk_chars: int = keys.CHUNK_CHARS, bucket_chars: int = keys.BUCKET_CHARS,
                 with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, repeats, kept.

    A window is 13 consecutive words of one text. Each word is removed that lies in a window whose words
    also occur in a document with a smaller ``doc_id``; all windows are judged on the input. ``repeats``
    are the maximal removed runs (first word, number of words); ``kept`` is what stays, joined by single
    spaces, in UTF-8 (null without ``with_text``).

    Words are separated by ASCII white space and otherwise unchanged. Null and white texts have no words.
    Rows with the same ``doc_id`` are judged each against smaller ids only, so repeated rows do not remove
    one another. A null ``doc_id`` counts as larger than any other. Only doc_id and text are used.
    """
    chunks, buckets = keys.sizes(docs, chunk_chars, bucket_chars)
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"),
        keys.chunk_of(F.col("doc_id"), F.col("text").cast("string"), chunks).alias("chunk"),
    )

    def probe(table):
        chunk = table.column("chunk")[0].as_py()
        distinct, flags, _, _ = Chunk(table, WordHasher()).anchors()
        return _packed([(b, chunk, 0, p) for b, p in keys.send([distinct, flags], buckets)])

    def answer(table):
        rows = table.to_pylist()
        found = keys.Gathered([r["payload"] for r in rows], [np.uint64, np.uint8])
        flags = found.reduce(np.bitwise_or, found.columns[1])
        several = np.diff(np.append(found.starts, len(found.order))) > 1
        hit = (flags & 1 > 0) & (several | (flags & 2 > 0))
        return _packed([
            (r["bucket"], r["chunk"], 0, keys.pack_answer(a)) for r, a in zip(rows, found.answers(hit.astype(np.uint8))) if a.any()
        ])

    def hits(chunk: Chunk, answers: list[tuple[int, bytes]]) -> np.ndarray:
        distinct, _, at, which = chunk.anchors()
        hit = np.zeros(len(chunk.hashes), bool)
        hit[at] = keys.received(distinct, buckets, answers)[which] > 0
        return hit

    def extend(table, replies):
        if not table.num_rows or not replies.num_rows:
            return _packed([])
        chunk = table.column("chunk")[0].as_py()
        answers = [(r["bucket"], r["payload"]) for r in replies.to_pylist()]
        texts_here = Chunk(table, WordHasher())
        high, low, least, _, _ = texts_here.windows(hits(texts_here, answers))
        # What the last step needs to find the same windows again goes along.
        return _packed([
            *((b, chunk, 1, p) for b, p in keys.send([high, low, least.view(np.uint64)], buckets, 64)),
            *((b, chunk, 0, p) for b, p in answers),
        ])

    def earlier(table):
        rows = table.to_pylist()
        carried = [(r["bucket"], r["chunk"], 0, r["payload"]) for r in rows if r["kind"] == 0]
        rows = [r for r in rows if r["kind"] == 1]
        if not rows:
            return _packed(carried)
        found = keys.Gathered([r["payload"] for r in rows], [np.uint64, np.uint32, np.uint64], key_columns=2)
        ids = found.columns[2].view(np.int64)
        least = found.reduce(np.minimum, ids)
        own = np.split(ids, np.cumsum(found.sizes)[:-1])
        smaller = [(a < b).astype(np.uint8) for a, b in zip(found.answers(least), own)]
        return _packed(carried + [(r["bucket"], r["chunk"], 1, keys.pack_answer(s)) for r, s in zip(rows, smaller) if s.any()])

    def remove(table, replies):
        import pyarrow as pa

        texts_here = Chunk(table, WordHasher())
        removed = np.zeros(len(texts_here.hashes) + 1, np.int64)
        answers: dict[int, list[tuple[int, bytes]]] = {0: [], 1: []}
        for r in replies.to_pylist():
            answers[r["kind"]].append((r["bucket"], r["payload"]))
        if answers[0]:
            high, _, least, at, which = texts_here.windows(hits(texts_here, answers[0]))
            gone = (keys.received(high, buckets, answers[1], 64) > 0)[which] | (least[which] < texts_here.id_of[at])
            np.add.at(removed, at[gone], 1)
            np.add.at(removed, at[gone] + WINDOW, -1)
        gone = np.cumsum(removed[:-1]) > 0
        out = []
        for doc_id, words, first in zip(texts_here.doc_ids, texts_here.words, texts_here.first.tolist()):
            mask = gone[first : first + len(words)]
            repeats = []
            if mask.any():
                edges = np.flatnonzero(np.diff(mask, prepend=False, append=False))
                repeats = [{"first": int(a), "words": int(b - a)} for a, b in zip(edges[::2], edges[1::2])]
                kept = b" ".join([w for w, g in zip(words, mask.tolist()) if not g])
            else:
                kept = b" ".join(words)
            out.append((doc_id, len(words), int(mask.sum()), hashlib.sha256(kept).hexdigest(), repeats, kept if with_text else None))
        span = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.binary()]
        return _rows(out, kinds, ["doc_id", "n_words", "n_removed", "kept_sha256", "repeats", "kept"])

    by_chunk = texts.groupBy("chunk")
    answered = by_chunk.applyInArrow(probe, PACKED).groupBy("bucket").applyInArrow(answer, PACKED)
    extended = by_chunk.cogroup(answered.groupBy("chunk")).applyInArrow(extend, PACKED)
    judged = extended.groupBy("bucket").applyInArrow(earlier, PACKED)
    return by_chunk.cogroup(judged.groupBy("chunk")).applyInArrow(remove, SHA)
