"""Ask all documents about many keys at once, with the keys of many documents packed into one row.

Documents are dealt to chunks by a hash of their id and text, so neither an id nor a text that many rows have
fills one chunk; only rows equal in both stay together. A chunk sends its distinct keys, sorted and
delta-coded, one row for each range of keys ("bucket"); the task of a bucket answers every chunk with one
small value per key, in the same order. A key that occurs everywhere costs one entry per chunk, never one
per occurrence. The number of chunks and buckets follows the size of the texts, so each holds about the
same amount at any scale.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters of text per chunk, and per bucket of keys.
CHUNK_CHARS, BUCKET_CHARS = 1 << 20, 8 << 20
KEY_BITS = 48


def sizes(docs: DataFrame, chunk_chars: int = CHUNK_CHARS, bucket_chars: int = BUCKET_CHARS) -> tuple[int, int]:
    """Numbers of chunks and of buckets for the texts of ``docs``."""
    chars = docs.agg(F.coalesce(F.sum(F.length(F.col("text").cast("string")).cast("bigint")), F.lit(0))).first()[0]
    return -(-chars // chunk_chars) or 1, -(-chars // bucket_chars) or 1


def chunk_of(doc_id: Column, text: Column, chunks: int) -> Column:
    return F.pmod(F.xxhash64(doc_id.cast("bigint"), text), F.lit(chunks)).cast("int")


def pack(columns: list[np.ndarray]) -> bytes:
    """Arrays of unsigned numbers as one value. The first is sorted and is stored as differences."""
    import zstandard

    columns = [np.diff(columns[0], prepend=columns[0][:1] * 0), *columns[1:]]
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(value: bytes, kinds: list[type]) -> list[np.ndarray]:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(value), np.uint8)
    widths = [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(raw) // sum(widths), 0, []
    for kind, width in zip(kinds, widths):
        planes = raw[at : at + n * width].reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * width
    out[0] = np.cumsum(out[0], dtype=kinds[0])
    return out


def bucket_ends(keys: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Where the ranges of the ``buckets`` begin and end among sorted ``keys`` of ``bits`` bits."""
    edges = [(b << bits) // buckets for b in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]])


def send(columns: list[np.ndarray], buckets: int, bits: int = KEY_BITS) -> list[tuple[int, bytes]]:
    """(bucket, packed columns) for the parts of sorted keys; buckets without keys are left out."""
    ends = bucket_ends(columns[0], buckets, bits)
    return [
        (b, pack([c[ends[b] : ends[b + 1]] for c in columns])) for b in range(buckets) if ends[b + 1] > ends[b]
    ]


def received(keys: np.ndarray, buckets: int, answers: list[tuple[int, bytes]], bits: int = KEY_BITS) -> np.ndarray:
    """The answers of all buckets as one array of small numbers, one for each of the sorted ``keys``."""
    ends = bucket_ends(keys, buckets, bits)
    out = np.zeros(len(keys), np.uint8)
    for b, value in answers:
        out[ends[b] : ends[b + 1]] = unpack_answer(value)
    return out


def pack_answer(values: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values, np.uint8).tobytes())


def unpack_answer(value: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(value), np.uint8)


class Gathered:
    """The rows of one bucket: all columns together, the row each entry came from, and equal keys as groups."""

    def __init__(self, payloads: list[bytes], kinds: list[type], key_columns: int = 1):
        parts = [unpack(p, kinds) for p in payloads]
        self.sizes = [len(p[0]) for p in parts]
        self.columns = [np.concatenate([p[k] for p in parts]) for k in range(len(kinds))]
        self.origin = np.repeat(np.arange(len(parts)), self.sizes)
        keys = self.columns[:key_columns]
        self.order = np.argsort(keys[0], kind="stable") if key_columns == 1 else np.lexsort(keys[::-1])
        changed = np.zeros(len(self.order), bool)
        for key in keys:
            ordered = key[self.order]
            changed[1:] |= ordered[1:] != ordered[:-1]
        changed[:1] = True
        self.starts = np.flatnonzero(changed)
        self.group = np.cumsum(changed) - 1

    def reduce(self, function: np.ufunc, values: np.ndarray) -> np.ndarray:
        """``function`` over the entries of each group."""
        return function.reduceat(values[self.order], self.starts)

    def answers(self, by_group: np.ndarray) -> list[np.ndarray]:
        """One value per entry from one per group, split by the rows the entries came from."""
        out = np.empty(len(self.order), by_group.dtype)
        out[self.order] = by_group[self.group]
        return np.split(out, np.cumsum(self.sizes)[:-1])
