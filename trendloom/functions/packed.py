"""Term vectors as short byte strings: whole numbers of seven bits a byte, terms as differences of sorted numbers.

A row is ``terms, (difference of term numbers * 2 + counted more than once) ..., count ...`` with the counts of the terms
counted more than once. A vector has the number of articles after the first number and the frequencies before the
counts, from which the weights follow.
"""

from __future__ import annotations

import hashlib

import numpy as np


def to_bytes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All values as bytes, least significant first, and where each one ends."""
    values = np.asarray(values, np.uint64)
    width = np.ones(len(values), np.int64)
    for k in range(1, 10):
        width += values >= np.uint64(1 << 7 * k)
    ends = np.cumsum(width)
    out, starts = np.zeros(ends[-1] if len(ends) else 0, np.uint8), ends - width
    for k in range(width.max(initial=0)):
        has = width > k
        more = np.where(width[has] > k + 1, 128, 0)
        out[starts[has] + k] = ((values[has] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | more.astype(np.uint8)
    return out, ends


def from_bytes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of :func:`to_bytes`, and where each one ends."""
    ends = np.flatnonzero(data < 128) + 1
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    width, out = ends - starts, np.zeros(len(ends), np.uint64)
    for k in range(width.max(initial=0)):
        has = width > k
        out[has] |= (data[starts[has] + k] & np.uint8(127)).astype(np.uint64) << np.uint64(7 * k)
    return out.astype(np.int64), ends


def places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``starts[i], ..., starts[i] + lengths[i] - 1`` for each i."""
    before = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) + np.repeat(starts - before, lengths)


def pack(lengths: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Terms and counts of rows with ``lengths`` terms each, at least one; a row's terms are in ascending order."""
    return _rows(lengths, *_entries(lengths, terms, counts))


def unpack(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms a row, their numbers and their counts."""
    values, first, sizes = _values(rows)
    lengths = values[first]
    terms, many = _terms(lengths, values[places(first + 1, lengths)])
    counts = np.ones(len(terms), np.int64)
    counts[many] = values[places(first + 1 + lengths, sizes - 1 - lengths)]
    return lengths, terms, counts


def pack_vectors(
    lengths: np.ndarray, terms: np.ndarray, counts: np.ndarray, frequencies: np.ndarray, articles: int
) -> tuple[list[bytes], list[bytes]]:
    """Vectors and signatures of rows with ``lengths`` terms each, at least one, in ascending order in a row.

    Signatures are equal for rows whose counts are in one proportion.
    """
    starts = np.cumsum(lengths) - lengths
    shares = counts // np.repeat(np.gcd.reduceat(counts, starts) if len(starts) else lengths, lengths)
    signatures = [
        hashlib.sha256(terms[a : a + n].astype("<i8").tobytes() + shares[a : a + n].astype("<i8").tobytes()).digest()
        for a, n in zip(starts, lengths)
    ]
    return _rows(lengths, *_entries(lengths, terms, counts), frequencies, articles), signatures


def unpack_vectors(vectors: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms a row, their numbers and their weights ``count * (ln((1 + articles) / (1 + frequency)) + 1)``, of length one a row."""
    values, first, sizes = _values(vectors)
    lengths, articles = values[first], values[first + 1]
    terms, many = _terms(lengths, values[places(first + 2, lengths)])
    frequencies = values[places(first + 2 + lengths, lengths)]
    counts = np.ones(len(terms), np.int64)
    counts[many] = values[places(first + 2 + 2 * lengths, sizes - 2 - 2 * lengths)]
    raw = counts * (np.log((1.0 + np.repeat(articles, lengths)) / (1.0 + frequencies)) + 1.0)
    norms = np.sqrt(np.add.reduceat(raw * raw, np.cumsum(lengths) - lengths)) if len(lengths) else raw
    return lengths, terms, raw / np.repeat(norms, lengths)


def _entries(lengths, terms, counts) -> tuple[np.ndarray, np.ndarray]:
    """Differences of terms, doubled and one more where the count is above one, and the counts."""
    starts = np.cumsum(lengths) - lengths
    steps = np.diff(terms, prepend=0)
    steps[starts] = terms[starts]
    return steps * 2 + (counts > 1), counts


def _rows(lengths, steps, counts, frequencies=None, articles: int | None = None) -> list[bytes]:
    if not len(lengths):
        return []
    many, head = counts > 1, 1 if frequencies is None else 2
    extras = np.add.reduceat(many, np.cumsum(lengths) - lengths, dtype=np.int64)
    sizes = head + head * lengths + extras
    first = np.cumsum(sizes) - sizes
    values = np.empty(sizes.sum(), np.int64)
    values[first] = lengths
    values[places(first + head, lengths)] = steps
    if frequencies is not None:
        values[first + 1] = articles
        values[places(first + head + lengths, lengths)] = frequencies
    values[places(first + head + head * lengths, extras)] = counts[many]
    data, ends = to_bytes(values)
    cuts, raw = np.concatenate([[0], ends[first + sizes - 1]]), data.tobytes()
    return [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _values(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All numbers of the rows, where each row begins and how many it has."""
    values, ends = from_bytes(np.frombuffer(b"".join(rows), np.uint8))
    cuts = np.searchsorted(ends, np.cumsum([len(row) for row in rows], dtype=np.int64), side="right")
    first = np.concatenate([[0], cuts]).astype(np.int64)
    return values, first[:-1], np.diff(first)


def _terms(lengths, steps) -> tuple[np.ndarray, np.ndarray]:
    many, steps = (steps & 1).astype(bool), steps >> 1
    total, starts = np.cumsum(steps), np.cumsum(lengths) - lengths
    return total - np.repeat(total[starts] - steps[starts], lengths), many
