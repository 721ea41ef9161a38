"""License scan: MinHash bands of overlapping text windows find templates, exact shingle containment decides.

Templates of similar length form a class. For a class, windows of a fixed number of shingles are laid over
the whole text so closely that some window holds any occurrence of a template entirely. The least Jaccard
value such a window can have with a contained template is known, and the number of bands is chosen for it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.word_hashes import WordHasher, shingle_hashes

SHINGLE = 5
CONTAINMENT = 0.75
# A window that holds a template is missed by all bands with this probability at most.
MISS = 1e-4
BAND_ROWS = 1
# A longer template list is scanned in slices of this many, one after another.
TEMPLATES_AT_ONCE = 2000
EDGES = re.compile(rb"^[^\w\x80-\xff]+|[^\w\x80-\xff]+$")


def plain_words(text: str | None) -> list[bytes]:
    """Words in lower case (A to Z), without punctuation at their ends; words of punctuation alone are left out."""
    if not text:
        return []
    return [w for w in (EDGES.sub(b"", x) for x in text.encode("utf-8").lower().split()) if w]


def shingle_set(words: list[bytes]) -> frozenset[tuple[bytes, ...]]:
    k = min(SHINGLE, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


class LengthClass:
    """Windows and bands for templates of ``least`` to 2 * ``least`` - 1 distinct shingles."""

    def __init__(self, least: int, miss: float = MISS, rows: int = BAND_ROWS):
        most = 2 * least - 1
        self.least, self.rows, self.stride = least, rows, max(1, least // 2)
        # Windows begin every stride; one of this many strides covers any run of ``most`` shingles.
        self.strides = -(-(most + self.stride - 1) // self.stride)
        needed = math.ceil(CONTAINMENT * least)
        # A contained part of the shortest template against a window full of other shingles.
        self.jaccard = needed / (self.strides * self.stride + least - needed)
        self.bands = max(1, math.ceil(math.log(miss) / math.log(1 - self.jaccard**rows))) if self.jaccard < 1 else 1


def permuted(places: np.ndarray, number: int) -> np.ndarray:
    """The shingles' hashes under permutation ``number``."""
    h = (places ^ np.uint64((0x9E3779B97F4A7C15 * (number + 1)) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def window_minima(h: np.ndarray, kind: LengthClass) -> np.ndarray:
    """Least value of each window; windows begin every stride and the last ones are cut off by the end."""
    blocks = -(-len(h) // kind.stride)
    padded = np.full((blocks + kind.strides) * kind.stride, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(h)] = h
    least = padded.reshape(-1, kind.stride).min(axis=1) if kind.stride > 1 else padded
    windows = least[:blocks].copy()
    for k in range(1, kind.strides):
        np.minimum(windows, least[k : k + blocks], out=windows)
    return windows


class TemplateIndex:
    """Templates by length class and band value. Their number is checked by the caller."""

    def __init__(self, templates: Iterable[tuple[str, str]], miss: float = MISS, rows: int = BAND_ROWS):
        self.rows, self.sets = rows, {}
        self.kinds: dict[int, LengthClass] = {}
        #: (class, band) -> value -> templates, and the sorted values
        self.bands: dict[tuple[int, int], dict[int, list[str]]] = {}
        hasher = WordHasher()
        for name, text in templates:
            words = plain_words(text)
            if not words:
                continue
            self.sets[name] = shingle_set(words)
            least = 1 << (len(self.sets[name]).bit_length() - 1)
            kind = self.kinds.setdefault(least, LengthClass(least, miss, rows))
            hashes = shingle_hashes(hasher(words), SHINGLE)
            for band in range(kind.bands):
                value = np.zeros(1, np.uint64)
                for row in range(rows):
                    value = value * np.uint64(31) + permuted(hashes, band * rows + row).min()
                self.bands.setdefault((least, band), {}).setdefault(int(value[0]), []).append(name)
        self.values = {key: np.array(sorted(found), np.uint64) for key, found in self.bands.items()}

    def candidates(self, hashes: np.ndarray) -> set[tuple[str, int, int]]:
        """(template, first, end) of windows over the shingles that share a band with a template."""
        found: set[tuple[str, int, int]] = set()
        for band in range(max((k.bands for k in self.kinds.values()), default=0)):
            shared = [permuted(hashes, band * self.rows + row) for row in range(self.rows)]
            for least, kind in self.kinds.items():
                if band >= kind.bands:
                    continue
                value = np.zeros(-(-len(hashes) // kind.stride), np.uint64)
                for h in shared:
                    value = value * np.uint64(31) + window_minima(h, kind)
                known = self.values[least, band]
                at = np.minimum(np.searchsorted(known, value), len(known) - 1)
                for window in np.flatnonzero(known[at] == value).tolist():
                    first = window * kind.stride
                    for name in self.bands[least, band][int(value[window])]:
                        found.add((name, first, first + kind.strides * kind.stride))
        return found


def verified(words: list[bytes], template: frozenset, windows: list[tuple[int, int]]) -> tuple[float, int, int] | None:
    """Best exact containment in one of the windows, with first word and number of words of what matches."""
    best = None
    for first, end in windows:
        k = min(SHINGLE, len(words))
        places = [i for i in range(first, min(end, len(words) - k + 1)) if tuple(words[i : i + k]) in template]
        share = len({tuple(words[i : i + k]) for i in places}) / len(template)
        if share >= CONTAINMENT and (best is None or share > best[0]):
            best = (share, places[0], places[-1] + k - places[0])
    return best


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]], miss: float = MISS, rows: int = BAND_ROWS) -> DataFrame:
    """(doc_id, license, containment, first_word, n_words) for every template that a text contains.

    Of each template the best occurrence is reported, the first of equal ones; ``containment`` is the
    share of its distinct 5-word shingles found in one window, 0.75 at least. Words are compared in lower
    case (A to Z) and without punctuation at their ends; a template of fewer words is one shingle.
    Null and empty texts contain nothing; neither do templates without words. Repeated rows are each
    reported; a null ``doc_id`` stays null. Only doc_id and text are used.
    """
    schema = "doc_id bigint, license string, containment double, first_word int, n_words int"

    def scan_slice(part: list[tuple[str, str]]) -> DataFrame:
        def scan(batches):
            import pyarrow as pa

            index, hasher = TemplateIndex(part, miss, rows), WordHasher()
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32())
            names = ["doc_id", "license", "containment", "first_word", "n_words"]
            for batch in batches:
                found = []
                for at in range(0, batch.num_rows, 64):
                    part_of = batch.slice(at, 64)
                    doc_ids = part_of.column("doc_id").to_pylist()
                    texts = [plain_words(x.as_py()) for x in part_of.column("text")]
                    hashes = [shingle_hashes(hasher(words), SHINGLE) for words in texts]
                    # One row of windows over all these texts; one that lies in two texts is looked up in both.
                    starts = np.cumsum([0, *map(len, hashes)])
                    by_text: dict[tuple[int, str], list[tuple[int, int]]] = {}
                    for name, first, end in index.candidates(np.concatenate(hashes)):
                        at_first, at_end = np.searchsorted(starts, [first, end - 1], side="right") - 1
                        for k in range(int(at_first), min(int(at_end), len(texts) - 1) + 1):
                            by_text.setdefault((k, name), []).append((max(first - int(starts[k]), 0), end - int(starts[k])))
                    for (k, name), windows in sorted(by_text.items()):
                        if hit := verified(texts[k], index.sets[name], sorted(windows)):
                            found.append((doc_ids[k], name, *hit))
                columns = zip(*found) if found else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(scan, schema)

    slices = [templates[k : k + TEMPLATES_AT_ONCE] for k in range(0, len(templates), TEMPLATES_AT_ONCE)] or [[]]
    result = scan_slice(slices[0])
    for part in slices[1:]:
        result = result.unionAll(scan_slice(part))
    return result
