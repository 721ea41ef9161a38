"""Periodic runs of words: string synchronising sets at dyadic scales.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal), at least
``min_length`` words and ``min_exponent`` periods long, that no neighbouring word extends with period ``q``.

Method. Words become integers per text. At each scale ``tau = 2, 4, 8, ...`` the fragments of ``tau`` words get
a hash; fragments of period at most ``tau/3`` get none (they lie inside runs of small period found before). A
position ``i`` belongs to the synchronising set when the smallest hash of the fragments ``i .. i+tau`` is that of
``i`` or ``i+tau``. Whether ``i`` is chosen depends only on words ``i .. i+2*tau-1``, so inside a run of period
``q`` the choices repeat with period ``q``, and a run with ``q`` in ``[2*tau, 4*tau)`` and three periods always
holds a chosen pair ``(i, i+q)`` with equal context. Pairs of chosen positions with equal context hash and such a
distance propose the period ``q``; a proposal is extended word by word to the maximal stretch with that period
and kept if the stretch has no smaller period. Periods up to ``SMALL`` come from a direct scan, the highly
periodic regions that the synchronising sets leave out. Each scale costs time linear in the text; a text is
handled inside one task; texts are dealt round-robin over all tasks first, and texts without a recurring
fragment of two thirds of the least run length skip the search.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.shared import cores

#: Periods found by the direct scan; larger ones by synchronising sets.
SMALL = 5
MIN_LENGTH, MIN_EXPONENT = 24, 3

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_INF = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))

RUN_TYPE = "array<struct<start:long,length:long,period:long>>"


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser, so that word numbers become well spread hash values."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


class _Hashes:
    """Hashes of all fragments of a given length, equal for equal fragments wherever they stand."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE, dtype=np.uint64)]))
            self.inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE_INV, dtype=np.uint64)]))
            self.prefix = np.concatenate([[np.uint64(0)], np.cumsum(_mix(ids) * powers[:n], dtype=np.uint64)])

    def of(self, length: int) -> np.ndarray:
        """Hash of the fragment of ``length`` words at each start ``0 .. n-length``."""
        m = len(self.prefix) - length
        with np.errstate(over="ignore"):
            return (self.prefix[length:] - self.prefix[:m]) * self.inverse[:m]


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values, in time linear in the values (blocks of prefix and suffix minima)."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, _INF, dtype=np.uint64)
    padded[:n] = values
    shaped = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(shaped, axis=1).ravel()
    behind = np.minimum.accumulate(shaped[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.arange(n - width + 1)
    return np.minimum(behind[starts], ahead[starts + width - 1])


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of True."""
    edges = np.diff(np.concatenate([[0], equal.view(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _has_period(ids: np.ndarray, start: int, end: int, period: int) -> bool:
    return bool(np.array_equal(ids[start : end - period], ids[start + period : end]))


def _smallest(ids: np.ndarray, start: int, end: int, period: int) -> bool:
    """True if no divisor of ``period`` below it is a period of the stretch (no other period can be, by Fine and Wilf)."""
    return not any(period % q == 0 and _has_period(ids, start, end, q) for q in range(1, period // 2 + 1))


def _reach(ids: np.ndarray, i: int, period: int, step: int) -> int:
    """From word ``i`` in direction ``step``, the last position ``k`` with ``ids[k] == ids[k+period]``, plus ``step``."""
    n = len(ids)
    k, width = i, 64
    if step > 0:
        while k < n - period:
            end = min(n - period, k + width)
            bad = np.flatnonzero(ids[k:end] != ids[k + period : end + period])
            if bad.size:
                return k + int(bad[0])
            k, width = end, width * 2
        return n - period
    while k >= 0:
        begin = max(0, k - width + 1)
        bad = np.flatnonzero(ids[begin : k + 1] != ids[begin + period : k + 1 + period])
        if bad.size:
            return begin + int(bad[-1])
        k, width = begin - 1, width * 2
    return -1


def _small_runs(ids: np.ndarray, min_exponent: int) -> set[tuple[int, int, int]]:
    """Runs of period up to SMALL by a direct scan of equal words ``q`` apart."""
    out = set()
    for q in range(1, min(SMALL, len(ids) // max(min_exponent, 1)) + 1):
        starts, ends = _stretches(ids[:-q] == ids[q:])
        for a, b in zip(starts.tolist(), ends.tolist()):
            length = b - a + q
            if length >= min_exponent * q and _smallest(ids, a, a + length, q):
                out.add((a, length, q))
    return out


def find_runs(ids: np.ndarray, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of at least ``min_exponent`` periods, sorted by start, then period.

    ``min_exponent`` below 3 counts as 3: the proposals are complete for three periods and more.
    """
    ids = np.asarray(ids, dtype=np.int64)
    n = len(ids)
    min_exponent = max(int(min_exponent), 3)
    runs = _small_runs(ids, min_exponent)
    if n == 0:
        return []
    hashes = _Hashes(ids)
    tau = 2
    while min_exponent * 2 * tau <= n:
        # fragments of tau words with period at most tau/3 lie in known runs of such a period, of tau words or more
        periodic = np.zeros(n - tau + 2, dtype=np.int32)
        for s, length, q in runs:
            if 3 * q <= tau and length >= tau:
                periodic[s] += 1
                periodic[s + length - tau + 1] -= 1
        ident = hashes.of(tau).copy()
        ident[np.cumsum(periodic)[: n - tau + 1] > 0] = _INF
        least = _sliding_min(ident, tau + 1)
        last = n - 2 * tau
        chosen = np.flatnonzero((least != _INF) & ((ident[: last + 1] == least) | (ident[tau : tau + last + 1] == least)))
        context = hashes.of(2 * tau)[chosen]
        order = np.lexsort((chosen, context))
        pos, key = chosen[order], context[order]
        proposals = []
        t = 1
        while t < len(pos):
            near = (key[t:] == key[:-t]) & (pos[t:] - pos[:-t] < 4 * tau)
            if not near.any():
                break
            far = near & (pos[t:] - pos[:-t] >= 2 * tau)
            proposals.append(np.stack([pos[t:][far] - pos[:-t][far], pos[:-t][far]], axis=1))
            t += 1
        if proposals:
            found = np.unique(np.concatenate(proposals), axis=0)
            covered: dict[int, int] = {}
            for d, i in found.tolist():
                if i < covered.get(d, -1) or ids[i] != ids[i + d]:
                    continue
                end = _reach(ids, i, d, 1)
                start = _reach(ids, i, d, -1) + 1
                covered[d] = end
                length = end + d - start
                if length >= min_exponent * d and _smallest(ids, start, start + length, d):
                    runs.add((start, length, d))
        tau *= 2
    return sorted(runs, key=lambda r: (r[0], r[2], r[1]))


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words without those that stand in a run after its first period."""
    gone = np.zeros(len(words) + 1, dtype=np.int32)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    drop = np.cumsum(gone)[: len(words)] > 0
    return [w for w, d in zip(words, drop.tolist()) if not d]


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length over period; ties to the smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def _repeats(ids: np.ndarray, min_length: int) -> bool:
    """False when no fragment of ``2 * min_length // 3`` words occurs twice, so no run of ``min_length`` words exists.

    A run of period ``q`` and length ``L >= max(min_length, 3q)`` holds a fragment of ``L - q >= max(min_length - q,
    2q) >= 2 * min_length / 3`` words that recurs ``q`` words later.
    """
    size = max(1, 2 * min_length // 3)
    if len(ids) < max(size + 1, min_length):
        return False
    hashes = _Hashes(ids).of(size)
    return len(np.unique(hashes)) < len(hashes)


def _text_runs(text: str | None, min_length: int, min_exponent: int) -> tuple[int, list, str]:
    words = _WORD.findall(text) if text else []
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
    runs = [r for r in find_runs(ids, min_exponent) if r[1] >= min_length] if _repeats(ids, min_length) else []
    return len(words), runs, " ".join(collapse(words, runs))


def periodic_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Runs of every text, and the text with each run cut to its first period.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Returns one row per input row, in any order: ``key`` as given
    (null stays null), ``n_words`` long, ``runs`` (start, length, period of every run with at least
    ``min_length`` words and ``min_exponent`` periods, by start, then period) and ``collapsed`` (kept words
    joined by one space; empty for null, empty or blank texts). Other columns of ``docs`` are not carried, so
    names that clash with these do no harm. Repeated rows give repeated results. Texts of any length are taken
    whole.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    # Python work per text is heavy: deal the rows evenly over all tasks, whatever the files' row groups are
    rows = rows.repartition(max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), cores(docs)))
    schema = f"key {docs.schema[key].dataType.simpleString()}, n_words long, runs {RUN_TYPE}, collapsed string"

    def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [_text_runs(t, min_length, min_exponent) for t in batch["text"].tolist()]
            yield pd.DataFrame({
                "key": batch["key"],
                "n_words": [o[0] for o in out],
                "runs": [[{"start": s, "length": ln, "period": p} for s, ln, p in o[1]] for o in out],
                "collapsed": [o[2] for o in out],
            })

    return rows.mapInPandas(per_batch, schema).withColumnRenamed("key", key)


def planted_periods(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Texts of which one in ten ends in a repeated stretch, chosen by the checksum of the id.

    Let ``h`` be crc32 of the decimal id and ``g = h div 10``. If ``h % 10 = 0`` and the text has ``n > 0``
    words, word ``i >= a`` becomes original word ``a + (i - a) % p``, with ``a = g % n`` and
    ``p = 1 + (n - a) div (3 + g % 8)``; such texts are rejoined by one space. Other rows, null ids and null
    texts stay as they are. Built-in functions only.
    """
    taken = set(docs.columns)
    w, a, p, h = (next(f"_{name}{i}" for i in range(len(taken) + 1) if f"_{name}{i}" not in taken) for name in "wapH")
    words = F.regexp_extract_all(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(_WORD.pattern), F.lit(0))
    checksum = F.crc32(F.col(key).cast("string"))
    g = F.floor(checksum / 10)
    n = F.size(w)
    # the words are split once per row; the lambda below only reads the column
    staged = docs.withColumn(w, words).withColumn(h, checksum).withColumn(a, F.when(n > 0, g % n)).withColumn(
        p, 1 + F.floor((n - F.col(a)) / (3 + g % 8))
    )
    moved = F.transform(w, lambda x, i: F.when(i >= F.col(a), F.element_at(F.col(w), (F.col(a) + (i - F.col(a)) % F.col(p) + 1).cast("int"))).otherwise(x))
    planted = staged.withColumn(text, F.when((F.col(h) % 10 == 0) & (n > 0), F.array_join(moved, " ")).otherwise(F.col(text)))
    return planted.drop(w, a, p, h)


def _ratio_first(x, y):
    """Order of runs: greater length over period first (exact, by cross products), then smaller start, period."""
    left, right = x["length"] * y["period"], y["length"] * x["period"]
    return (F.when(left > right, -1).when(left < right, 1)
            .when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1)
            .when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0))


def run_digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per text: number of runs, the run of greatest length over period, and digests of all runs and of the collapsed text.

    ``runs_sha256`` hashes ``start,length,period`` and a line feed per run, by start, then period (the hash of
    the empty string without runs); ``collapsed_sha256`` the collapsed text in UTF-8. Without runs, start,
    length, period and exponent_milli are null.
    """
    best = F.element_at(F.array_sort("runs", _ratio_first), 1)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda s: F.concat(s, F.lit("\n"))), "")
    return found.select(
        F.col(key),
        F.size("runs").cast("long").alias("n_runs"),
        F.when(F.size("runs") > 0, best["start"]).alias("start"),
        F.when(F.size("runs") > 0, best["length"]).alias("length"),
        F.when(F.size("runs") > 0, best["period"]).alias("period"),
        F.when(F.size("runs") > 0, F.floor(best["length"] * 1000 / best["period"]).cast("long")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
