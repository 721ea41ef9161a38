"""Periodic runs against a plain scan of every period, and the whole query against a plain version of it."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from trendloom.llm.periodic import find_runs, periodic_runs, planted_periods, run_digest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, least=3):
    n, out = len(words), set()
    for q in range(1, n // least + 1):
        k = 0
        while k < n - q:
            if words[k] != words[k + q]:
                k += 1
                continue
            a = k
            while k < n - q and words[k] == words[k + q]:
                k += 1
            length = k - a + q
            smaller = any(q % p == 0 and all(words[j] == words[j + p] for j in range(a, a + length - p)) for p in range(1, q))
            if length >= least * q and not smaller:
                out.add((a, length, q))
    return sorted(out, key=lambda r: (r[0], r[2], r[1]))


def brute_query(rows):
    out = []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        n = len(words)
        if doc_id is not None and n:
            h = zlib.crc32(str(doc_id).encode())
            g = h // 10
            if h % 10 == 0:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = [r for r in brute_runs(words) if r[1] >= 24]
        gone = {i for s, ln, p in runs for i in range(s + p, s + ln)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        listed = "".join(f"{s},{ln},{p}\n" for s, ln, p in runs)
        figures = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        out.append((doc_id, len(runs), *figures, hashlib.sha256(listed.encode()).hexdigest(),
                    hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def planted_ids(count):
    return [d for d in range(100000) if zlib.crc32(str(d).encode()) % 10 == 0][:count]


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(300):
        n = rng.randint(0, 150)
        alphabet = rng.choice([1, 2, 3, 4, 30])
        ids = [rng.randrange(alphabet) for _ in range(n)]
        if n > 8 and rng.random() < 0.7:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 3))
            ids = ids[:a] + [ids[a + (i - a) % p] for i in range(a, n)]
        assert find_runs(np.array(ids, dtype=np.int64)) == brute_runs(ids)


def test_long_and_uniform_texts():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 5000, 20000)
    tiled = np.concatenate([base[:3000], np.tile(base[3000:4100], 15)])
    assert find_runs(tiled) == [(3000, len(tiled) - 3000, 1100)]
    assert find_runs(np.zeros(30000, dtype=np.int64)) == [(0, 30000, 1)]
    assert find_runs(np.array([], dtype=np.int64)) == []


def test_query_equals_brute_force(spark):
    rng = random.Random(7)
    vocab = [f"w{k}" for k in range(12)] + ["é", "日本", "x"]
    ids = planted_ids(14)
    rows = [(d, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 300)))) for d in ids]
    rows += [(d + 1, " ".join(rng.choice(vocab[:3]) for _ in range(rng.randint(20, 200)))) for d in ids[:6]]
    rows += [(ids[0], rows[0][1]), (None, "a b " * 40), (5, None), (6, ""), (7, " \t\n"), (ids[1], "solo"),
             (8, "la la la\x0bla la\tla " * 20), (9, "abc " * 20000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = run_digest(periodic_runs(planted_periods(docs))).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_query(rows)


def test_runs_of_operator_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b " * 30 + "end", "x", 1, "y")], "doc_id long, text string, key string, runs int, collapsed string")
    row = periodic_runs(docs).collect()[0]
    assert row.doc_id == 1 and row.n_words == 61
    assert [tuple(r) for r in row.runs] == [(0, 60, 2)]
    assert row.collapsed == "a b end"


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert run_digest(periodic_runs(planted_periods(docs))).count() == 0
