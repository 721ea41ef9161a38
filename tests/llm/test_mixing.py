"""Targets by repeated sharing, thresholds by sorting."""

import hashlib
import random
from collections import defaultdict
from fractions import Fraction

import pytest

from trendloom.llm.mixing import mix_documents, mix_report

SCHEMA = "doc_id long, text string, source string, h int, budget int"


def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in capped]
        shared = sum(weight[s] for s in rest)
        share = {s: Fraction((total - sum(capped.values())) * weight[s], shared) for s in rest} if shared else {}
        over = [s for s in rest if share[s] > 3 * sizes[s]]
        if not over:
            return {**capped, **share}
        capped.update({s: 3 * sizes[s] for s in over})


def place(doc_id):
    text = "mix" if doc_id is None else f"mix|{doc_id}"
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def brute(texts):
    rows = [(d, s, len((t or "").encode().split()), place(d)) for d, t, s in texts]
    sizes = defaultdict(int)
    for _, s, n, _ in rows:
        sizes[s] += n
    goal, out = targets(dict(sizes)), []
    for source in sizes:
        whole = int(goal[source] // sizes[source]) if sizes[source] else 0
        budget = goal[source] - whole * sizes[source]
        by_hash = defaultdict(int)
        for _, s, n, h in rows:
            if s == source:
                by_hash[h] += n
        cut, through = 0, 0
        for h in sorted(by_hash):
            if through + by_hash[h] >= budget:
                if budget > 0 and through + by_hash[h] - budget < budget - through:
                    cut = h + 1
                else:
                    cut = h
                break
            through += by_hash[h]
        cut = cut if budget > 0 else 0
        out += [(d, s, n, sizes[s], float(goal[s]), n * (whole + (h < cut))) for d, s, n, h in rows if s == source]
    return sorted(out, key=str)


def make(spark, texts):
    return spark.createDataFrame([(d, t, s, 1, 2) for d, t, s in texts], SCHEMA)


def texts(seed, sources, count):
    rng = random.Random(seed)
    return [(k, "w " * rng.choice([0, 1, 5, 50, 300]), rng.choice(sources)) for k in range(count)]


@pytest.mark.parametrize("rows", [
    texts(1, ["a", "b", "c", None, "é", "Z"], 300),
    texts(2, ["big"] * 30 + ["small", None], 200),
    [(1, "one", "a"), (1, "one", "a"), (None, "x y", None), (None, None, "b"), (3, "", "c")],
    [(1, None, "a"), (2, " ", None)],
])
def test_like_sorting(spark, rows):
    docs = make(spark, rows)
    got = sorted((tuple(r) for r in mix_report(docs).collect()), key=str)
    want = brute(rows)
    assert [g[:4] + g[5:] for g in got] == [w[:4] + w[5:] for w in want]
    assert all(abs(g[4] - w[4]) <= 1e-9 * max(1, w[4]) for g, w in zip(got, want))
    assert all(g[5] <= 3 * g[2] for g in got)
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns
    times = defaultdict(int)
    for r in mixed.collect():
        times[r.doc_id, r.source] += len((r.text or "").split())
    for d, s in {(g[0], g[1]) for g in got}:
        assert times[d, s] == sum(g[5] for g in got if (g[0], g[1]) == (d, s))


def test_empty_table(spark):
    assert mix_report(make(spark, [])).count() == 0 and mix_documents(make(spark, [])).count() == 0


def test_reruns_agree_and_targets_are_near(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one = sorted(map(tuple, mix_report(docs).collect()))
    assert one == sorted(map(tuple, mix_report(docs.repartition(5)).collect()))
    taken, longest = defaultdict(int), defaultdict(int)
    for _, s, n, _, t, k in one:
        taken[s, t] += k
        longest[s] = max(longest[s], n)
    assert all(abs(k - t) <= longest[s] for (s, t), k in taken.items())
