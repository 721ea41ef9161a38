"""Links and components against a comparison of all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest

from trendloom.llm import jaccard_join as jj

SCHEMA = "doc_id long, text string, key string, n int, chunk int"


def shingles(text):
    words = (text or "").encode().lower().split()
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute(texts):
    sets = [(d, shingles(t)) for d, t in texts]
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in combinations(range(len(sets)), 2):
        one, other = sets[a][1], sets[b][1]
        if one and other and 100 * len(one & other) >= 75 * len(one | other):
            parent[root(a)] = root(b)
    least = {}
    for k, (d, _) in enumerate(sets):
        least[root(k)] = min(least.get(root(k), d), d)
    return sorted((d, len(s), least[root(k)]) for k, (d, s) in enumerate(sets))


def found(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def make(spark, texts):
    return spark.createDataFrame([(d, t, "x", 0, 1) for d, t in texts], SCHEMA)


def near_copies(rng, count, bases):
    texts = []
    for doc_id in rng.sample(range(10_000), count):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5, 8])):
            words[rng.randrange(len(words))] = f"e{rng.randint(0, 5)}"
        cut = rng.choice([0, 0, rng.randint(0, max(1, len(words) // 4))])
        texts.append((doc_id, " ".join(words[cut:])))
    return texts


def test_edge_cases(spark):
    texts = [
        (7, "One two three four five six"), (3, "one TWO three four five six"), (4, "one  two three\nfour five six"),
        (8, None), (2, ""), (1, " "), (12, "a b"), (11, "A b"), (13, "a b c"), (20, "spam " * 4000), (21, "spam " * 10),
        (30, "É a b c d"), (31, "é a b c d"), (5, "one two three four five six"), (5, "one two three four five six"),
    ]
    assert found(jj.linked_documents(make(spark, texts), chunk_chars=50)) == brute(texts)
    rows = jj.linked_documents(make(spark, [(None, "x y z"), (None, None), (4, "x y z")])).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in rows) == [
        ("4", 1, 4), ("None", 0, None), ("None", 1, 4),
    ]
    kept = jj.one_of_each_component(make(spark, texts))
    assert kept.columns == ["doc_id", "text", "key", "n", "chunk"]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 8, 11, 13, 20, 30, 31]


def test_null_ids_and_ids_of_several_texts(spark):
    words = [f"w{k}" for k in range(60)]
    near = [" ".join(words[k:] + [f"x{j}" for j in range(k)]) for k in (0, 7, 14)]  # each linked to the next only
    rows = [(5, near[0]), (None, near[1]), (9, near[2]), (7, "another text of six words"), (7, near[2] + " y"),
            (None, "no id here at all now a b c d e f g h i j"), (None, "no id here at all now a b c d e f g h i j k")]
    got = jj.linked_documents(make(spark, rows), chunk_chars=50).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == sorted([
        ("5", "5"), ("None", "5"), ("9", "5"), ("7", "7"), ("7", "5"), ("None", "None"), ("None", "None"),
    ])
    kept = [(r.doc_id, r.text) for r in jj.one_of_each_component(make(spark, rows), chunk_chars=50).collect()]
    assert len(kept) == 3 and {rows[0], rows[3]} < set(kept) and set(kept) & set(rows[5:])


def test_texts_without_id_are_dealt_to_many_chunks(spark):
    dealt = jj.dealt_texts(make(spark, [(None, f"text {k}") for k in range(200)]), 8).groupBy("chunk").count().collect()
    assert len(dealt) == 8 and max(r["count"] for r in dealt) < 60


def test_empty_table(spark):
    assert jj.linked_documents(make(spark, [])).count() == 0


@pytest.mark.parametrize("seed,frequent", [(1, 32), (2, 3), (3, 1)])
def test_near_copies(spark, monkeypatch, seed, frequent):
    monkeypatch.setattr(jj, "FREQUENT", frequent)
    monkeypatch.setattr(jj, "TILE", 5 * frequent)
    monkeypatch.setattr(jj, "TILE_SHINGLES", 16 * frequent)
    rng = random.Random(seed)
    bases = [[f"w{rng.randint(0, 60)}" for _ in range(rng.choice([4, 6, 12, 30, 80]))] for _ in range(10)]
    texts = near_copies(rng, 150, bases)
    assert found(jj.linked_documents(make(spark, texts), chunk_chars=2000)) == brute(texts)


def test_linked_sets_share_a_signature():
    rng = random.Random(5)
    for trial in range(400):
        n = rng.choice([2, 3, 4, 5, 8, 20, 60, 150, 400])
        base = [rng.getrandbits(64) for _ in range(n)]
        kind = {}

        def draw(tokens):
            return np.array(sorted(tokens), np.uint64), np.array([kind[t] for t in sorted(tokens)], np.uint8)

        missing = rng.randint(0, jj.allowed_missing(n))
        one, other = set(base), set(base[missing:])
        other |= {rng.getrandbits(64) for _ in range(rng.randint(0, n // 3))}
        share = rng.random()
        for t in one | other:
            kind[t] = jj.UNIQUE if not (t in one and t in other) and rng.random() < 0.5 else (
                jj.COMMON if rng.random() < share else jj.RARE)
        if 100 * len(one & other) < 75 * len(one | other):
            continue
        assert set(jj.signatures(*draw(one)).tolist()) & set(jj.signatures(*draw(other)).tolist())


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(jj.linked_documents(docs, chunk_chars=50_000)) == brute(texts)
