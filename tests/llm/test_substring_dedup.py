"""Passages against a plain search over all windows."""

import hashlib
import random

import pytest

from trendloom.llm.substring_dedup import WINDOW, drop_repeats

SCHEMA = "doc_id long, text string, chunk int, words string"


def brute(texts):
    first = {}
    split = [(d, (t or "").encode().split()) for d, t in texts]
    for d, words in split:
        for i in range(len(words) - WINDOW + 1):
            key = tuple(words[i : i + WINDOW])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for d, words in split:
        gone = set()
        for i in range(len(words) - WINDOW + 1):
            least = first.get(tuple(words[i : i + WINDOW]))
            if least is not None and (d is None or least < d):
                gone.update(range(i, i + WINDOW))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def make(spark, texts):
    return spark.createDataFrame([(d, t, 1, "x") for d, t in texts], SCHEMA)


def test_edge_cases(spark):
    passage = " ".join(f"p{k}" for k in range(40))
    texts = [
        (5, passage), (3, f"intro words {passage} and an end"), (9, " ".join(passage.split()[7:20])),
        (10, " ".join(passage.split()[7:19])), (None, passage), (None, "one"), (11, None), (12, ""), (13, " \n\t"),
        (14, "spam " * 5000), (15, "spam " * 100), (5, passage), (16, passage + "\x0b" + passage), (17, "a b c"),
    ]
    df = drop_repeats(make(spark, texts), chunk_chars=200, bucket_chars=500)
    assert found(df) == brute(texts)
    whole = {r.doc_id: r for r in df.where("doc_id in (3, 9, 16)").collect()}
    assert whole[9].repeats[0].asDict() == {"first": 0, "words": 13} and whole[9].kept == b""
    assert whole[3].repeats == [] and [x.words for x in whole[16].repeats] == [80]


def test_empty_table(spark):
    assert drop_repeats(make(spark, [])).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(spark, seed):
    rng = random.Random(seed)
    passages = [[f"w{rng.randint(0, 400)}" for _ in range(rng.randint(8, 60))] for _ in range(12)]
    texts = []
    for doc_id in rng.sample(range(1000), 120):
        words = []
        for _ in range(rng.randint(0, 5)):
            part = rng.choice(passages)
            a = rng.randint(0, len(part) - 1)
            words += part[a : a + rng.randint(1, 60)] if rng.random() < 0.7 else [f"x{rng.randint(0, 9)}"] * rng.randint(1, 30)
        texts.append((doc_id, " ".join(words)))
    assert found(drop_repeats(make(spark, texts), chunk_chars=3000, bucket_chars=5000)) == brute(texts)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(drop_repeats(docs, chunk_chars=50_000, with_text=False)) == brute(texts)
