"""Copies against a dictionary of texts, also with digests that clash."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from trendloom.llm.exact_dedup import CHUNK, clashing_chunks, content_chunks, drop_exact_copies, exact_groups

SCHEMA = "doc_id long, text string, digest string, recipe int, source string"
LONG = ("A sentence of some length that ends here. " * 200 + "\n") * 3
TEXTS = [
    (1, "same"), (5, "same"), (3, "same"), (2, None), (4, ""), (6, "Same"), (7, LONG), (8, LONG), (9, LONG[:-1]),
    (10, "x" + LONG), (11, "z" * 20_000), (12, "z" * 20_000), (13, "z" * 19_999), (14, "\n" * 5000), (None, "same"),
    (None, "alone"), (20, "twice"), (20, "twice"), (21, "same "), (20, "other"),
]


def make(spark, texts):
    return spark.createDataFrame([(d, t, "q", 1, "s") for d, t in texts], SCHEMA)


def brute(texts):
    groups = defaultdict(list)
    for d, t in texts:
        groups[t or ""].append(d)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        kept = False
        for d in ids:
            stays = d == keep and not kept
            kept |= stays
            out.append((d, keep, len(ids), stays, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("digest", [F.xxhash64, lambda c: F.length(c).cast("bigint"), lambda c: F.lit(7).cast("bigint")])
def test_groups(spark, digest):
    docs = make(spark, TEXTS)
    assert found(exact_groups(docs, digest)) == brute(TEXTS)
    kept = drop_exact_copies(docs, digest)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=str) == sorted(
        ((d, t) for d, t in {(r[0], next(x or "" for y, x in TEXTS if hashlib.sha256((x or "").encode()).hexdigest() == r[4]))
                             for r in brute(TEXTS) if r[3]}), key=str)


def test_chunks_join_to_the_text(spark):
    rows = make(spark, [t for t in TEXTS if t[1]]).select("text", F.array_join(content_chunks(F.col("text")), "").alias("joined")).collect()
    assert all(r.text == r.joined for r in rows)
    assert all(len(c) <= 8192 for _, t in TEXTS for c in re.findall(CHUNK, t or ""))


def test_behind_an_insertion_the_chunks_are_the_same():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdehilmnorst") for _ in range(rng.randint(2, 9))) for _ in range(500)]
    whole = "".join(" ".join(rng.choices(words, k=rng.randint(3, 12))) + rng.choice([". ", ".\n"]) for _ in range(3000))
    one, other = re.findall(CHUNK, whole), re.findall(CHUNK, "Something new in front of it. " + whole)
    assert len(one) > 50 and len(set(one) - set(other)) <= 5


def test_clashing_digests_are_told_apart(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (2, "c"), (2, "c")], "digest long, chunk string")
    assert sorted(tuple(r) for r in clashing_chunks(rows).collect()) == [(1, "a", 1), (1, "b", 2)]


def test_empty_table(spark):
    assert exact_groups(make(spark, [])).count() == 0
    assert drop_exact_copies(make(spark, [])).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    plan = exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
