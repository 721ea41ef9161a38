"""Licence notices against exact containment in every window of a text."""

import random

import numpy as np
import pytest

from trendloom.llm.license_texts import TEMPLATES
from trendloom.llm.licenses import (
    CONTAINMENT, SHINGLE, LengthClass, TemplateIndex, plain_words, scan_licenses, shingle_set, window_minima,
)

SCHEMA = "doc_id long, text string, license string, n_words int"
FILLER = [f"word{k}" for k in range(300)]


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def brute(texts, templates):
    """(doc_id, license) where some window as long as the template holds 0.75 of its shingles."""
    out = set()
    for d, t in texts:
        words = plain_words(t)
        k = min(SHINGLE, len(words))
        places = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)] if words else []
        for name, template in templates:
            wanted = shingle_set(plain_words(template))
            length = len(plain_words(template)) - SHINGLE + 1
            if wanted and any(
                len(set(places[i : i + max(length, 1)]) & wanted) >= CONTAINMENT * len(wanted) for i in range(len(places))
            ):
                out.add((d, name))
    return out


def test_defined_cases(spark):
    notice = TEMPLATES["mit-notice"]
    texts = [
        (1, None), (2, ""), (3, " \n"), (4, "Released under the MIT License."), (5, "x RELEASED\nunder  the (MIT) license, y"),
        (None, notice), (7, "a " * 40_000 + notice + " b" * 40_000), (8, "permission is hereby granted to nobody"), (4, "Released under the MIT License."),
        (9, "licensed under cc by-nc 4.0"),
    ]
    docs = spark.createDataFrame([(d, t, "l", 1) for d, t in texts], SCHEMA)
    rows = found(scan_licenses(docs, sorted(TEMPLATES.items())))
    assert rows == sorted([
        (4, "mit-line", 1.0, 0, 5), (4, "mit-line", 1.0, 0, 5), (5, "mit-line", 1.0, 1, 5), (9, "cc-by-nc-4.0-line", 1.0, 0, 5),
        (None, "mit-notice", 1.0, 0, len(plain_words(notice))), (7, "mit-notice", 1.0, 40_000, len(plain_words(notice))),
    ], key=str)
    assert found(scan_licenses(docs, [])) == [] and found(scan_licenses(docs, [("none", " .. ")])) == []
    assert scan_licenses(docs.where("doc_id > 100"), sorted(TEMPLATES.items())).count() == 0


def test_altered_notices(spark):
    rng, texts = random.Random(6), []
    for doc_id in range(300):
        words = TEMPLATES[rng.choice(sorted(TEMPLATES))].split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            words[rng.randrange(len(words))] = "changed"
        texts.append((doc_id, " ".join(rng.choices(FILLER, k=rng.randint(0, 200)) + words + rng.choices(FILLER, k=rng.randint(0, 200)))))
    docs = spark.createDataFrame([(d, t, "l", 1) for d, t in texts], SCHEMA)
    templates = sorted(TEMPLATES.items())
    got = {(r.doc_id, r.license) for r in scan_licenses(docs, templates).collect()}
    want = brute(texts, templates)
    assert want <= got and len(got - want) <= len(want) // 20


def test_slices_of_templates_change_nothing(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    whole = found(scan_licenses(docs, sorted(TEMPLATES.items())))
    monkeypatch.setattr("trendloom.llm.licenses.TEMPLATES_AT_ONCE", 3)
    assert found(scan_licenses(docs, sorted(TEMPLATES.items()))) == whole and whole
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r[:2] for r in whole} == brute(texts, sorted(TEMPLATES.items()))


@pytest.mark.parametrize("least", [1, 2, 4, 8, 32])
def test_windows_cover_every_run(least):
    kind = LengthClass(least)
    values = np.arange(200, dtype=np.uint64)[::-1].copy()
    minima = window_minima(values, kind)
    for start in range(200 - 2 * least):
        inside = [w for w in range(len(minima)) if w * kind.stride <= start and start + 2 * least - 1 <= (w + kind.strides) * kind.stride]
        assert inside
    assert minima.tolist() == [values[w * kind.stride : (w + kind.strides) * kind.stride].min() for w in range(len(minima))]


def test_bands_miss_rarely():
    rng, missed = random.Random(1), 0
    template = [f"t{k}" for k in range(40)]
    index = TemplateIndex([("t", " ".join(template))])
    from trendloom.llm.word_hashes import WordHasher, shingle_hashes

    for trial in range(300):
        words = [f"{trial}x{k}" for k in range(100)] + template[: 4 + 27] + [f"{trial}y{k}" for k in range(rng.randint(1, 100))]
        missed += not index.candidates(shingle_hashes(WordHasher()([w.encode() for w in words])))
    assert missed == 0
