"""Labels against a plain dynamic program; predictions on held-out documents; spans of mixed texts."""

import zlib
from itertools import product

import numpy as np
import pytest

from trendloom.llm import language as lg

SCHEMA = "doc_id long, text string, lang string, source string, score int"


def value(scores, labels, penalty):
    return sum(scores[t, k] for t, k in enumerate(labels)) - penalty * sum(a != b for a, b in zip(labels, labels[1:]))


def test_best_labels_against_all_labellings():
    rng = np.random.default_rng(4)
    for trial in range(300):
        n, k = rng.integers(1, 7), rng.integers(1, 4)
        scores = -rng.integers(0, 7, (n, k)).astype(float)
        penalty = float(rng.integers(1, 6))
        best = max(value(scores, labels, penalty) for labels in product(range(k), repeat=n))
        assert value(scores, lg.best_labels(scores, penalty).tolist(), penalty) == pytest.approx(best)


def test_two_languages_without_the_best_single_one():
    scores = np.array([[0.0, -6.0, -2.0], [-6.0, 0.0, -2.0]])
    assert lg.best_labels(scores, 3.0).tolist() == [0, 1]
    rng = np.random.default_rng(6)
    for _ in range(300):
        n = int(rng.integers(2, 7))
        half = -np.minimum(rng.integers(0, 9, (n, 4)), 6).astype(float)
        half[: n // 2, 0], half[n // 2 :, 1] = 0, 0
        best = max(value(half, labels, 4.0) for labels in product(range(4), repeat=n))
        assert value(half, lg.best_labels(half, 4.0).tolist(), 4.0) == pytest.approx(best)


def test_grams_belong_to_their_words():
    words = ["ab", "c", "été"]
    cells, owners, script = lg.grams_of(words)
    # Per word of m letters: m single letters, m + 1 pairs and m triples, spaces around it included.
    assert [int((owners == k).sum()) for k in range(3)] == [2 + 3 + 2, 1 + 2 + 1, 3 + 4 + 3]
    for k, w in enumerate(words):
        alone = lg.grams_of([w])[0]
        assert sorted(alone.tolist()) == sorted(cells[owners == k].tolist())
    assert {lg.SCRIPT_NAMES[s] for s in script} == {"latin"}


@pytest.fixture(scope="module")
def big_dir(sf_dir):
    return sf_dir.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def model(spark, big_dir):
    return lg.train(spark.read.parquet(f"{big_dir}/documents.parquet"))


def test_held_out_documents(spark, big_dir):
    docs = spark.read.parquet(f"{big_dir}/documents.parquet")
    truth = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    rows = lg.language_report(docs).collect()
    assert len(rows) == len(truth)
    right = total = 0
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if r.held_out:
            total += 1
            right += r.lang_pred == truth[r.doc_id][0]
    assert total > 100 and right / total >= 0.97


def test_defined_cases(spark, model):
    texts = [(1, None), (2, ""), (3, "123 456 !!"), (4, "漢字"), (None, "the and of that"), (6, "the " * 30_000), (4, "漢字")]
    docs = spark.createDataFrame([(d, t, None, None, 9) for d, t in texts], SCHEMA)
    rows = lg.identify(docs, model).collect()
    assert [r["_lang_pred"] for r in rows[:3]] == ["und"] * 3 and [r["_lang_score"] for r in rows[:3]] == [0.0] * 3
    assert rows[3]["_lang_pred"] in model.languages and rows[3]["_lang_score"] <= 0.5
    assert rows[4]["_lang_pred"] == "en" and rows[5]["_lang_pred"] == "en"
    labelled = [(k, "the of and", "en", "s", 1) for k in range(100, 110)]
    kept = lg.keep_identified(docs.unionAll(spark.createDataFrame(labelled, SCHEMA)))
    assert kept.columns == docs.columns and kept.count() == 14
    assert lg.keep_identified(docs).count() == 4


def test_without_labels_and_rows(spark):
    docs = spark.createDataFrame([(1, "the and", None, "s", 1)], SCHEMA)
    assert [(r.lang_pred, r.score) for r in lg.language_report(docs).collect()] == [("und", 0.0)]
    assert lg.language_report(docs.where("doc_id > 5")).count() == 0


def test_spans_of_a_mixed_text(spark, big_dir, model):
    docs = spark.read.parquet(f"{big_dir}/documents.parquet").where("n_chars between 500 and 3000")
    first = {lang: docs.where(f"lang = '{lang}'").orderBy("doc_id").first().text for lang in ("en", "de")}
    en, de = (" ".join(lg.words_of(first[k])[:80]) for k in ("en", "de"))
    row = lg.identify(spark.createDataFrame([(1, f"{en} {de}", None, None, 0)], SCHEMA), model).first()
    spans = [s for s in row["_lang_spans"] if s["words"] > 20]
    assert [s["lang"] for s in spans] == ["en", "de"] and abs(spans[1]["first"] - 80) <= 5


def test_training_never_sees_held_out_rows(spark):
    rows = [(k, "aaa" if zlib.crc32(str(k).encode()) % 4 != 2 else "zzz", "x" if zlib.crc32(str(k).encode()) % 4 != 2 else "y", "s", 0)
            for k in range(200)]
    assert lg.train(spark.createDataFrame(rows, SCHEMA)).languages == ("x",)


def test_ngrams_of_many_texts_are_counted_in_bounded_portions(spark, monkeypatch):
    """All texts of a batch were once turned into arrays together; their counts are the same in portions."""
    rows = [(k, "wort für wort und noch eins " * 40 if k % 2 else "word by word and one more " * 40, "de" if k % 2 else "en", "s", 0) for k in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    whole = lg.train(docs)
    grams_of, limit = lg.grams_of, 500

    def guarded(words):
        assert sum(map(len, words)) <= 2 * limit + 10, "too many letters in arrays at once"
        return grams_of(words)

    monkeypatch.setattr(lg, "LETTERS_AT_ONCE", limit)
    monkeypatch.setattr(lg, "portions", lambda words, letters=limit, cut=lg.portions: cut(words, letters))
    monkeypatch.setattr(lg, "grams_of", guarded)
    parts = lg.train(docs)
    assert parts.languages == whole.languages
    assert (parts.scores == whole.scores).all() and (parts.allowed == whole.allowed).all()
    words = sorted({w for r in rows for w in lg.words_of(r[1])}) * 300
    assert (parts.word_scores(words) == np.tile(whole.word_scores(words[: len(words) // 300]), (300, 1))).all()


def test_known_words_are_bounded_by_bytes(spark, monkeypatch):
    rows = [(k, f"der die das wort{chr(97 + k % 26)} und" if k % 2 else f"the a of word{chr(97 + k % 26)} and", "de" if k % 2 else "en", "s", 0) for k in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    columns = ["doc_id", "held_out", "lang_pred", "score", "n_spans"]
    before = sorted(lg.language_report(docs).select(*columns).collect())
    monkeypatch.setattr(lg, "TABLE_BYTES", 64)
    assert sorted(lg.language_report(docs).select(*columns).collect()) == before
