"""Collocations against a plain count of every phrase."""

import random
import re
from collections import Counter

import pytest

from trendloom.llm import collocations as mod
from trendloom.llm.collocations import collocations, frequent_phrases, phrase_pieces

PIECE = re.compile(r"[.,;:!?\x0A-\x0D]")
WORD = re.compile(r"[^\x20\x09]+")


def brute(rows, least=10, top=2000):
    counts, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in PIECE.split(lowered):
            words = WORD.findall(piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    cands = {key: a for key, a in counts.items() if len(key[1]) >= 2 and a >= least}
    out = []
    for (lang, words), a in cands.items():
        covering = [f for (lg, w), f in cands.items() if lg == lang and len(w) == 3 and words in (w[:2], w[1:])]
        if len(words) == 2 and any(100 * f >= 50 * a for f in covering):
            continue
        cuts = [(a * a * 1000000 // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, " ".join(words), a, counts[lang, words[:k]], counts[lang, words[k:]], n[lang], score))
    ranked = []
    for lang in sorted({o[0] for o in out}):
        mine = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))
        ranked += [(o[0], i + 1, *o[1:]) for i, o in enumerate(mine[:top])]
    return sorted(ranked)


def make_rows(seed, docs=60):
    rng = random.Random(seed)
    vocab = ["the", "New", "york", "times", "of", "a", "Zürich", "über", "x\x0by", "ab", "cd", "ef"]
    rows = []
    for d in range(docs):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 120))]
        text = " ".join(w + rng.choice(["", "", "", ".", ",", "\n", "\t", "!"]) for w in words)
        if d % 5 == 0:
            text += " New York Times" * 12
        rows.append((text, rng.choice(["en", "de", None])))
    return rows + [(None, "en"), ("", None), (" . ; ", "de")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = make_rows(seed)
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = sorted(tuple(r) for r in collocations(docs).collect())
    assert got == brute(rows)


def test_small_top_and_sample_misses(spark, monkeypatch):
    rows = make_rows(3, docs=30)
    monkeypatch.setattr(mod, "SAMPLE_RATE", 1 / 4096)  # the sample proposes almost nothing: passes must expand
    docs = spark.createDataFrame(rows, "text string, lang string")
    frequent, _, passes = frequent_phrases(phrase_pieces(docs))
    assert passes >= 2
    got = sorted(tuple(r) for r in collocations(docs, top=5).collect())
    assert got == brute(rows, top=5)


def test_clashing_columns_and_empty(spark):
    rows = [("a b c. " * 12, "en", 1, "x")]
    docs = spark.createDataFrame(rows, "text string, lang string, words int, sampled string")
    got = [tuple(r) for r in collocations(docs).collect()]
    assert got == brute([(t, lg) for t, lg, *_ in rows])
    assert collocations(docs.limit(0)).count() == 0


def test_keys_by_shuffle_join_give_the_same(spark, monkeypatch):
    rows = make_rows(4, docs=30)
    monkeypatch.setattr(mod, "BROADCAST_KEYS", 0)  # no key table is sent to every task
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(tuple(r) for r in collocations(docs).collect()) == brute(rows)


def test_words_proposed_in_vain_admit_no_pairs(spark, monkeypatch):
    """Words of the sample that the full count finds rare were looked up too, so that the keys outgrew the broadcast."""
    monkeypatch.setattr(mod, "SAMPLE_RATE", 1)  # proposes words with 5 occurrences
    rows = [("new york times. " * 12 + "\t rare\tword " * 6, "en")] + [("Ünew YORK. ", "de")] * 11
    asked, admitted = [], mod._admitted

    def recorded(*args):
        asked.append({r.phrase for a in args if hasattr(a, "columns") and "old" in a.columns for r in a.collect()})
        return admitted(*args)

    monkeypatch.setattr(mod, "_admitted", recorded)
    got = sorted(tuple(r) for r in collocations(spark.createDataFrame(rows, "text string, lang string")).collect())
    assert got == brute(rows)
    in_sample, *in_passes = asked
    assert "rare" in in_sample and "york" in in_passes[0]
    assert not any({"rare", "word"} & phrases for phrases in in_passes)


def test_texts_are_hashed_and_pieces_cut_once(spark):
    """A filter on the words cut every piece twice, and the hash of a row was taken again for each of its pieces."""
    docs = spark.createDataFrame([("a b. c", "en")], "text string, lang string")
    plan = phrase_pieces(docs)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    explode = next(i for i, line in enumerate(plan) if "Generate" in line)
    assert not any("Filter" in line and "split(" in line for line in plan[:explode])
    assert not any("xxhash64" in line and "text#" in line for line in plan[:explode])
    assert any("xxhash64" in line and "text#" in line for line in plan[explode:])


def test_blanks_and_letters_of_pieces(spark):
    texts = ["\tNew  York \t times ", " \t ", "ÀB c\t\tÉ ÉA", "İSTANBUL ΑΣ B", " ", "über straße", "..a.  B  ", "a\x0b b"]
    rows = [(text, lang) for text in texts for lang in ("en", None)] * 12
    docs = spark.createDataFrame(rows, "text string, lang string")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want = [WORD.findall(p) for text, _ in rows for p in PIECE.split(text.translate(lower))]
    assert sorted(r.words for r in phrase_pieces(docs).collect()) == sorted(w for w in want if w)
    assert sorted(tuple(r) for r in collocations(docs).collect()) == brute(rows)
