"""Counts against plain Python, thresholds against sorting."""

import math
import re
from collections import defaultdict

import pytest

from trendloom.llm import quality as q

SCHEMA = "doc_id long, text string, lang string, source string, n_words string, kept int"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    many = defaultdict(int)
    for w in windows:
        many[w] += 1
    inside = {k + j for k, w in enumerate(windows) if many[w] > 1 for j in range(3)}
    lines, seen, again = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)], set(), 0
    for line in lines:
        again += line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside), len(lines)


def brute(texts):
    rows = []
    for d, t, lang, source in texts:
        n, chars, symbols, dup, rep, lines = counts(t)
        fails = n < 50 or 100 * rep > 50 * n
        shares = {"word_length": chars / max(n, 1), "symbol_share": symbols / max(chars, 1), "dup_line_share": dup / max(lines, 1),
                  "repeat_share": rep / max(n, 1)}
        rows.append((d, lang, source, (n, chars, symbols, dup, rep), fails, shares))
    groups = defaultdict(list)
    for row in rows:
        if not row[4]:
            groups[row[1], row[2]].append(row)
            groups[row[1],].append(row)
            groups[()].append(row)

    def quantile(group, name, share):
        values = sorted(r[5][name] for r in group)
        return values[max(math.ceil(share * len(values)) - 1, 0)]

    out = []
    for d, lang, source, figures, fails, shares in rows:
        kept = not fails
        for key in ((lang, source), (lang,), ()):
            if kept and len(groups[key]) >= (q.MIN_GROUP if key else 0):
                for name, (slack, below) in q.FIGURES.items():
                    low, high = quantile(groups[key], name, 0.25), quantile(groups[key], name, 0.75)
                    reach = max(q.RANGES * (high - low), slack)
                    kept &= not (shares[name] > high + reach or (below and shares[name] < low - reach))
                break
        out.append((d, *figures, fails, kept))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_defined_cases(spark):
    texts = [
        (1, None), (2, ""), (3, " \n\t"), (4, "a b c a b c"), (5, "a a a a"), (6, "a b"), (7, "x y z " * 30_000), (8, "one\none\n\n \none"),
        (9, "#*$ %&|<> été 漢字 𝄞"), (10, "a\x0bb\x0cc\rd\x1ce\xa0f"), (None, "w " * 60), (4, "a b c a b c"), (11, "b c d b c x a b c d"),
        (12, " ".join(f"w{k}" for k in range(60))),
    ]
    rows = [(d, t, None if d == 2 else "en", None, "n", 0) for d, t in texts]
    assert found(q.quality_report(spark.createDataFrame(rows, SCHEMA))) == brute([r[:4] for r in rows])
    assert q.quality_report(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("least", [5, 50])
def test_whole_table(spark, sf_dir, monkeypatch, least):
    monkeypatch.setattr(q, "MIN_GROUP", least)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    assert found(q.quality_report(docs, least=least)) == brute(texts)


def test_no_python_in_the_plan(spark, sf_dir):
    plan = q.quality_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
