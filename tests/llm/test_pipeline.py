"""The pipeline stage by stage on the rows its predecessor kept."""

from collections import Counter

from tests.llm import test_exact_dedup, test_jaccard_join, test_mixing, test_packing
from tokenizers import Tokenizer

import corpus_pipeline
from trendloom.llm.language import words_of
from trendloom.llm.shared import written
from trendloom.llm.tokens import default_tokenizer


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, results, before = docs.columns, [], docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = written(stage(spark, before, sf_dir))
        results.append(after.collect())
        assert k == 4 or after.columns == columns
        before = after
    texts = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    ids = [[r.doc_id for r in rows] for rows in results[:4]]
    assert sorted(ids[0]) == sorted(d for d, (t, _) in texts.items() if words_of(t))
    kept = [r[0] for r in test_exact_dedup.brute([(d, texts[d][0]) for d in ids[0]]) if r[3]]
    assert sorted(ids[1]) == sorted(kept)
    groups = test_jaccard_join.brute([(d, texts[d][0]) for d in ids[1]])
    assert sorted(ids[2]) == sorted(d for d, n, component in groups if n == 0 or d == component)
    mix = test_mixing.brute([(d, *texts[d]) for d in ids[2]])
    assert Counter(ids[3]) == Counter({d: k // n for d, _, n, _, _, k in mix if n and k})
    test_packing.check(results[4], [(d, texts[d][0]) for d in ids[3]], Tokenizer.from_file(default_tokenizer()), 4096)


def test_columns_with_clashing_names(spark):
    docs = spark.createDataFrame(
        [(k, f"the words of number {k} and of nothing", "en", "s", 1, "x", 2) for k in range(30)],
        "doc_id long, text string, lang string, source string, n_chars int, key string, component int",
    )
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs_after = stage(spark, docs, "")
        assert docs_after.columns == docs.columns
        docs = written(docs_after)
    assert docs.count() > 0


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, ""))
        assert docs.count() == 0
