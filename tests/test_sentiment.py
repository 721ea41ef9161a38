import math
import re

import pytest
from pyspark.sql import functions as F

from trendloom.operators.sentiment import compound_sentiment

LEXICON = [
    ("good", 1.9), ("great", 3.1), ("bad", -2.5), ("crashed", -1.8), ("happy", 2.7), ("tension", -1.3),
    ("no", -1.2), (":)", 2.0), ("kind", 2.4), ("bomb", -2.2), ("ass", -2.5),
]


def norm(total):
    return round(total / math.sqrt(total * total + 15), 4)


CASES = {
    "plain text": 0.0,
    "": 0.0,
    "a good day": norm(1.9),
    "a good, day": norm(1.9),
    "very good": norm(1.9 + 0.293),
    "VERY good": norm(1.9 + 0.293 + 0.733),
    "very nice good": norm(1.9 + 0.293 * 0.95),
    "very nice old good": norm(1.9 + 0.293 * 0.9),
    "very bad": norm(-2.5 - 0.293),
    "slightly bad": norm(-2.5 + 0.293),
    "not good": norm(1.9 * -0.74),
    "isn't good": norm(1.9 * -0.74),
    "not very good": norm((1.9 + 0.293) * -0.74),
    "it is GOOD": norm(1.9 + 0.733),
    "GOOD": norm(1.9),
    "good but bad": norm(1.9 * 0.5 - 2.5 * 1.5),
    "good!": norm(1.9 + 0.292),
    "good !!!!!!": norm(1.9 + 4 * 0.292),
    "bad ??": norm(-2.5 - 0.36),
    "bad ????": norm(-2.5 - 0.96),
    "what ??": 0.0,
    "least good": norm(1.9 * -0.74),
    "at least good": norm(1.9),
    "never so good": norm((1.9 + 0.293) * 1.5),
    "kind of good": norm(1.9),
    "that is kind of good": norm(1.9 - 0.293),
    "it was really the bomb": norm(3.0),
    "no good": norm(-1.2 + 1.9),
    ":) day": norm(2.0),
    "kindof good": norm(1.9 - 0.293),
    "sortof bad": norm(-2.5 + 0.293),
    "very good and good": norm(2 * (1.9 + 0.293)),
    "good and very good": norm(2 * 1.9),
    "very good but good": norm((1.9 + 0.293) * (0.5 + 1.5)),
    "great happy good great happy good great happy good": norm(23.1),
}


def test_rules(spark):
    lexicon = spark.createDataFrame(LEXICON, "token string, valence double")
    texts = spark.createDataFrame(list(enumerate(CASES)), "title_id long, text string")
    found = {r.title_id: r.compound for r in compound_sentiment(texts, lexicon).collect()}
    named = {text: found[k] for k, text in enumerate(CASES)}
    assert named == pytest.approx(CASES, abs=1e-4)


def test_null_text_and_bounds(spark):
    lexicon = spark.createDataFrame(LEXICON, "token string, valence double")
    texts = spark.range(1).select(F.col("id").alias("title_id"), F.lit(None).cast("string").alias("text"))
    assert compound_sentiment(texts, lexicon).first().compound == 0.0
    loud = spark.range(1).select(F.col("id").alias("title_id"), F.repeat(F.lit("bad "), 5000).alias("text"))
    assert -1.0 <= compound_sentiment(loud, lexicon).first().compound < -0.99


def test_repeated_tokens_count_once(spark):
    lexicon = spark.createDataFrame([("good", 1.9), ("good", 1.9), ("good", 1.0)], "token string, valence double")
    texts = spark.createDataFrame([(1, "good day")], "title_id long, text string")
    assert compound_sentiment(texts, lexicon).first().compound == pytest.approx(norm(1.9))


def test_lexicon_without_rows(spark):
    lexicon = spark.createDataFrame([], "token string, valence double")
    texts = spark.createDataFrame([(1, "good day")], "title_id long, text string")
    assert compound_sentiment(texts, lexicon).first().compound == 0.0


def test_generated_methods_stay_within_what_the_jvm_compiles(spark):
    lexicon = spark.createDataFrame(LEXICON, "token string, valence double")
    texts = spark.createDataFrame([(1, "never so good but kind of bad")], "title_id long, text string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        scored = compound_sentiment(texts, F.broadcast(lexicon))
        text = spark._jvm.PythonSQLUtils.explainString(scored._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) <= 8000  # longer methods are interpreted for ever
