"""Quality rules with thresholds that follow the data, with built-in functions only.

Each text gets a few figures. Quantile sketches of the figures are kept per language and source; they are
merged to sketches per language and of everything for groups too small to speak for themselves. A figure
far outside the middle half of its group fails the text, so no cutoff is fixed for all languages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.llm.shared import SPACE, WORD, cores, written

MIN_WORDS = 50
# Items a sketch keeps exactly before it thins them out; the error of a rank is below 0.1 %.
SKETCH_SIZE = 4096
# Groups with fewer texts use the sketch of their language, and languages with fewer that of everything.
MIN_GROUP = 50
# Fences lie this many middle ranges outside the quartiles, and no nearer than the slack.
RANGES = 6.0
#: figure: (slack, checked below too)
FIGURES = {
    "word_length": (1.5, True), "symbol_share": (0.05, False), "dup_line_share": (0.50, False),
    "repeat_share": (0.40, False),
}


def text_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Number of words inside 3-word windows that occur at least twice in the list.

    Windows are sorted together with their places; equal ones are then neighbours.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda k: F.struct(F.concat_ws(" ", F.get(words, k), F.get(words, k + 1), F.get(words, k + 2)).alias("w"), k.alias("k")),
    )
    ordered = F.array_sort(windows)

    def places(sorted_windows: Column) -> Column:
        def inside(x: Column, at: Column) -> Column:
            again = (F.get(sorted_windows, at - 1)["w"] == x["w"]) | (F.get(sorted_windows, at + 1)["w"] == x["w"])
            return F.when(F.coalesce(again, F.lit(False)), F.array(x["k"], x["k"] + 1, x["k"] + 2)).otherwise(
                F.array().cast("array<int>")
            )

        return F.size(F.array_distinct(F.flatten(F.transform(sorted_windows, inside))))

    counted = F.transform(F.array(ordered), places)[0]
    distinct = F.size(F.array_distinct(F.transform(windows, lambda x: x["w"])))
    # Most texts repeat some window; where none does, the sort is not needed.
    return F.when(F.size(words) < 4, 0).otherwise(F.when(distinct == F.size(words) - 2, 0).otherwise(counted)).cast("bigint")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")


def text_figures(docs: DataFrame) -> DataFrame:
    """Counts of every text with doc_id, lang and source. A null text has no words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint"), F.col("lang").cast("string"), F.col("source").cast("string"),
        text.alias("text"), text_words(text).alias("words"),
    )
    return rows.select(
        "doc_id", "lang", "source", F.size("words").cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE, "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]", "")).cast("bigint").alias("n_symbols"),
        repeated_lines(F.col("text")).alias("n_dup_lines"), repeated_words(F.col("words")).alias("n_repeat_words"),
        F.size(F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD))).cast("bigint").alias("n_lines"),
    )


def shares(figures: DataFrame) -> DataFrame:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return figures.withColumns({
        "word_length": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)).cast("double"),
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
        "repeat_share": F.col("n_repeat_words") / words,
    })


def group_thresholds(figures: DataFrame, size: int = SKETCH_SIZE, least: int = MIN_GROUP) -> DataFrame:
    """(lang, source, <figure>_low, <figure>_high) for every pair of language and source.

    ``figures`` has the shares of the texts that passed the fixed rules. Null is a language or source
    of its own. Sketches are made once from the rows and merged for the wider groups.
    """
    names = list(FIGURES)
    own = written(
        figures.groupBy("lang", "source").agg(
            F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(name, F.lit(size)).alias(name) for name in names]
        ),
        cores(figures),
    )
    merge = [F.kll_merge_agg_double(name, F.lit(size)).alias(name) for name in names]
    wide = own.groupBy("lang").agg(F.sum("n").alias("n"), *merge)
    widest = own.groupBy().agg(F.sum("n").alias("n"), *merge)

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, F.struct("n", *names)).drop("n", *names)

    by_lang = packed(wide, "wide").withColumnRenamed("lang", "wide_lang")
    table = packed(own, "own").join(by_lang, F.col("lang").eqNullSafe(F.col("wide_lang"))).withColumn("one", F.lit(1))
    table = table.join(packed(widest, "widest").withColumn("one", F.lit(1)), "one")
    table = table.withColumn(
        "used", F.when(F.col("own.n") >= least, F.col("own")).when(F.col("wide.n") >= least, F.col("wide")).otherwise(F.col("widest"))
    )
    limits = []
    for name, (slack, below) in FIGURES.items():
        low, high = (F.kll_sketch_get_quantile_double(F.col(f"used.{name}"), F.lit(q)) for q in (0.25, 0.75))
        reach = F.greatest(RANGES * (high - low), F.lit(slack))
        limits += [(high + reach).alias(f"{name}_high"), ((low - reach) if below else F.lit(None).cast("double")).alias(f"{name}_low")]
    return table.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *limits)


def quality_report(docs: DataFrame, size: int = SKETCH_SIZE, least: int = MIN_GROUP) -> DataFrame:
    """One row per document: doc_id, its counts, base_failed and kept.

    base_failed: fewer than 50 words, or more than half of the words inside repeated 3-word windows.
    Thresholds come from the texts that pass this, so empty tables, and tables where none passes, have
    none. Columns used: doc_id, text, lang, source. Null texts count as empty. Repeated rows count each.
    """
    figures = shares(text_figures(docs)).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )
    figures = written(figures)
    limits = written(group_thresholds(figures.where(~F.col("base_failed")), size, least), cores(docs))
    joined = figures.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    outside = F.lit(False)
    for name, (_, below) in FIGURES.items():
        outside = outside | F.coalesce(F.col(name) > F.col(f"{name}_high"), F.lit(False))
        if below:
            outside = outside | F.coalesce(F.col(name) < F.col(f"{name}_low"), F.lit(False))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~outside).alias("kept"),
    )
