"""Lexicon sentiment with neighbour rules, as joins and one aggregation.

Every distinct word of a text is exploded with its neighbours and looked up in the lexicon table, so the only shuffle is
that of one partial sum per text and task. The lexicon is joined without a hint: Spark broadcasts it
while its size is below ``spark.sql.autoBroadcastJoinThreshold`` and uses a sort-merge join with skew
handling beyond.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame, functions as F

from trendloom.functions import lexicon_rules as rules

_PUNCTUATION = r"!-/:-@\[-`{-~"  # the ASCII punctuation ranges
TEXT_ROW = -1
_NEIGHBOURS = {"p1": -1, "p2": -2, "p3": -3, "n1": 1, "n2": 2}


def words(text: Column) -> Column:
    """Words of two or more characters; a clinging mark is removed from one side of a plain word."""
    marks = "|".join(re.escape(m) for m in sorted(rules.CLINGING_MARKS, key=len, reverse=True))
    plain = rf"[^{_PUNCTUATION}]{{2,}}"
    parts = F.filter(F.split(text, r"[\s\p{Z}]+"), lambda w: F.length(w) > 1)
    ends = F.lit("".join(sorted({c for mark in rules.CLINGING_MARKS for c in mark})))
    cleaned = lambda w: F.regexp_replace(w, rf"^(?:{marks})({plain})$|^({plain})(?:{marks})$", "$1$2")
    # most words have no mark at either end
    return F.transform(parts, lambda w: F.when(F.btrim(w, ends) == w, w).otherwise(cleaned(w)))


def _is_upper(word: Column) -> Column:
    return (F.lower(word) != word) & (F.upper(word) == word)


def _is_negation(word: Column) -> Column:
    low = F.lower(word)
    return F.coalesce(low.isin(list(rules.NEGATIONS)) | F.contains(low, F.lit("n't")), F.lit(False))


def _boost(word: Column, valence: Column, cap_diff: Column) -> Column:
    """Effect of a degree word on a valence."""
    low = F.lower(word)
    scalar = F.when(low.isin(list(rules.INTENSIFIERS)), F.lit(rules.BOOST)).when(
        low.isin(list(rules.DAMPENERS)), F.lit(-rules.BOOST)
    )
    signed = F.when(valence < 0, -scalar).otherwise(scalar)
    capital = F.when(valence > 0, F.lit(rules.CAPITALS)).otherwise(F.lit(-rules.CAPITALS))
    return F.coalesce(signed + F.when(cap_diff & _is_upper(word), capital).otherwise(F.lit(0.0)), F.lit(0.0))


def _negated(valence: Column, distance: int) -> Column:
    """Negation by the word at ``distance``, and the 'never so' and 'never this' exceptions."""
    flipped = F.when(_is_negation(F.col(f"p{distance}")), valence * rules.NEGATION_FACTOR).otherwise(valence)
    if distance == 1:
        return flipped

    def so(name: str) -> Column:
        return F.coalesce(F.col(name).isin("so", "this"), F.lit(False))

    never = F.coalesce(F.col(f"p{distance}") == "never", F.lit(False)) & so(f"p{distance - 1}")
    special = never if distance == 2 else never | so("p1")
    return F.when(special, valence * rules.NEVER_SO_FACTORS[distance - 2]).otherwise(flipped)


def _phrase(*names: str) -> Column:
    return F.concat_ws(" ", *[F.col(n) for n in names])


def _idioms(valence: Column) -> Column:
    # A phrase begins with one of these words, so most places need no lookup.
    first = sorted({phrase.split(" ")[0] for phrase in [*rules.IDIOMS, *rules.DAMPENER_PAIRS]})
    possible = functools.reduce(
        Column.__or__, [F.coalesce(F.col(n).isin(first), F.lit(False)) for n in ("w", "p1", "p2", "p3")]
    )
    table = F.create_map(*[F.lit(x) for pair in rules.IDIOMS.items() for x in pair])
    before = [("p1", "w"), ("p2", "p1", "w"), ("p2", "p1"), ("p3", "p2", "p1"), ("p3", "p2")]
    looked_up = F.transform(F.array(*[_phrase(*names) for names in before]), lambda phrase: F.element_at(table, phrase))
    result = F.coalesce(F.get(F.filter(looked_up, lambda value: value.isNotNull()), 0), valence)
    for names in (("w", "n1"), ("w", "n1", "n2")):
        complete = functools.reduce(Column.__and__, [F.col(n).isNotNull() for n in names])
        result = F.coalesce(F.when(complete, F.element_at(table, _phrase(*names))), result)
    dampened = _phrase("p3", "p2").isin(list(rules.DAMPENER_PAIRS)) | _phrase("p2", "p1").isin(
        list(rules.DAMPENER_PAIRS)
    )
    return F.when(possible, F.when(dampened, result - rules.BOOST).otherwise(result)).otherwise(valence)


def _once(value: Column) -> Column:
    """A column that is computed once per text.

    The generator keeps the optimiser from moving the expression behind the explode of the words, where
    it would be computed again for every word.
    """
    return F.explode_outer(F.array(value))


def _word_rows(texts: DataFrame, key: str, text: str) -> DataFrame:
    """One row per distinct word: its first place ``i``, itself, its neighbours there, how often it stands
    before, at and after the first "but", and the facts of its text.

    Every text also has one row without a word, so that a text without sentiment words stays.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    split_texts = texts.select(key, _once(F.struct(body.alias("text"), words(body).alias("words"))).alias("d"))
    upper = F.exists("d.words", _is_upper) & F.exists("d.words", lambda w: ~_is_upper(w))
    exclamations = F.length("d.text") - F.length(F.replace("d.text", F.lit("!")))
    questions = F.length("d.text") - F.length(F.replace("d.text", F.lit("?")))
    emphasis = F.least(exclamations, F.lit(rules.EXCLAMATION_LIMIT)) * rules.EXCLAMATION + (
        F.when(questions > rules.QUESTION_LIMIT, F.lit(rules.QUESTION_MANY))
        .when(questions > 1, questions * rules.QUESTION)
        .otherwise(F.lit(0.0))
    )
    # Natural order: array_sort would call a comparison function for every two words.
    places = F.sort_array(F.arrays_zip(F.col("d.words").alias("w"), F.sequence(F.lit(0), F.size("d.words") - 1).alias("i")))
    places = F.when(F.size("d.words") > 0, places).otherwise(F.array().cast("array<struct<w:string,i:int>>"))
    facts = split_texts.select(
        key,
        _once(
            F.struct(
                emphasis.alias("emphasis"),
                upper.alias("cap_diff"),
                (F.array_position(F.transform("d.words", lambda w: F.lower(w)), "but") - 1).alias("but_at"),
                F.col("d.words").alias("words"),
                places.alias("places"),
            )
        ).alias("f"),
    )
    # Equal words are neighbours among the sorted places; each run of them begins with the first place.
    starts = F.filter(
        F.sequence(F.lit(0), F.size("f.places") - 1),
        lambda k: (k == 0) | (F.get("f.places", k)["w"] != F.get("f.places", k - 1)["w"]),
    )
    starts = F.when(F.size("f.places") > 0, starts).otherwise(F.array().cast("array<int>"))
    facts = facts.select(key, "f", _once(starts).alias("starts"))

    def run_row(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get("starts", k + 1), F.size("f.places"))
        but = F.col("f.but_at")
        turned = F.aggregate(
            F.slice("f.places", start + 1, end - start), F.lit(0.0),
            lambda total, x: total + F.when(x["i"] == but, F.lit(1.0))
            .when(x["i"] < but, F.lit(rules.BEFORE_BUT)).otherwise(F.lit(rules.AFTER_BUT)),
        )
        shift = F.when(but < 0, (end - start).cast("double")).otherwise(turned)
        return F.struct(F.get("f.places", start)["i"].alias("i"), shift.alias("shift"))

    runs = F.concat(
        F.array(F.struct(F.lit(TEXT_ROW).alias("i"), F.lit(0.0).alias("shift"))), F.transform("starts", run_row)
    )
    # Two numbers per word leave the text; the word and its neighbours are taken from the array where they are needed.
    rows = facts.select(
        key, F.struct("f.emphasis", "f.cap_diff").alias("g"), F.col("f.words").alias("words"), _once(runs).alias("runs")
    ).select(key, "g", "words", F.explode("runs").alias("e"))
    near = [F.get("words", F.col("e.i") + step).alias(name) for name, step in _NEIGHBOURS.items()]
    word = F.get("words", F.col("e.i")).alias("w")
    return rows.select(key, "e.i", word, "e.shift", *near, "g.emphasis", "g.cap_diff")


def compound_sentiment(
    texts: DataFrame, lexicon: DataFrame, key: str = "title_id", text: str = "text"
) -> DataFrame:
    """``key, compound``: sentiment of every text in [-1, 1], four places.

    ``lexicon`` has ``token, valence`` with lower-case tokens; of a repeated token the largest valence counts.
    A word that is repeated is judged by its neighbours at its first place; each occurrence counts, and where
    it stands relative to "but" is its own.
    """
    lexicon = lexicon.groupBy("token").agg(F.max("valence").alias("valence"))
    rows = _word_rows(texts, key, text)
    low = F.lower("w")
    degree = low.isin([*rules.INTENSIFIERS, *rules.DAMPENERS]) | (
        (low == "kind") & (F.lower("n1") == "of")
    )
    hits = rows.join(lexicon.select(F.col("token").alias("_t"), "valence"), low == F.col("_t"), "left")
    # Only the words found and one row per text go on from here.
    hits = hits.filter(F.col("valence").isNotNull() | (F.col("i") == TEXT_ROW)).withColumn(
        "valence", F.when(~F.coalesce(degree, F.lit(False)), F.col("valence")).cast("double")
    ).filter(F.col("valence").isNotNull() | (F.col("i") == TEXT_ROW))
    # A neighbour that is a sentiment word itself does not modify; one lookup per neighbour tells.
    for name in ("p1", "p2", "p3"):
        known = lexicon.select(F.col("token").alias("_known"))
        hits = hits.join(known, F.lower(name) == F.col("_known"), "left").withColumn(
            f"{name}_modifies", F.col(name).isNotNull() & F.col("_known").isNull()
        ).drop("_known")

    def modifies(name: str) -> Column:
        return F.col(f"{name}_modifies")

    shout = F.when(F.col("valence") > 0, F.lit(rules.CAPITALS)).otherwise(F.lit(-rules.CAPITALS))
    scored = hits.withColumn(
        "v", F.col("valence") + F.when(F.col("cap_diff") & _is_upper(F.col("w")), shout).otherwise(F.lit(0.0))
    )
    for distance, weight in enumerate(rules.DISTANCE_WEIGHTS, start=1):
        name = f"p{distance}"
        boosted = F.col("v") + weight * _boost(F.col(name), F.col("v"), F.col("cap_diff"))
        scored = scored.withColumn("_b", F.when(modifies(name), boosted).otherwise(F.col("v")))
        after = _negated(F.col("_b"), distance)
        if distance == 3:
            scored = scored.withColumn("_n", F.when(modifies(name), after).otherwise(F.col("_b")))
            after = _idioms(F.col("_n"))
        scored = scored.withColumn("v", F.when(modifies(name), after).otherwise(F.col("_b")))
    least = modifies("p1") & (F.lower("p1") == "least") & ~F.coalesce(F.lower("p2").isin("at", "very"), F.lit(False))
    scored = scored.withColumn("v", F.when(least, F.col("v") * rules.NEGATION_FACTOR).otherwise(F.col("v")))
    sums = scored.groupBy(key).agg(
        F.coalesce(F.sum(F.col("v") * F.col("shift")), F.lit(0.0)).alias("s"), F.max("emphasis").alias("emphasis")
    )
    total = F.col("s") + F.when(F.col("s") > 0, F.col("emphasis")).when(
        F.col("s") < 0, -F.col("emphasis")
    ).otherwise(F.lit(0.0))
    return sums.withColumn("s", total).select(
        key,
        F.round(
            F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("s") / F.sqrt(F.col("s") * F.col("s") + rules.NORMALISER))),
            rules.COMPOUND_DIGITS,
        ).alias("compound"),
    )
