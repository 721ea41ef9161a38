"""Text expressions: normalisation, tokens, title similarity."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F

from trendloom.functions.edit import distance

# Spark's default English stop words. The list is a default; every operator that uses it takes
# another one as ``stop_words``.
ENGLISH_STOP_WORDS: tuple[str, ...] = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself",
    "they", "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had",
    "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as",
    "until", "while", "of", "at", "by", "for", "with", "about", "against", "between", "into", "through",
    "during", "before", "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off",
    "over", "under", "again", "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "should",
    "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd", "she'd", "we'd",
    "they'd", "i'm", "you're", "he's", "she's", "it's", "we're", "they're", "i've", "we've", "you've",
    "they've", "isn't", "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't",
    "didn't", "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could",
    "here's", "how's", "let's", "ought", "that's", "there's", "what's", "when's", "where's", "who's",
    "why's", "would",
)

# Editorial prefixes and suffixes removed by ``strip_headline_noise``.
HEADLINE_NOISE_PATTERNS: tuple[str, ...] = (
    r"^Moneycontrol Pro Panorama\s*\|\s*",
    r"^Chart of the Day\s*\|\s*",
    r"^Data Story:\s*",
    r"\s*-\s*Times of India$",
    r"\s*:\s*Report$",
)

# Letters, digits and underscore of any script; plain ``\w`` is ASCII only on the JVM.
WORD_CHAR = r"\p{L}\p{N}_"
SPACE_CHAR = r"\s\p{Z}"
TERM_PATTERN = rf"[{WORD_CHAR}]{{2,}}"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(text: Column | str) -> Column:
    """Remove white space of any kind at both ends (``trim`` removes spaces only)."""
    return F.regexp_replace(_col(text), rf"^[{SPACE_CHAR}]+|[{SPACE_CHAR}]+$", "")


def normalised_headline(headline: Column | str) -> Column:
    """Lower case, punctuation deleted, ends stripped; a null reads as the word ``None``."""
    text = F.lower(F.coalesce(_col(headline), F.lit("None")))
    return strip(F.regexp_replace(text, rf"[^{WORD_CHAR}{SPACE_CHAR}]", ""))


def strip_headline_noise(text: Column | str, patterns: tuple[str, ...] = HEADLINE_NOISE_PATTERNS) -> Column:
    """Remove editorial prefixes and suffixes, ignoring case; null becomes empty."""
    result = F.coalesce(_col(text), F.lit(""))
    for pattern in patterns:
        result = F.regexp_replace(result, f"(?i){pattern}", "")
    return strip(result)


def combined_text(title: Column | str, summary: Column | str) -> Column:
    """Title and summary joined by one space, nulls read as empty."""
    return F.concat(F.coalesce(_col(title), F.lit("")), F.lit(" "), F.coalesce(_col(summary), F.lit("")))


def terms(text: Column | str) -> Column:
    """Lower-case runs of two or more word characters, in text order."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(f"({TERM_PATTERN})"), F.lit(1))


def word_set(text: Column | str) -> Column:
    """Distinct lower-case words separated by white space."""
    words = F.split(F.lower(F.coalesce(_col(text), F.lit(""))), rf"[{SPACE_CHAR}]+")
    return F.array_distinct(F.array_remove(words, ""))


def jaccard(left: Column | str, right: Column | str) -> Column:
    """Shared words over all words of two texts; 0.0 when neither has a word."""
    a, b = word_set(left), word_set(right)
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / F.nullif(union, F.lit(0))).otherwise(F.lit(0.0))


def levenshtein_similarity(left: Column | str, right: Column | str) -> Column:
    """One minus edit distance over the longer length, on lower-case text; 1.0 for two empty texts.

    Written with one division, so that a value such as 0.575 has its shortest form before rounding.
    """
    a, b, longest = _compared(left, right)
    same = longest - F.levenshtein(a, b)
    return F.when(longest > 0, same / F.nullif(longest, F.lit(0))).otherwise(F.lit(1.0))


def long_levenshtein_similarity(left: Column | str, right: Column | str) -> Column:
    """As :func:`levenshtein_similarity`, for texts of any length: the built-in distance visits every pair of characters."""
    a, b, longest = _compared(left, right)

    @F.pandas_udf("int")
    def steps(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([distance(s, t) for s, t in zip(x, y)], dtype="int32")

    same = longest - steps(a, b)
    return F.when(longest > 0, same / F.nullif(longest, F.lit(0))).otherwise(F.lit(1.0))


def _compared(left: Column | str, right: Column | str) -> tuple[Column, Column, Column]:
    """Both texts in lower case and the longer length."""
    a = F.lower(F.coalesce(_col(left), F.lit("")))
    b = F.lower(F.coalesce(_col(right), F.lit("")))
    return a, b, F.greatest(F.length(a), F.length(b))
