"""Phrase collocations mined by Toivonen's sampling method, counted exactly.

Texts are cut into pieces at sentence and line marks, pieces into words; a phrase is 1 to ``MAX_WORDS``
consecutive words of one piece, counted per language with overlaps. A phrase is frequent with ``min_count``
occurrences.

Method. A Bernoulli sample of pieces (``SAMPLE_RATE``, chosen by a hash of row and place, so reruns agree) proposes
the phrases frequent in it at a lowered threshold; words are counted in the sample and in full by the same scan.
One full pass then counts exactly the proposed phrases and
their negative border: every word, every pair of proposed words, every triple whose two inner pairs are proposed.
What the sample proposed but the full count finds rare is left out before
the next length is counted. A border phrase that proves frequent means the sample missed something: the next full pass counts the phrases
that the enlarged frequent set newly admits, and so on until no border phrase is frequent (closed). Phrases that
no frequent set admits are never counted; all counts are exact, the sample only decides what is counted.

Scores. A candidate has 2 or 3 words and ``a`` occurrences. Each cut after ``k`` words gives ``l`` and ``r``, the
counts of both parts; the score of the cut is ``floor(1e6 * a * a / (l * r))`` in exact decimal arithmetic, and
the lowest cut counts (ties to the smaller ``k``). A pair is dropped when a frequent triple that starts or ends
with it has at least half its count. Each language keeps its best ``top`` by score, count and phrase.

All work is joins and aggregations of Spark; tables that later passes read are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.llm.shared import ascii_lower, written

PIECE = r"[.,;:!?\x0A-\x0D]"
MAX_WORDS, MIN_COUNT, TOP = 3, 10, 2000
#: Share of pieces in the sample, and the share of the expected count that makes a phrase frequent in it.
SAMPLE_RATE, LOWERING = 1 / 16, 0.5
#: Candidate keys up to this many are sent to every task (16 bytes each with their flag); beyond, a shuffle join.
BROADCAST_KEYS = 2_000_000
_BUCKETS = 1 << 20


def phrase_pieces(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per piece with words: ``lang`` (null: ``und``), ``words`` array, and ``sampled`` (in the sample)."""
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.xxhash64(*[F.col(c) for c in docs.columns]).alias("row_hash"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("whole"),
    )
    # the hash of a row is taken here, below the explode, or every piece would hash its whole text again
    rows = rows.select("lang", "row_hash", F.posexplode(F.split("whole", PIECE)).alias("piece_no", "given"))
    # a piece has words if more than blanks is left; asked of the words, the filter would cut every piece twice
    rows = rows.withColumn("given", F.trim(F.replace("given", F.lit("\t"), F.lit(" ")))).where(F.col("given") != "")
    # lower() works on bytes where a piece is ASCII; elsewhere it would change more letters than A to Z
    lowered = (F.when(F.length("given") == F.octet_length("given"), F.lower("given"))
               .when(F.col("given").rlike("[A-Z]"), ascii_lower(F.col("given"))).otherwise(F.col("given")))
    words = F.split(lowered, " ")
    words = F.when(F.contains("given", F.lit("  ")), F.array_remove(words, "")).otherwise(words)
    # equal rows have the same pieces in the sample
    spot = F.pmod(F.xxhash64("row_hash", "piece_no"), F.lit(_BUCKETS))
    return rows.select("lang", words.alias("words"), (spot < F.lit(int(SAMPLE_RATE * _BUCKETS))).alias("sampled"))


def _grams(pieces: DataFrame, k: int) -> DataFrame:
    """Every occurrence of ``k`` consecutive words: ``lang``, ``words`` (the whole piece), ``i`` (first place, from 0).

    For ``k`` > 1 also ``hx`` and ``hy``, the keys (:func:`_key`) of the first and the last ``k - 1`` words. The
    words of the phrase are joined (:func:`_phrase`) by those who need them.
    """
    long_enough = pieces.where(F.size("words") >= k)
    grams = long_enough.select("lang", "words", F.explode(F.sequence(F.lit(0), F.size("words") - k)).alias("i"))
    if k > 1:
        grams = grams.withColumns({"hx": _key(_words(k - 1)), "hy": _key(_words(k - 1, 1))})
    return grams


def _words(k: int, skip: int = 0) -> list[Column]:
    """The ``k`` words from place ``i + skip`` on."""
    return [F.get("words", F.col("i") + (skip + j)) for j in range(k)]


def _phrase(k: int) -> Column:
    """The ``k`` words from place ``i`` on, joined."""
    return F.concat_ws(" ", *_words(k))


def _occurrences(pieces: DataFrame, k: int) -> DataFrame:
    """``lang, phrase`` of every occurrence of ``k`` consecutive words."""
    return _grams(pieces, k).select("lang", _phrase(k).alias("phrase"))


def _key(words: list[Column]) -> Column:
    """64-bit key of a phrase of a language, from its words, which need not be joined for it.

    Keys only choose what is counted; counts are of the phrases themselves.
    """
    return F.xxhash64(F.col("lang"), *words)


def _admitted(pieces: DataFrame, k: int, allowed: DataFrame, again: bool) -> DataFrame:
    """Occurrences of ``k`` words whose two inner phrases are allowed; ``again``: not both allowed before (``old``).

    Allowed phrases are looked up by key, one row per key, so no occurrence is repeated by the lookup; up to
    ``BROADCAST_KEYS`` keys go to every task, more by a shuffle join. Two
    phrases of one key admit what either admits: a phrase counted that the method did not ask for has its
    exact count too, and :func:`frequent_phrases` keeps each phrase once.
    """
    inner = F.split("phrase", " ")
    keys = written(allowed.groupBy(_key([F.get(inner, j) for j in range(k - 1)]).alias("h"))
                   .agg(F.bool_and("old").alias("old")))
    out, phrase = _grams(pieces, k), _phrase(k)
    if keys.count() <= BROADCAST_KEYS:
        # occurrences are then looked up where they are made, and only counts of admitted phrases move
        keys = F.broadcast(keys)
    else:
        # an occurrence moves with its own words only, not with its piece
        out, phrase = out.select("lang", phrase.alias("phrase"), "hx", "hy"), F.col("phrase")
    for side in ("hx", "hy"):
        out = out.join(keys.select(F.col("h").alias(side), F.col("old").alias(f"old_{side}")), side)
    if again:
        out = out.where(~(F.col("old_hx") & F.col("old_hy")))
    return out.select("lang", phrase.alias("phrase"))


def _counted(occurrences: DataFrame, k: int) -> DataFrame:
    return _by_phrase(occurrences, F.count(F.lit(1)).alias("f")).withColumn("k", F.lit(k))


def _by_phrase(occurrences: DataFrame, *aggregates: Column) -> DataFrame:
    """``lang, phrase`` and the aggregates of each phrase.

    Phrases are grouped as bytes, the same groups: for keys that are all strings Spark puts a small first map before
    the one that holds the groups, and most phrases are rare, so they would be looked up in both.
    """
    rows = occurrences.withColumn("phrase", F.col("phrase").cast("binary")).groupBy("lang", "phrase").agg(*aggregates)
    return rows.withColumn("phrase", F.col("phrase").cast("string"))


def frequent_phrases(pieces: DataFrame, min_count: int = MIN_COUNT,
                     max_words: int = MAX_WORDS) -> tuple[DataFrame, DataFrame, int]:
    """All phrases of 1 to ``max_words`` words with at least ``min_count`` occurrences.

    Returns ``lang, phrase, k, f`` with exact counts, ``lang, n`` (all word occurrences), and the number of full
    passes that Toivonen's method needed (1 when the sample missed nothing). Only frequent phrases are stored
    between passes; the pieces are stored once, compressed.
    """
    pieces = written(pieces, compression="zstd")
    least = max(1, int(SAMPLE_RATE * min_count * LOWERING))
    sample = pieces.where("sampled")
    # proposed by the sample: frequent there at the lowered threshold, with all inner phrases proposed
    allowed: dict[int, DataFrame] = {}
    # one scan counts every word in the sample and in full; the words' counts add up to those of the languages
    words = written(_by_phrase(pieces.select("lang", F.explode("words").alias("phrase"), "sampled"),
                               F.count(F.lit(1)).alias("f"), F.count_if("sampled").alias("in_sample")))
    totals = written(words.groupBy("lang").agg(F.sum("f").alias("n")))
    for k in range(1, max_words):
        in_sample = words.withColumn("f", F.col("in_sample")) if k == 1 else _counted(_occurrences(sample, k), k)
        found = in_sample.where(F.col("f") >= least)
        if k > 1 and least > 1:  # every phrase of the sample is proposed otherwise, and so are its inner ones
            found = found.join(_admitted(sample, k, allowed[k - 1], False).distinct(), ["lang", "phrase"], "left_semi")
        allowed[k] = written(found.select("lang", "phrase", F.lit(True).alias("old")))
    frequent = written(words.where(F.col("f") >= min_count).select("lang", "phrase", "f", F.lit(1).alias("k")))
    # a level is counted in full before the next, so what the sample proposed in vain admits nothing there
    allowed[1] = _confirmed(allowed[1], frequent)
    grew = {k: True for k in allowed}
    passes = 0
    while True:
        # a full pass: phrases whose inner phrases are allowed, except those counted in an earlier pass
        for k in range(2, max_words + 1):
            if grew[k - 1]:
                found = _counted(_admitted(pieces, k, allowed[k - 1], passes > 0), k).where(F.col("f") >= min_count)
                frequent = written(frequent.unionByName(found).dropDuplicates(["lang", "phrase"]))
                if k in allowed and passes == 0:
                    allowed[k] = _confirmed(allowed[k], frequent)
                elif k in allowed:
                    # what this pass found missing is admitted to the next length at once
                    missed = _missed(frequent, allowed[k], k)
                    if not missed.isEmpty():
                        allowed[k], grew[k] = written(allowed[k].unionByName(missed)), True
        passes += 1
        # border failures: frequent phrases that were not allowed, so longer phrases with them are not counted yet
        for k in allowed:
            missed = _missed(frequent, allowed[k], k)
            old = allowed[k].select("lang", "phrase", F.lit(True).alias("old"))
            grew[k] = not missed.isEmpty()
            allowed[k] = written(old.unionByName(missed)) if grew[k] else old
        if not any(grew.values()):
            return frequent.select("lang", "phrase", "k", "f"), totals, passes


def _missed(frequent: DataFrame, allowed: DataFrame, k: int) -> DataFrame:
    """The frequent phrases of ``k`` words that are not allowed yet."""
    missed = frequent.where(F.col("k") == k).select("lang", "phrase").join(allowed, ["lang", "phrase"], "left_anti")
    return missed.withColumn("old", F.lit(False))


def _confirmed(proposed: DataFrame, frequent: DataFrame) -> DataFrame:
    """The proposed phrases that a full count found frequent."""
    return written(proposed.join(frequent.select("lang", "phrase"), ["lang", "phrase"], "left_semi"))


def _score(a: str, l: str, r: str) -> Column:
    """floor(1e6 * a * a / (l * r)) by integral division of whole decimals (the products pass 64 bits)."""
    d = "decimal(38,0)"
    return F.expr(f"(cast({a} as {d}) * cast({a} as {d}) * cast(1000000 as {d})) div (cast({l} as {d}) * cast({r} as {d}))")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
                 top: int = TOP) -> DataFrame:
    """The best ``top`` collocations of 2 or 3 words per language.

    Returns ``lang, rank, phrase, a, l, r, n, score`` (numbers long): ``a`` the phrase's count, ``l`` and ``r``
    those of the parts at its lowest-scoring cut, ``n`` all words of the language. Text null counts as empty, lang
    null as ``und``; only A-Z are lower-cased. Ranks order by score, then count descending, then phrase in UTF-8
    byte order; equal phrases are one. Repeated rows count as often as they occur. Only ``text`` and ``lang`` are
    read, so other columns, whatever their names, change nothing but the sample (which changes no result).
    An empty table gives no rows.
    """
    pieces = phrase_pieces(docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")), "text", "lang")
    frequent, n, _ = frequent_phrases(pieces, min_count)
    frequent = written(frequent)
    cand = frequent.where("k >= 2").select("lang", "phrase", "k", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = cand.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"), "w", "k")
    cuts = cuts.select("lang", "phrase", "a", "cut",
                       F.array_join(F.slice("w", 1, F.col("cut")), " ").alias("lp"),
                       F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("rp"))
    counts = frequent.select("lang", "phrase", "f")
    cuts = (cuts.join(counts.select("lang", F.col("phrase").alias("lp"), F.col("f").alias("l")), ["lang", "lp"])
            .join(counts.select("lang", F.col("phrase").alias("rp"), F.col("f").alias("r")), ["lang", "rp"]))
    best = cuts.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(_score("a", "l", "r").alias("score"), "cut", "l", "r")).alias("b"))
    best = best.select("lang", "phrase", "a", "b.l", "b.r", "b.score")
    triples = frequent.where("k = 3").select("lang", F.split("phrase", " ").alias("w"), "f")
    inside = triples.select("lang", F.explode(F.array(F.array_join(F.slice("w", 1, 2), " "),
                                                      F.array_join(F.slice("w", 2, 2), " "))).alias("phrase"), "f")
    covering = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = best.join(covering, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * 50)).drop("longer")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", "rank", "phrase", F.col("a").cast("long").alias("a"),
                                         F.col("l").cast("long").alias("l"), F.col("r").cast("long").alias("r"),
                                         "n", "score")
