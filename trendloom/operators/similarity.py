"""TF-IDF vectors and their comparison in bounded blocks.

Compared vectors are short byte strings of numbered terms (:mod:`~trendloom.functions.packed`).

Comparing articles pair by pair through a join on shared terms would emit every pair of a topic. Here
the articles are cut into blocks of a fixed row count; Spark pairs up the blocks that are close enough
in time, one task compares two blocks, and only one reduced row per article and block leaves the task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from trendloom.functions import packed
from trendloom.functions.text import ENGLISH_STOP_WORDS, combined_text, terms
from trendloom.operators.ordering import with_ordinal
from trendloom.operators.scratch import Scratch

# Fixed values of the topic rule.
MAX_HOURS_GAP = 72
MIN_COSINE = 0.15
COSINE_DIGITS = 6

BLOCK_ROWS = 2048
_CELL_BUDGET = 8_000_000  # doubles held at a time while two blocks are compared
_STRIP_COLUMNS = 128
_PAIR_SALTS = 16
CHUNK_TERMS = 1 << 21  # terms of text in one chunk
_WORDS_A_ROW = 8192


def gap_seconds(time: Column, other: Column) -> Column:
    return F.abs(time - other)


def within_gap(seconds: Column, max_hours_gap: int | None = None) -> Column:
    """The time gate of the topic rule."""
    return seconds <= (MAX_HOURS_GAP if max_hours_gap is None else max_hours_gap) * 3600


# ---------------------------------------------------------------- vectors


def term_counts(articles: DataFrame, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> DataFrame:
    """``title_id, term, n`` over title and summary; the counts are combined before the shuffle."""
    exploded = articles.select("title_id", F.explode(terms(combined_text("title", "summary"))).alias("term"))
    if stop_words:
        exploded = exploded.filter(~F.col("term").isin(list(stop_words)))
    return exploded.groupBy("title_id", "term").agg(F.count(F.lit(1)).alias("n"))


def document_frequencies(counts: DataFrame) -> DataFrame:
    """Articles per term; the counts are combined before the shuffle."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def _raw(n: Column, df: Column, total: Column) -> Column:
    return n * (F.log((F.lit(1.0) + total) / (F.lit(1.0) + df)) + 1.0)


def tfidf_raw(
    articles: DataFrame, stop_words: Sequence[str] = ENGLISH_STOP_WORDS
) -> DataFrame:
    """``title_id, term, n, raw`` with ``raw = n * (ln((1 + N) / (1 + df)) + 1)``."""
    total = articles.agg(F.count(F.lit(1))).scalar()
    return _with_frequency(articles, stop_words).select("title_id", "term", "n", _raw(F.col("n"), F.col("df"), total).alias("raw"))


def _with_frequency(articles: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    """``title_id, term, n, df``."""
    counts = term_counts(articles, stop_words)
    return counts.join(document_frequencies(counts), "term").select("title_id", "term", "n", "df")


def tfidf_weights(
    articles: DataFrame, stop_words: Sequence[str] = ENGLISH_STOP_WORDS
) -> DataFrame:
    """``title_id, term, weight`` with vectors of length one."""
    vectors = tfidf_vectors(articles, stop_words)
    return vectors.select("title_id", F.explode(F.arrays_zip("terms", "weights")).alias("e")).select(
        "title_id", F.col("e.terms").alias("term"), F.col("e.weights").alias("weight")
    )


def tfidf_vectors(
    articles: DataFrame, stop_words: Sequence[str] = ENGLISH_STOP_WORDS
) -> DataFrame:
    """``title_id, terms, weights, sig``; articles without a usable term have no row.

    ``sig`` is equal for articles whose term counts are in one proportion. An array holds the terms of one article.
    Entries move with the two whole numbers that give their weight, which compress better than the weight.
    """
    total = articles.agg(F.count(F.lit(1))).scalar()
    raw = F.col("raw")
    entries = _with_frequency(articles, stop_words)
    # Dealt as plain rows, still in term order: lists made before the shuffle would be half as long again.
    grouped = (
        entries.repartition(int(articles.sparkSession.conf.get("spark.sql.shuffle.partitions")), "title_id")
        .withColumn("raw", _raw(F.col("n"), F.col("df"), total))
        .groupBy("title_id")
        .agg(
            # Natural order: array_sort would call a comparison function for every two terms.
            F.sort_array(F.collect_list(F.struct("term", "n", "raw"))).alias("v"),
            F.sqrt(F.sum(raw * raw)).alias("norm"),
        )
    )
    return grouped.select(
        "title_id",
        F.col("v.term").alias("terms"),
        F.transform("v", lambda e: e["raw"] / F.col("norm")).alias("weights"),
        # Quotients of whole numbers are equal doubles only if the proportions are equal.
        F.sha2(
            F.to_json(F.struct(F.col("v.term"), F.transform("v", lambda e: e["n"] / F.col("v")[0]["n"]).alias("share"))), 256
        ).alias("sig"),
    )


def article_vectors(
    articles: DataFrame, scratch: Scratch, stop_words: Sequence[str] = ENGLISH_STOP_WORDS, titles: bool = True
) -> DataFrame:
    """``title_id, t, title_lower, vector, sig``: each article with the time in seconds and the lower-case title that the
    topic rule needs, null without ``titles``, and with the vector of :func:`tfidf_vectors` as
    :func:`~trendloom.functions.packed.pack_vectors` writes it. Articles without a usable term have no row.

    Texts are read once. A chunk of articles counts terms under numbers of its own and sends each distinct term once, so
    neither the terms nor their frequencies move once for every article that has them.
    """
    counted = scratch.keep(_counted_chunks(articles, stop_words, titles))
    total = counted.agg(F.coalesce(F.sum("read"), F.lit(0))).first()[0]
    words = counted.filter("first IS NOT NULL").select(
        "chunk", "first", F.posexplode(F.arrays_zip("words", "having"))
    ).select("chunk", (F.col("first") + F.col("pos")).alias("place"), F.col("col.words").alias("term"), F.col("col.having").alias("n"))
    tasks = int(articles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frequencies = words.repartition(tasks, "term").groupBy("term").agg(
        F.sum("n").alias("df"), F.collect_list(F.struct("chunk", "place")).alias("at")
    )
    # Numbers follow from the frequency and the term, so a repeated task gives the same ones; frequent terms get small ones.
    numbered = frequencies.sortWithinPartitions(F.desc("df"), "term").select(
        "df", "at", F.monotonically_increasing_id().alias("row")
    )
    # The task's number is in the upper bits and a count from 0 in the lower 33.
    term = F.col("row").bitwiseAND((1 << 33) - 1) * tasks + F.shiftright("row", 33)
    places = numbered.select("df", term.alias("term"), F.explode("at").alias("e")).select("e.chunk", "e.place", "term", "df")

    def number(left, right):
        import pyarrow as pa

        if not left.num_rows:
            return pa.table({name: pa.array([], kind) for name, kind in zip(_VECTOR_COLUMNS, _vector_kinds())})
        place, of = right["place"].to_numpy(), np.empty((2, right.num_rows), np.int64)
        of[0, place], of[1, place] = right["term"].to_numpy(), right["df"].to_numpy()
        lengths, own, counts = packed.unpack(left["counts"].to_pylist())
        order = np.lexsort((of[0, own], np.repeat(np.arange(len(lengths)), lengths)))
        own = own[order]
        vectors, sigs = packed.pack_vectors(lengths, of[0, own], counts[order], of[1, own], total)
        return pa.table([*(left[name] for name in _VECTOR_COLUMNS[:3]), pa.array(vectors, pa.binary()), pa.array(sigs, pa.binary())], _VECTOR_COLUMNS)

    schema = "title_id long, t long, title_lower string, vector binary, sig binary"
    rows = counted.filter("counts IS NOT NULL").select("chunk", "title_id", "t", "title_lower", "counts")
    vectors = scratch.keep(rows.groupBy("chunk").cogroup(places.groupBy("chunk")).applyInArrow(number, schema))
    scratch.drop(counted)
    return vectors


_VECTOR_COLUMNS = ["title_id", "t", "title_lower", "vector", "sig"]


def _vector_kinds():
    import pyarrow as pa

    return [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]


def _counted_chunks(articles: DataFrame, stop_words: Sequence[str], titles: bool) -> DataFrame:
    """Rows of three kinds for every chunk: articles with the packed counts of their terms; the distinct terms, most
    frequent first, with the number of articles that have them, from place ``first`` on; the number of rows read.

    Rows of one id are one article, also those without an id, which count in frequencies but get no row.
    """
    dealt = articles.select("title_id", "title", "summary", F.unix_seconds("published_at").alias("t")).withColumn(
        # Brings the rows of an id together, without a shuffle if they were dealt by it.
        "nth", F.row_number().over(Window.partitionBy("title_id").orderBy("title_id"))
    )
    title = F.lower(F.coalesce("title", F.lit(""))) if titles else F.lit(None).cast("string")
    tokens = dealt.select(
        "title_id", "t", title.alias("title_lower"), "nth", terms(combined_text("title", "summary")).alias("terms")
    )
    stop = list(stop_words)

    def count(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        names = ["chunk", "title_id", "t", "title_lower", "counts", "first", "words", "having", "read"]
        kinds = [
            pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int64(),
            pa.list_(pa.string()), pa.list_(pa.int64()), pa.int64(),
        ]
        chunk = TaskContext.get().partitionId() << 32

        def rows(n, **values):
            columns = [pa.nulls(n, k) if x not in values else v if isinstance(v := values[x], pa.Array) else pa.array(v, k) for x, k in zip(names, kinds)]
            return pa.RecordBatch.from_arrays(columns, names)

        def counted(facts, row, of, lengths, texts, times, end):
            """The batches for articles before ``end``, and the facts, terms and counts of article ``end``.

            ``row`` has the article of each row of ``facts``; the articles ``of`` have ``lengths`` of the ``texts``.
            """
            coded = texts.dictionary_encode()
            spelled, codes = coded.dictionary, coded.indices.to_numpy()
            usable = ~pc.is_in(spelled, value_set=pa.array(stop, spelled.type)).to_numpy(zero_copy_only=False)[codes]
            size = max(len(spelled), 1)
            key, weights = (np.repeat(of, lengths) * size + codes)[usable], times[usable]
            order = np.argsort(key, kind="stable")
            key = key[order]
            new = np.flatnonzero(np.diff(key, prepend=-1))
            own, codes = np.divmod(key[new], size)
            n = np.add.reduceat(weights[order], new) if len(new) else weights
            last = own == end
            rest = facts.filter(pa.array(row == end)), spelled.take(pa.array(codes[last])), n[last]
            own, codes, n = own[~last], codes[~last], n[~last]
            having = np.bincount(codes, minlength=size)
            ranked = np.argsort(-having, kind="stable")[: np.count_nonzero(having)]
            place = np.empty(size, np.int64)
            place[ranked] = np.arange(len(ranked))
            codes = place[codes]
            order, held = np.lexsort((codes, own)), np.bincount(own, minlength=end)
            lists = np.full(end + 1, None, object)
            lists[:-1][held > 0] = packed.pack(held[held > 0], codes[order], n[order])
            out, kept = [], np.append(held, 0)[row] > 0
            if kept.any():
                columns = {x: facts.column(x).filter(pa.array(kept)).combine_chunks() for x in facts.column_names}
                out.append(rows(int(kept.sum()), chunk=np.full(kept.sum(), chunk), counts=lists[row[kept]].tolist(), **columns))
            words, having = spelled.take(pa.array(ranked)), having[ranked]
            for at in range(0, len(ranked), _WORDS_A_ROW):
                some = slice(at, at + _WORDS_A_ROW)
                out.append(rows(1, chunk=[chunk], first=[at], words=[words[some].to_pylist()], having=[having[some]]))
            return out, rest

        held = None  # the last article, which may go on
        for batch in batches:
            yield rows(1, read=[batch.num_rows])
            lengths = pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False).astype(np.int64)
            ends, at = np.cumsum(lengths), 0
            while at < batch.num_rows:
                to = int(min(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK_TERMS) + 1, batch.num_rows))
                part = pa.Table.from_batches([batch.slice(at, to - at)])
                of, sizes = np.cumsum(part.column("nth").to_numpy() == 1) - (held is None), lengths[at:to]
                known = part.column("title_id").is_valid().to_numpy()
                facts, row = part.select(["title_id", "t", "title_lower"]).filter(pa.array(known)), of[known]
                texts = part.column("terms").combine_chunks().flatten()
                times, end = np.ones(len(texts), np.int64), int(of[-1])
                if held:
                    row = np.concatenate([np.zeros(held[0].num_rows, np.int64), row])
                    of, sizes = np.concatenate([[0], of]), np.concatenate([[len(held[1])], sizes])
                    facts, texts = pa.concat_tables([held[0], facts]), pa.concat_arrays([held[1], texts])
                    times = np.concatenate([held[2], times])
                out, held = counted(facts, row, of, sizes, texts, times, end)
                if end:
                    yield from out
                    chunk += 1
                at = to
        if held:
            facts, texts, times = held
            row = np.zeros(facts.num_rows, np.int64)
            yield from counted(facts, row, np.zeros(1, np.int64), np.array([len(texts)]), texts, times, 1)[0]

    schema = (
        "chunk long, title_id long, t long, title_lower string, counts binary, first long, words array<string>, "
        "having array<long>, read long"
    )
    return tokens.mapInArrow(count, schema)


# ---------------------------------------------------------------- blocks


def assign_blocks(rows: DataFrame, gap_seconds: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``bucket`` (time cell of one gap) and ``block``, at most ``block_rows`` rows in time order.

    A hot time cell is cut into many blocks; quiet cells share one.
    """
    placed = rows.select("title_id", F.floor(F.col("t") / gap_seconds).alias("bucket"))
    numbered = with_ordinal(placed, "title_id", ["bucket"], "_ordinal").select(
        "title_id", "bucket", F.expr(f"(_ordinal - 1) div {int(block_rows)}").alias("block")
    )
    return rows.join(numbered, "title_id")


def stored_blocks(
    articles: DataFrame, stop_words: Sequence[str], gap_seconds: int, block_rows: int,
    titles: bool = True, beside: DataFrame | None = None,
) -> DataFrame:
    """Vectors cut into blocks, written once because every comparison reads them several times.

    A repeated row is placed once, so that it stays as often as it was given. The columns of ``beside``, if given, are
    joined to the places by ``title_id``, where there are such rows; no vector moves for them.
    """
    with Scratch(articles.sparkSession) as scratch:
        vectors = article_vectors(articles, scratch, stop_words, titles)
        places = assign_blocks(vectors.select("title_id", "t").distinct(), gap_seconds, block_rows)
        own = places.filter(F.col("bucket") == F.floor(F.col("t") / gap_seconds)).groupBy("title_id", "t", "bucket")
        placed = own.agg(F.min("block").alias("block"))
        if beside is not None:
            placed = placed.join(beside, "title_id", "left")
        return vectors.join(placed, ["title_id", "t"]).checkpoint()


def block_pairs(blocked: DataFrame, gap_seconds: int, with_self: bool = True) -> DataFrame:
    """Block pairs that can hold an earlier article within twice the gap, with the times that can meet.

    Twice the gap loses nothing: an article and its candidate both lie within one gap of the anchor.
    Only occupied time cells are joined, by equality; a salt spreads the blocks of a hot cell.
    """
    reach = 2 * gap_seconds
    cells = blocked.groupBy("block", "bucket").agg(
        F.min("title_id").alias("lo"), F.max("title_id").alias("hi"),
        F.min("t").alias("t_lo"), F.max("t").alias("t_hi"),
    )
    near_buckets = F.transform(F.sequence(F.lit(-2), F.lit(2)), lambda d: F.col("bucket") + d)
    seekers = cells.select(
        F.col("block").alias("block_i"), F.col("hi"), F.col("t_lo").alias("ti_lo"), F.col("t_hi").alias("ti_hi"),
        F.explode(near_buckets).alias("bucket"),
    ).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_PAIR_SALTS - 1).cast("long"))))
    found = cells.select(
        F.col("block").alias("block_j"), "lo", F.col("t_lo").alias("tj_lo"), F.col("t_hi").alias("tj_hi"), "bucket",
        (F.col("block") % _PAIR_SALTS).alias("salt"),
    )
    near = (
        (F.col("lo") < F.col("hi"))
        & (F.col("tj_lo") <= F.col("ti_hi") + reach)
        & (F.col("tj_hi") >= F.col("ti_lo") - reach)
    )
    met = seekers.join(found, ["bucket", "salt"]).filter(near)
    if not with_self:
        met = met.filter("block_i <> block_j")
    return met.groupBy("block_i", "block_j").agg(
        (F.min("tj_lo") - reach).alias("i_from"), (F.max("tj_hi") + reach).alias("i_to"),
        (F.min("ti_lo") - reach).alias("j_from"), (F.max("ti_hi") + reach).alias("j_to"),
    )


def cosine_block(left: pd.DataFrame, right: pd.DataFrame, reach: int) -> np.ndarray:
    """Rounded cosines of two blocks; 0 where the times are more than ``reach`` seconds apart.

    Equal term counts compare as exactly 1; different ones stay below 1, so an identical article
    outranks any merely close one whatever the floating-point noise.
    """
    result = np.zeros((len(left), len(right)))
    if left.empty or right.empty:
        return result
    lengths_l, terms_l, weights_l = packed.unpack_vectors(left["vector"].tolist())
    lengths_r, terms_r, weights_r = packed.unpack_vectors(right["vector"].tolist())
    codes, _ = pd.factorize(np.concatenate([terms_l, terms_r]))
    codes_l, codes_r = codes[: len(terms_l)], codes[len(terms_l):]
    parts_l = np.split(np.arange(len(codes_l)), np.cumsum(lengths_l)[:-1])
    parts_r = np.split(np.arange(len(codes_r)), np.cumsum(lengths_r)[:-1])
    times_l, times_r = left["t"].to_numpy(), right["t"].to_numpy()
    # A strip of the right side, narrow in time, is laid out as a dense table for the rows it can meet.
    by_time = np.argsort(times_r, kind="stable")
    place = np.full(codes.max() + 1, -1)
    start = 0
    while start < len(by_time):
        strip = by_time[start : start + _STRIP_COLUMNS]
        used = np.concatenate([parts_r[j] for j in strip])
        shared = np.unique(codes_r[used])
        strip = strip[: max(1, _CELL_BUDGET // len(shared))]
        used = np.concatenate([parts_r[j] for j in strip])
        place[shared] = np.arange(len(shared))
        dense = np.zeros((len(shared), len(strip)))
        dense[place[codes_r[used]], np.repeat(np.arange(len(strip)), lengths_r[strip])] = weights_r[used]
        strip_times = times_r[strip]
        meets = (times_l >= strip_times[0] - reach) & (times_l <= strip_times[-1] + reach)
        for i in np.flatnonzero(meets):
            row = place[codes_l[parts_l[i]]]
            known = row >= 0
            result[i, strip] = weights_l[parts_l[i]][known] @ dense[row[known]]
        place[shared] = -1
        start += len(strip)
    sigs, _ = pd.factorize(np.concatenate([left["sig"].to_numpy(), right["sig"].to_numpy()]))
    same = sigs[: len(left), None] == sigs[None, len(left):]
    result = np.where(same, 1.0, np.minimum(result.round(COSINE_DIGITS), 1 - 10.0**-COSINE_DIGITS))
    return np.where(np.abs(times_l[:, None] - times_r[None, :]) <= reach, result, 0.0)


def compare_blocks(
    seekers: DataFrame,
    candidates: DataFrame,
    pairs: DataFrame,
    reduce: Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """Run ``reduce`` on every pair of blocks; a task never holds more than two blocks.

    Rows that are out of reach of the other block stay behind. A block is compared with itself by
    :func:`compare_within`, which moves its rows once.
    """
    spark = seekers.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    keys = ["block_i", "block_j"]

    def side(rows: DataFrame, own: str, other: str) -> DataFrame:
        at = pairs.select(
            F.col(f"block_{own}").alias("block"), F.col(f"block_{other}").alias("_other"),
            F.col(f"{own}_from").alias("_from"), F.col(f"{own}_to").alias("_to"),
        )
        joined = rows.join(at, "block").filter(F.col("t").between(F.col("_from"), F.col("_to")))
        # New column ids, since both sides can stem from the same table.
        columns = [F.col(name).alias(name) for name in rows.columns if name != "block"]
        return joined.select(
            *columns, F.col("block").alias(f"block_{own}"), F.col("_other").alias(f"block_{other}")
        ).repartition(tasks, *keys)

    left, right = side(seekers, "i", "j"), side(candidates, "j", "i")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(reduce, schema)


def compare_within(
    rows: DataFrame, reduce: Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Run ``reduce`` on every block as both sides of a pair."""

    def alone(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        return reduce((key[0], key[0]), block, block)

    return dealt_by_block(rows).groupBy("block").applyInPandas(alone, schema)


def dealt_by_block(rows: DataFrame) -> DataFrame:
    """Dealt by ranges of the running block numbers, so that no task gets several blocks while others get none."""
    return rows.repartitionByRange(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "block")


def cosine_pairs(
    blocked: DataFrame, gap_seconds: int, min_cosine: float = MIN_COSINE
) -> DataFrame:
    """Pairs ``(title_id, match_id, cosine, block_i, block_j)`` of different blocks with ``match_id < title_id``, times
    at most twice the gap apart and a rounded cosine above ``min_cosine``.

    Only pairs that pass leave a task; a join on shared terms would emit every pair once per term.
    """

    def reduce(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame(columns=["title_id", "match_id", "cosine", "block_i", "block_j"])
        cosine = cosine_block(left, right, 2 * gap_seconds)
        ids_l, ids_r = left["title_id"].to_numpy(), right["title_id"].to_numpy()
        i, j = np.nonzero((cosine > min_cosine) & (ids_r[None, :] < ids_l[:, None]))
        return pd.DataFrame(
            {"title_id": ids_l[i], "match_id": ids_r[j], "cosine": cosine[i, j], "block_i": key[0], "block_j": key[1]}
        )

    rows = blocked.select("title_id", "t", "vector", "sig", "block")
    schema = "title_id long, match_id long, cosine double, block_i long, block_j long"
    return compare_blocks(rows, rows, block_pairs(blocked, gap_seconds, with_self=False), reduce, schema)


def block_neighbours(blocked: DataFrame, gap_seconds: int, min_cosine: float = MIN_COSINE) -> DataFrame:
    """``title_id, t, title_lower, block, place, near, cosines``: the rows of every block, numbered in the order of their
    ids, each with the places and cosines of the earlier rows of its block that :func:`cosine_pairs` would report.

    The lists are bounded by the rows of a block; vectors stay behind.
    """
    columns = ["title_id", "t", "title_lower", "block"]
    schema = "title_id long, t long, title_lower string, block long, place int, near array<int>, cosines array<double>"

    def reduce(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("title_id", ignore_index=True)
        cosine = np.tril(cosine_block(block, block, 2 * gap_seconds), -1)
        i, j = np.nonzero(cosine > max(min_cosine, 0.0))
        cuts = np.searchsorted(i, np.arange(1, len(block)))
        return block[columns].assign(
            place=np.arange(len(block)), near=np.split(j.astype("int32"), cuts), cosines=np.split(cosine[i, j], cuts)
        )

    return dealt_by_block(blocked.select(*columns, "vector", "sig")).groupBy("block").applyInPandas(reduce, schema)


# ---------------------------------------------------------------- reports on vectors


def earlier_matches(
    articles: DataFrame,
    max_hours_gap: int = MAX_HOURS_GAP,
    min_cosine: float = MIN_COSINE,
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per article: how many earlier articles within the gap exceed the cosine, and the nearest one.

    ``title_id, matches, best_cosine, best_id``; ties go to the earliest article.
    """
    gap = max_hours_gap * 3600
    blocked = stored_blocks(articles, stop_words, gap, block_rows, titles=False)
    rows = blocked.select("title_id", "t", "vector", "sig", "block")

    def reduce(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values("title_id", ignore_index=True)
        if left.empty or right.empty:
            return pd.DataFrame(columns=["title_id", "matches", "cosine", "match_id"])
        cosine = cosine_block(left, right, gap)
        ids_l, ids_r = left["title_id"].to_numpy(), right["title_id"].to_numpy()
        cosine[(ids_r[None, :] >= ids_l[:, None]) | (cosine <= min_cosine)] = 0.0
        best = cosine.argmax(axis=1)
        out = pd.DataFrame(
            {
                "title_id": ids_l,
                "matches": (cosine > 0).sum(axis=1),
                "cosine": cosine[np.arange(len(left)), best],
                "match_id": ids_r[best],
            }
        )
        return out[out["matches"] > 0]

    schema = "title_id long, matches long, cosine double, match_id long"
    reduced = compare_blocks(rows, rows, block_pairs(blocked, gap, with_self=False), reduce, schema).unionByName(
        compare_within(rows, reduce, schema)
    )
    best = F.min_by(F.struct("cosine", "match_id"), F.struct(-F.col("cosine"), F.col("match_id")))
    return reduced.groupBy("title_id").agg(F.sum("matches").alias("matches"), best.alias("b")).select(
        "title_id", "matches", F.col("b.cosine").alias("best_cosine"), F.col("b.match_id").alias("best_id")
    )


def best_topic(
    articles: DataFrame,
    assigned: DataFrame,
    max_hours_gap: int = MAX_HOURS_GAP,
    min_cosine: float = MIN_COSINE,
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """For a given assignment of the earlier articles, the best topic of every article.

    ``assigned`` has ``title_id, anchor_id``. Result ``title_id, cosine, anchor_id``: the highest cosine
    to any earlier member whose anchor lies within the gap; ties go to the earliest anchor.
    """
    gap = max_hours_gap * 3600
    anchors = articles.select(
        F.col("title_id").alias("label_id"), F.unix_seconds("published_at").alias("label_t")
    )
    labels = assigned.withColumnRenamed("anchor_id", "label_id").join(anchors, "label_id").select(
        "title_id", "label_id", "label_t", F.col("label_t").isNotNull().alias("labelled")
    )
    blocked = stored_blocks(articles, stop_words, gap, block_rows, titles=False, beside=labels)
    # Whole numbers in every row, since a null would turn them into fractions on their way.
    nothing = F.lit(0).cast("long")
    rows = blocked.select(
        "title_id", "t", "vector", "sig", "block",
        F.coalesce("label_id", nothing).alias("label_id"), F.coalesce("label_t", nothing).alias("label_t"),
        F.coalesce("labelled", F.lit(False)).alias("labelled"),
    )
    reduce, schema = best_label_reducer(gap, min_cosine, ("label_id",)), "title_id long, cosine double, label_id long"
    pairs = block_pairs(blocked, gap, with_self=False)
    reduced = compare_blocks(
        rows.drop("label_id", "label_t", "labelled"), rows.filter("labelled"), pairs, reduce, schema
    ).unionByName(compare_within(rows, reduce, schema))
    return best_label(reduced, ["label_id"]).withColumnRenamed("label_id", "anchor_id")


def best_label_reducer(gap: int, min_cosine: float, carried: Sequence[str], keep_pair: bool = False):
    """Reducer of a block pair to the best eligible label per seeking article."""
    columns = ["title_id", "cosine", *carried, *(["block_i", "block_j"] if keep_pair else [])]

    def reduce(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right[right["labelled"].astype(bool)].sort_values("label_id", ignore_index=True)
        if left.empty or right.empty:
            return pd.DataFrame(columns=columns)
        cosine = cosine_block(left, right, 2 * gap)
        earlier = right["title_id"].to_numpy()[None, :] < left["title_id"].to_numpy()[:, None]
        fresh = np.abs(left["t"].to_numpy()[:, None] - right["label_t"].to_numpy()[None, :]) <= gap
        cosine[~(earlier & fresh) | (cosine <= min_cosine)] = 0.0
        best = cosine.argmax(axis=1)
        out = pd.DataFrame(
            {"title_id": left["title_id"].to_numpy(), "cosine": cosine[np.arange(len(left)), best]}
        )
        for name in carried:
            out[name] = right[name].to_numpy()[best]
        if keep_pair:
            out["block_i"], out["block_j"] = key
        return out[out["cosine"] > 0]

    return reduce


def best_label(reduced: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Best reduced row per article: highest cosine, then earliest label."""
    best = F.min_by(F.struct("cosine", *carried), F.struct(-F.col("cosine"), F.col("label_id")))
    return reduced.groupBy("title_id").agg(best.alias("b")).select("title_id", "b.*")
