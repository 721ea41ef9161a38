"""Exact duplicates by chunk recipes, with built-in functions only.

A text is cut where its content says so: a chunk ends after ``MIN_CHUNK`` characters with the first sentence
or line end behind two marked letters, or at ``MAX_CHUNK`` characters. One letter in four is marked, so about
one sentence in sixteen ends a chunk, and behind an insertion the cuts soon fall into the old places. A chunk's digest is 64 bits long. The chunk
dictionary holds every distinct chunk once and shows which digests stand for more than one content;
their chunks are numbered, so digest and number together identify a content without doubt. The recipe
of a text is the list of its chunks' identifiers, and texts are equal if their recipes are. Long texts
move once, as distinct chunks; all later steps move recipes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trendloom.llm.shared import cores, row_name, written

MIN_CHUNK, MAX_CHUNK = 256, 8192
# Every fourth letter or digit up to U+00FF, and a part of the letters of some other scripts.
MARKED = "".join(chr(c) for c in range(0x30, 0x100, 4) if chr(c).isalnum()) + "α-ζа-зا-د一-拿"
# One way or the other every position matches, so the chunks of a text joined give the text.
CHUNK = rf"(?s).{{{MIN_CHUNK}}}.{{0,{MAX_CHUNK - MIN_CHUNK - 1}}}?[.!?。\n](?<=[{MARKED}]{{2}}.)|.{{1,{MAX_CHUNK}}}"


def content_chunks(text: Column) -> Column:
    """The chunks of a text in order; none for an empty text."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def clashing_chunks(chunks: DataFrame) -> DataFrame | None:
    """Chunks whose digest also stands for another chunk: (digest, chunk, variant), from (digest, chunk).

    None if there are none, as it almost always is. Copies are folded before the shuffle.
    """
    dictionary = chunks.groupBy("digest", "chunk").agg(F.count(F.lit(1)).alias("uses"))
    several = dictionary.groupBy("digest").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1")
    several = written(several.select("digest"), cores(chunks))
    if several.isEmpty():
        return None
    order = Window.partitionBy("digest").orderBy("chunk")
    return written(
        dictionary.join(several, "digest", "left_semi")
        .select("digest", "chunk", F.row_number().over(order).alias("variant")),
        cores(chunks),
    )


def recipes(docs: DataFrame, digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(doc_id, text_sha256, recipe) of every row; a recipe is a list of (digest, variant)."""
    texts = docs.select(
        F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    chunks = texts.select(F.explode(content_chunks(F.col("text"))).alias("chunk"))
    clashes = clashing_chunks(chunks.select(digest(F.col("chunk")).alias("digest"), "chunk"))
    plain = texts.select(
        "doc_id", F.sha2("text", 256).alias("text_sha256"),
        F.transform(
            content_chunks(F.col("text")), lambda c: F.struct(digest(c).alias("digest"), F.lit(1).alias("variant"))
        ).alias("recipe"),
    )
    if clashes is None:
        return plain
    # Number the chunks of clashing digests. The texts themselves tell which rows are the same.
    told = texts.select("text", F.posexplode(content_chunks(F.col("text"))).alias("place", "chunk")).distinct()
    told = (
        told.withColumn("digest", digest(F.col("chunk"))).join(clashes, ["digest", "chunk"], "left")
        .groupBy("text").agg(F.array_sort(F.collect_list(
            F.struct("place", "digest", F.coalesce("variant", F.lit(1)).alias("variant")))).alias("parts"))
    )
    return texts.join(told, "text", "left").select(
        "doc_id", F.sha2("text", 256).alias("text_sha256"),
        F.transform(
            F.coalesce("parts", F.array().cast("array<struct<place:int,digest:bigint,variant:int>>")),
            lambda p: F.struct(p["digest"].alias("digest"), p["variant"].alias("variant")),
        ).alias("recipe"),
    )


def exact_groups(docs: DataFrame, digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Uses ``doc_id`` and ``text`` only. Null counts as the empty text; empty texts are copies of each
    other. Of equal texts the row with the largest ``doc_id`` stays; a null ``doc_id`` is smaller than
    any other. Of repeated rows one stays. An empty table gives no rows.
    """
    rows = recipes(docs, digest).groupBy("doc_id", "text_sha256", "recipe").agg(F.count(F.lit(1)).alias("copies"))
    groups = rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    return (
        rows.join(groups, "recipe")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
        .select(
            "doc_id", "keep_id", "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256",
        )
    )


def drop_exact_copies(docs: DataFrame, digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """The rows that stay, with the columns of ``docs``. Of repeated rows any one stays."""
    names = docs.columns
    # Equal recipes are equal texts, so a group has one checksum.
    stay = recipes(docs, digest).groupBy("recipe", "text_sha256").agg(F.max("doc_id").alias("_stay_id")).select(
        row_name(F.col("_stay_id")).alias("_row_id"), F.col("text_sha256").alias("_row_sha")
    )
    # Joined and made distinct by the same plain columns, texts move once.
    sha = F.sha2(F.coalesce(docs["text"].cast("string"), F.lit("")), 256)
    keyed = docs.withColumns({"_row_sha": sha, "_row_id": row_name(docs["doc_id"])})
    return keyed.join(stay, ["_row_sha", "_row_id"]).dropDuplicates(["_row_sha", "_row_id"]).select(*names)
