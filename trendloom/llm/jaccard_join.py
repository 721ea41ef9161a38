"""All links between documents of Jaccard similarity 0.75 or more, by token-combination prefixes.

A document is its set of 5-word shingles. Shingles found in one distinct text only can't link anything;
rare ones are indexed one by one and frequent ones in pairs, and frequent ones come last in the common
order of all shingles. A document's prefix is extended until losing every signature in it would take more
missing shingles than a link allows:

    single shingles in the prefix + sum over groups of max(0, frequent shingles of the group in it - 1)
        >= n - ceil(0.75 n) + 1.

Take two linked documents and the one whose prefix ends first in the order. What the two share of that
prefix lies in the other's prefix as well, and less is missing than it takes, so they share a signature.
Groups split the frequent shingles by a hash and pairs are made inside a group only, so their number grows
with the size of a document and not with its square. The number of groups depends on the size class;
linked sizes differ by 4 / 3 at most, so each document uses the schemes of its class and the one before.

Candidates are compared word by word. Each list of documents with the same signature has a hub, the document
with the smallest share of shingles of its own, and everything in the list is first compared with it. What
lies in one component then needs no further comparison. The members of all lists of a hub that are still
apart from it meet all other members in tiles of bounded size, and a tile passes on one link for each
document and component. Components come out the same as from all pairs.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm import keys
from trendloom.llm.graph import components
from trendloom.llm.shared import cores, held, row_name, written
from trendloom.llm.word_hashes import MIX, WordHasher, runs, scramble, shingle_hashes

SHINGLE = 5
# Shingles of more distinct texts than this are frequent and indexed in pairs.
FREQUENT = 32
# About one group of frequent shingles for so many shingles of a document.
GROUP_SHINGLES = 32
# Documents on either side of a tile, and shingles compared at a time there.
TILE, TILE_SHINGLES = 512, 4096
UNIQUE, RARE, COMMON = 0, 1, 2
SIGNATURES = "key string, doc_id bigint, node bigint, n bigint, m bigint, signature bigint, text binary"
PACKED = "bucket int, chunk int, payload binary"


def allowed_missing(n: int) -> int:
    """How many of ``n`` shingles a linked document may lack: n - ceil(0.75 n)."""
    return n - (3 * n + 3) // 4


def size_class(n: int) -> int:
    return int(math.log(n) / math.log(4 / 3) + 1e-9)


def groups_of_class(c: int) -> int:
    """Groups of frequent shingles in the scheme shared by size classes c and c + 1."""
    return max(1, int((4 / 3) ** c / GROUP_SHINGLES))


def signatures(shingles: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Signatures of a document from its distinct shingles and their classes."""
    n = len(shingles)
    if n == 1:
        return shingles if kinds[0] != UNIQUE else shingles[:0]
    order = np.lexsort((shingles, kinds))
    shingles, kinds = shingles[order], kinds[order]
    need = allowed_missing(n) + 1
    prefix = slice(0, min(need, int((kinds < COMMON).sum())))
    single = shingles[prefix][kinds[prefix] == RARE]
    need -= prefix.stop
    if need <= 0:
        return single
    common, found = shingles[prefix.stop :], [single]
    for scheme in (size_class(n) - 1, size_class(n)):
        many = groups_of_class(scheme)
        group = ((common >> np.uint64(7)) % np.uint64(many)).astype(np.int64)
        # The k-th shingle of a group in the prefix counts from k = 2 on.
        by_group = np.argsort(group, kind="stable")
        starts = np.concatenate([[0], np.flatnonzero(np.diff(group[by_group])) + 1])
        rank = np.empty(len(common), np.int64)
        rank[by_group] = np.arange(len(common)) - np.repeat(starts, np.diff(np.append(starts, len(common))))
        end = int(np.searchsorted(np.cumsum(rank > 0), need)) + 1
        salt = np.uint64((0x9E3779B97F4A7C15 * (scheme + 1000)) % 2**64)
        members = [common[:end][group[:end] == g] for g in np.unique(group[:end])]
        for tokens in members:
            first, second = np.triu_indices(len(tokens), 1)
            found.append(scramble((tokens[first] * MIX + tokens[second]) ^ salt))
    return np.unique(np.concatenate(found))


class Shingled:
    """Distinct shingles of each text of a chunk that stands for its copies."""

    def __init__(self, table, chosen: dict[tuple[int | None, str], int]):
        hasher, self.rows = WordHasher(), []
        words, seen = [], set()
        for doc_id, text in zip(*(table.column(c).to_pylist() for c in ("doc_id", "text"))):
            key = hashlib.sha256(text or b"").hexdigest()
            if (doc_id, key) in chosen and (doc_id, key) not in seen:
                seen.add((doc_id, key))
                self.rows.append((key, doc_id, chosen[doc_id, key], text))
                words.append((text or b"").lower().split())
        count = np.array([len(w) for w in words], np.int64)
        hashes = hasher([w for text in words for w in text])
        first = np.cumsum(count) - count
        self.text_of, self.shingles = [], []
        owner = np.repeat(np.arange(len(words)), count)
        at = np.arange(max(len(hashes) - SHINGLE + 1, 0))
        at = at[owner[at] == owner[at + SHINGLE - 1]] if len(at) else at
        found, owners = [runs(hashes, SHINGLE)[at]], [owner[at]]
        for k in np.flatnonzero((count > 0) & (count < SHINGLE)).tolist():
            found.append(shingle_hashes(hashes[first[k] : first[k] + count[k]], SHINGLE))
            owners.append(np.array([k]))
        found, owners = np.concatenate(found), np.concatenate(owners)
        order = np.lexsort((found, owners))
        found, owners = found[order], owners[order]
        new = np.ones(len(found), bool)
        new[1:] = (found[1:] != found[:-1]) | (owners[1:] != owners[:-1])
        self.shingles, self.text_of = found[new], owners[new]
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(self.text_of, minlength=len(words)))]).astype(np.int64)

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys, in how many texts each is (255 at most), and the key of each shingle."""
        key, which, count = np.unique(self.shingles >> np.uint64(64 - keys.KEY_BITS), return_inverse=True, return_counts=True)
        return key, np.minimum(count, 255).astype(np.uint8), which


def _table(rows: list[tuple], kinds: list, names: list[str]):
    import pyarrow as pa

    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def dealt_texts(docs: DataFrame, chunks: int) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text.cast("binary").alias("text"),
        keys.chunk_of(F.col("doc_id"), text, chunks).alias("chunk"),
    )


def index(docs: DataFrame, chunk_chars: int, bucket_chars: int) -> tuple[DataFrame, DataFrame]:
    """(ids, signatures): the first has (doc_id, key) of every row; the second a row for each distinct
    text (signature null; n shingles, m of them in other texts too) and one for each of its signatures.
    A text has a number of its own, ``node``, as ids can be null or stand for several texts. Texts with
    signatures are kept packed."""
    chunks, buckets = keys.sizes(docs, chunk_chars, bucket_chars)
    texts = dealt_texts(docs, chunks)
    ids = texts.select("doc_id", F.sha2(F.coalesce("text", F.lit(b"")), 256).alias("key"), "chunk")
    # Copies of a text have the same set; the one with the smallest id stands for them, one without an id
    # only if none has one. The numbers are final once they are written.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "chunk")).alias("first")
    chosen = written(
        ids.groupBy("key").agg(first).select("key", "first.doc_id", "first.chunk", F.monotonically_increasing_id().alias("node")),
        cores(docs),
    )
    chosen = chosen.select("chunk", F.lit(-1).alias("bucket"), F.lit(None).cast("binary").alias("payload"), "doc_id", "key", "node")

    def chosen_here(rows: list[dict]) -> dict:
        return {(r["doc_id"], r["key"]): r["node"] for r in rows if r["bucket"] < 0}

    def packed(rows):
        import pyarrow as pa

        return _table(rows, [pa.int32(), pa.int32(), pa.binary()], ["bucket", "chunk", "payload"])

    def count(table, told):
        chosen_rows = chosen_here(told.to_pylist())
        if not table.num_rows or not chosen_rows:
            return packed([])
        chunk = table.column("chunk")[0].as_py()
        key, many, _ = Shingled(table, chosen_rows).keys()
        return packed([(b, chunk, p) for b, p in keys.send([key, many], buckets)])

    def classify(table):
        rows = table.to_pylist()
        found = keys.Gathered([r["payload"] for r in rows], [np.uint64, np.uint8])
        texts_with = found.reduce(np.add, found.columns[1].astype(np.int64))
        kind = np.where(texts_with > FREQUENT, COMMON, np.where(texts_with > 1, RARE, UNIQUE)).astype(np.uint8)
        return packed([(r["bucket"], r["chunk"], keys.pack_answer(a)) for r, a in zip(rows, found.answers(kind)) if a.any()])

    def sign(table, told):
        import pyarrow as pa
        import zstandard

        rows = told.to_pylist() if table.num_rows else []
        chosen_rows = chosen_here(rows)
        out = []
        if chosen_rows:
            found = Shingled(table, chosen_rows)
            key, _, which = found.keys()
            kinds = keys.received(key, buckets, [(r["bucket"], r["payload"]) for r in rows if r["bucket"] >= 0])[which]
            squeeze = zstandard.ZstdCompressor(level=3).compress
            for k, (sha, doc_id, node, text) in enumerate(found.rows):
                part = slice(found.ends[k], found.ends[k + 1])
                n = part.stop - part.start
                marks = signatures(found.shingles[part], kinds[part]) if n else ()
                m = int((kinds[part] != UNIQUE).sum())
                out.append((sha, doc_id, node, n, m, None, squeeze(text) if len(marks) else None))
                out.extend((None, None, node, n, m, mark, None) for mark in np.asarray(marks, np.uint64).view(np.int64).tolist())
        kinds_out = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return _table(out, kinds_out, ["key", "doc_id", "node", "n", "m", "signature", "text"])

    by_chunk = texts.groupBy("chunk")
    counted = by_chunk.cogroup(chosen.groupBy("chunk")).applyInArrow(count, PACKED)
    kinds = counted.groupBy("bucket").applyInArrow(classify, PACKED)
    none = F.lit(None)
    told = kinds.select(
        "chunk", "bucket", "payload", none.cast("bigint").alias("doc_id"), none.cast("string").alias("key"), none.cast("bigint").alias("node")
    )
    signed = by_chunk.cogroup(told.unionAll(chosen).groupBy("chunk")).applyInArrow(sign, SIGNATURES)
    return ids.drop("chunk"), held(signed)


def shingle_set(text: bytes) -> set[tuple[bytes, ...]]:
    """The shingles of a packed text."""
    import zstandard

    words = zstandard.ZstdDecompressor().decompress(text).lower().split()
    k = min(SHINGLE, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def compared(pairs: DataFrame, packed_texts: DataFrame) -> DataFrame:
    """(a, b) of the pairs that are linked, by their shingles themselves."""

    def check(batches):
        import pyarrow as pa

        memory, held = {}, 0
        for batch in batches:
            linked = []
            for a, b, text_a, text_b in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))):
                if held > 100_000:
                    memory, held = {}, 0
                for text in (text_a, text_b):
                    if text not in memory:
                        memory[text] = shingle_set(text)
                        held += len(memory[text])
                one, other = memory[text_a], memory[text_b]
                both = len(one & other)
                if 100 * both >= 75 * (len(one) + len(other) - both):
                    linked.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in linked], pa.int64()) for k in (0, 1)], ["a", "b"])

    return (
        pairs.join(packed_texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .join(packed_texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b").mapInArrow(check, "a bigint, b bigint")
    )


def tile_links(table):
    """Links between the two sides of a tile, one for each document apart and component it leads to."""
    import pyarrow as pa

    columns = {c: table.column(c).to_pylist() for c in ("side", "node", "component", "text")}
    sets = [shingle_set(t) for t in columns["text"]]
    apart = [k for k, side in enumerate(columns["side"]) if side == 0]
    others = [k for k, side in enumerate(columns["side"]) if side == 1]
    linked = []
    if apart and others:
        shared = set().union(*(sets[k] for k in apart)) & set().union(*(sets[k] for k in others))
        number = {s: i for i, s in enumerate(shared)}

        def places(side: list[int]) -> tuple[np.ndarray, np.ndarray]:
            found = [[number[s] for s in sets[k] if s in number] for k in side]
            at = np.fromiter((x for f in found for x in f), np.int64)
            order = np.argsort(at, kind="stable")
            return np.repeat(np.arange(len(side)), [len(f) for f in found])[order], at[order]

        rows, at = places(apart)
        other_rows, other_at = places(others)
        both = np.zeros((len(apart), len(others)), np.float32)
        for first in range(0, len(number), TILE_SHINGLES):
            one, other = (np.zeros((len(side), TILE_SHINGLES), np.float32) for side in (apart, others))
            for matrix, r, c in ((one, rows, at), (other, other_rows, other_at)):
                inside = slice(*np.searchsorted(c, [first, first + TILE_SHINGLES]))
                matrix[r[inside], c[inside] - first] = 1
            both += one @ other.T
        size = np.array([len(s) for s in sets])
        components_of = np.array(columns["component"])
        union = size[apart][:, None] + size[others][None, :] - both
        hit = (100 * both >= 75 * union) & (components_of[apart][:, None] != components_of[others][None, :])
        for i, k in enumerate(apart):
            partners = np.array(others)[hit[i]]
            _, first_of = np.unique(components_of[partners], return_index=True)
            linked += [(columns["node"][k], columns["node"][p]) for p in partners[first_of].tolist()]
    return pa.Table.from_arrays([pa.array([p[k] for p in linked], pa.int64()) for k in (0, 1)], ["a", "b"])


def tiles(members: DataFrame, packed_texts: DataFrame) -> DataFrame:
    """Links between members of a hub that are apart from it and all its other members.

    ``members`` is (hub, node, n, m, component, hub_component) without the hubs themselves.
    """
    # What is linked to y has at least 3/7 (n + the least size a partner can have) of y's shared shingles.
    can_link = 7 * F.col("m") >= 3 * (F.col("n") + F.ceil(0.75 * F.col("n")))
    members = members.where(can_link).withColumn("apart", F.col("component") != F.col("hub_component"))
    counts = members.groupBy("hub").agg(
        F.count(F.lit(1)).alias("others"), F.sum(F.col("apart").cast("int")).alias("aparts")
    ).where("aparts > 0 and others > 1")
    counts = counts.select(
        "hub", F.ceil(F.col("aparts") / TILE).cast("int").alias("rows"), F.ceil(F.col("others") / TILE).cast("int").alias("columns")
    )
    placed = members.join(counts, "hub").withColumn("place", F.xxhash64("node"))
    whole = F.lit(0)
    rows = placed.where("apart").select(
        "hub", F.pmod("place", F.col("rows")).alias("row"), F.explode(F.sequence(whole, F.col("columns") - 1)).alias("column"),
        F.lit(0).alias("side"), "node", "component",
    )
    columns = placed.select(
        "hub", F.explode(F.sequence(whole, F.col("rows") - 1)).alias("row"), F.pmod("place", F.col("columns")).alias("column"),
        F.lit(1).alias("side"), "node", "component",
    )
    return rows.select("hub", F.col("row").cast("int").alias("row"), "column", "side", "node", "component").unionAll(
        columns.select("hub", "row", F.col("column").cast("int").alias("column"), "side", "node", "component")
    ).join(packed_texts, "node").groupBy("hub", "row", "column").applyInArrow(tile_links, "a bigint, b bigint")


def near_components(signed: DataFrame) -> DataFrame:
    """(node, component) of the linked texts among those in the signature table."""
    marks = signed.where("signature is not null").select("signature", "node", "n", "m")
    # The hub has few shingles of its own, so it is likely to be linked to most of its list.
    hubs = marks.groupBy("signature").agg(
        F.max(F.struct((F.col("m") / F.col("n")).alias("share"), (-F.col("node")).alias("first"), "node", "n", "m")).alias("hub"),
        F.count(F.lit(1)).alias("members"),
    ).where("members > 1").select(
        "signature", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.m").alias("hub_m")
    )
    members = held(marks.join(hubs, "signature").where("node <> hub").drop("signature").distinct())
    packed_texts = signed.where("text is not null").select("node", "text")
    # An intersection has at least 3/7 of both sizes together, and only shingles that others have too.
    fits = 7 * F.least("m", "hub_m") >= 3 * (F.col("n") + F.col("hub_n"))
    pairs = members.where(fits).select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    links = held(compared(pairs, packed_texts))
    named = components(links)
    placed = (
        members.join(named.select(F.col("node").alias("node"), "component"), "node", "left")
        .join(named.select(F.col("node").alias("hub"), F.col("component").alias("hub_component")), "hub", "left")
        .select("hub", "node", "n", "m", F.coalesce("component", "node").alias("component"), F.coalesce("hub_component", "hub").alias("hub_component"))
    )
    more = held(tiles(placed, packed_texts))
    named = named if more.isEmpty() else components(links.unionAll(more))
    for table in (members, links, more):
        table.unpersist()
    return named


def component_of_texts(
    docs: DataFrame, chunk_chars: int = keys.CHUNK_CHARS, bucket_chars: int = keys.BUCKET_CHARS
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key) of every row, and (key, doc_id, n, component, leads) of every distinct text, from a written table.

    ``component`` is the smallest id in it, null if none has one; ``leads`` is true for one text of each.
    """
    ids, signed = index(docs, chunk_chars, bucket_chars)
    named = near_components(signed)
    sets = signed.where("key is not null").select("key", "doc_id", "node", "n")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("first")
    led = named.join(sets.select("node", "doc_id"), "node").groupBy("component").agg(first)
    named = named.join(led, "component").select("node", "first")
    alone = F.col("first").isNull()
    sets = written(
        sets.join(named, "node", "left").select(
            "key", "doc_id", "n", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component"),
            (alone | (F.col("first.node") == F.col("node"))).alias("leads"),
        ),
        cores(docs),
    )
    signed.unpersist()
    return ids, sets


def linked_documents(
    docs: DataFrame, chunk_chars: int = keys.CHUNK_CHARS, bucket_chars: int = keys.BUCKET_CHARS
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Words are separated by ASCII white space; A to Z count as lower case. A document's set has its distinct
    runs of five words; fewer words are one run. Two documents are linked if 100 * intersection >=
    75 * union. ``component_id`` is the smallest id that links lead to. Texts without words, and null,
    have no shingles and are linked with nothing, not even with each other; their component is their own
    id. Repeated rows are linked as equal texts are, and rows with one id and different texts each as
    their text is. Rows with a null ``doc_id`` are linked like others, but null is no id to lead to: where
    no linked row has an id the component is null. An empty table gives no rows.
    """
    ids, sets = component_of_texts(docs, chunk_chars, bucket_chars)
    return ids.join(sets.drop("doc_id"), "key").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
    )


def one_of_each_component(docs: DataFrame, **sizes: int) -> DataFrame:
    """The rows of ``docs`` that stay: of every component the document with the smallest id.

    Documents without words are in no component and stay. Of repeated rows one stays; of rows without an id
    one stays if no row with an id is linked to it.
    """
    _, sets = component_of_texts(docs, **sizes)
    stay = sets.where("n > 0 and leads").select(
        row_name(F.col("doc_id")).alias("_row_id"), F.col("key").alias("_row_key")
    )
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    keyed = docs.withColumns({"_row_key": F.sha2(text, 256), "_row_id": row_name(docs["doc_id"]), "_empty": ~text.rlike(r"[^\x20\x09-\x0D]")})
    # Joined and made distinct by the same plain columns, texts move once.
    kept = keyed.where(~F.col("_empty")).join(stay, ["_row_key", "_row_id"]).dropDuplicates(["_row_key", "_row_id"])
    return kept.select(*docs.columns).unionAll(keyed.where("_empty").select(*docs.columns))
