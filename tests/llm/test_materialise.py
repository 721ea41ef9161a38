"""Shards against plain encoding; the permutation against its definition."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from trendloom.llm.materialise import END, LENGTH, PAD, PER_SHARD, feistel, read_from, slot_index, training_shards, write_shards
from trendloom.llm.queries import training_order
from trendloom.llm.tokens import default_tokenizer

SCHEMA = "doc_id long, text string, slot string, part int"


@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(size):
    slots = feistel(np.arange(size), size)
    assert sorted(slots.tolist()) == list(range(size))
    assert size < 16 or slots.tolist() != feistel(np.arange(size), size, key=1).tolist()
    assert feistel(np.arange(size)[::-1], size).tolist() == slots[::-1].tolist()


def test_order_is_well_mixed():
    slots = feistel(np.arange(5000), 5000)
    assert abs(np.corrcoef(np.arange(5000), slots)[0, 1]) < 0.05


def expected(texts, length):
    tokenizer, out = Tokenizer.from_file(default_tokenizer()), []
    for d, t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [END]
        for piece in range(-(-len(ids) // length)):
            part = ids[piece * length : (piece + 1) * length]
            raw = np.array(part + [PAD] * (length - len(part)), "<u2").tobytes()
            out.append((d, piece, len(part), zlib.crc32(raw)))
    return sorted(out, key=str)


def test_shards_and_resuming(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    write_shards(training_shards(docs, length=128, per_shard=16), str(tmp_path / "shards"))
    shards = spark.read.parquet(str(tmp_path / "shards"))
    rows = slot_index(shards).collect()
    assert sorted(((r.doc_id, r.piece, r.n_tokens, r.ids_crc32) for r in rows), key=str) == expected(texts, 128)
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert all(r.shard == r.slot // 16 and r.byte_offset == r.slot % 16 * 256 for r in rows)
    for s in shards.collect():
        assert len(s.payload) == s.n_sequences * s.stride and [e.slot for e in s.entries] == list(range(s.first_slot, s.first_slot + s.n_sequences))
    crc = {r.slot: r.ids_crc32 for r in rows}
    for slot in (0, 37, len(rows) - 1):
        rest = {r.slot: zlib.crc32(bytes(r.ids)) for r in read_from(shards, slot, per_shard=16).collect()}
        assert rest == {k: v for k, v in crc.items() if k >= slot}


def test_query_reads_the_shards_it_wrote(spark, sf_dir):
    index = training_order(spark, sf_dir)
    files = index.inputFiles()
    assert files and all("/shards-" in f for f in files)
    shards = spark.read.parquet(*files)
    rows, held = index.collect(), shards.selectExpr("sum(n_sequences) AS n", "sum(length(payload)) AS bytes").first()
    assert held.n == len(rows) and held.bytes == len(rows) * 2 * LENGTH
    assert sorted(r.slot for r in read_from(shards, PER_SHARD // 2).collect()) == list(range(PER_SHARD // 2, len(rows)))


def test_defined_cases(spark):
    texts = [(1, None), (2, ""), (None, "a b c"), (4, "x " * 5000), (4, "x " * 5000), (5, "one")]
    docs = spark.createDataFrame([(d, t, "s", 0) for d, t in texts], SCHEMA)
    rows = slot_index(training_shards(docs)).collect()
    assert sorted(((r.doc_id, r.piece, r.n_tokens, r.ids_crc32) for r in rows), key=str) == expected(texts, 1024)
    assert slot_index(training_shards(docs.where("doc_id > 10"))).count() == 0


def test_materialised_deletes_the_unpadded_sequences(spark, tmp_path):
    import glob

    from trendloom.llm.materialise import materialised
    from trendloom.session import ensure_checkpoint_dir

    docs = spark.createDataFrame([(1, "a b c", "s", 0), (2, None, "s", 0)], SCHEMA)
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{base}/sequences-*"))
    shards = materialised(docs, str(tmp_path / "shards"), length=128, per_shard=16)
    rows = slot_index(shards).collect()
    assert sorted(((r.doc_id, r.piece, r.n_tokens, r.ids_crc32) for r in rows), key=str) == expected([(1, "a b c"), (2, None)], 128)
    assert set(glob.glob(f"{base}/sequences-*")) == before
