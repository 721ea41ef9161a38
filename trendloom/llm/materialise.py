"""Token sequences in training order: a keyed permutation gives every sequence its slot, shards hold fixed strides.

Documents become sequences of ``length`` ids. Sequences are numbered without gaps, a Feistel network with
cycle-walking permutes the numbers, and the result is the place in the training order. Shards of a fixed
number of places are written by range partitions; sequence s lies in shard s // ``per_shard`` at byte
(s % ``per_shard``) * ``length`` * 2, so a reader can go on from any place.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trendloom.llm.shared import written
from trendloom.llm.tokens import default_tokenizer, process_encoder
from trendloom.session import ensure_checkpoint_dir

LENGTH = 1024
PER_SHARD = 256
KEY = 20_240_229
ROUNDS = 6
PAD, END = 0, 1


def feistel(numbers: np.ndarray, size: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """A keyed permutation of 0 to ``size`` - 1, for each of ``numbers``.

    The network permutes the numbers of 2b bits, the least even number of bits that holds ``size``.
    What falls outside is put through again until it falls inside; fewer than four times on average.
    """
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = np.asarray(numbers, np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in range(rounds):
            h = (right + np.uint64((key * 0x9E3779B97F4A7C15 + k * 0xD1B54A32D192ED03) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((h ^ (h >> np.uint64(29))) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def sequences(docs: DataFrame, tokenizer_path: str | None = None, length: int = LENGTH) -> DataFrame:
    """(part, local, doc_id, piece, n_tokens, ids): each document's ids and END, cut into sequences.

    ``part`` is the task that made the row and ``local`` its number there. Ids are little-endian unsigned
    16-bit, which holds vocabularies up to 65,536. ``ids`` holds the ``n_tokens`` ids only; the shards pad.
    """
    path = tokenizer_path or default_tokenizer()

    def cut(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, local, encoder = TaskContext.get().partitionId(), 0, process_encoder(path)
        for batch in batches:
            doc_ids, column = batch.column("doc_id").to_pylist(), batch.column("text")
            for at in range(0, len(doc_ids), 128):
                rows = []
                for doc_id, ids in zip(doc_ids[at : at + 128], encoder.encode_all(column.slice(at, 128).to_pylist())):
                    if len(ids) and ids.max() > 0xFFFF:
                        raise ValueError("ids beyond 16 bits: the shards hold 16-bit ids")
                    tokens = len(ids) + 1
                    raw = np.concatenate([ids, [END]]).astype("<u2").tobytes()
                    for piece in range(-(-tokens // length)):
                        n = min(length, tokens - piece * length)
                        rows.append((part, local, doc_id, piece, n, raw[2 * piece * length : 2 * piece * length + 2 * n]))
                        local += 1
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                names = ["part", "local", "doc_id", "piece", "n_tokens", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        cut, "part int, local bigint, doc_id bigint, piece int, n_tokens int, ids binary"
    )


def with_slots(rows: DataFrame, key: int = KEY) -> DataFrame:
    """Add ``slot`` and drop part and local. ``rows`` must come from a written table, so numbers are final."""
    ends = rows.groupBy("part").agg((F.max("local") + 1).alias("n"))
    # One row per task that wrote the table.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = written(ends.select("part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), 1)
    size = firsts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    @F.pandas_udf("bigint")
    def slot(numbers: pd.Series) -> pd.Series:
        return pd.Series(feistel(numbers.to_numpy(), size, key))

    numbered = rows.join(firsts.select("part", "first"), "part").select(
        "doc_id", "piece", "n_tokens", "ids", (F.col("first") + F.col("local")).alias("number")
    )
    # Only the numbers go to Python; the ids stay where they are.
    return numbered.withColumn("slot", slot("number")).drop("number")


def training_shards(
    docs: DataFrame, tokenizer_path: str | None = None, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY,
    scratch: str | None = None,
) -> DataFrame:
    """One row per shard: shard, first_slot, n_sequences, stride (bytes), payload, entries.

    ``payload`` is the ids of the shard's sequences in slot order, each padded with PAD to ``length``;
    ``entries`` lists (slot, doc_id, piece, n_tokens) in the same order. Null and empty texts give one
    sequence with END alone. A null ``doc_id`` stays null. Repeated rows have sequences of their own. An
    empty table gives no shards. Columns other than doc_id and text are left out.

    The unpadded sequences are written first, compressed, to ``scratch`` (a fresh folder under the shared
    checkpoint folder if not given); :func:`materialised` deletes it once the shards are written.
    """
    spark = docs.sparkSession
    scratch = scratch or f"{ensure_checkpoint_dir(spark)}/sequences-{uuid.uuid4().hex}"
    cut = sequences(docs, tokenizer_path, length)
    cut.write.option("compression", "zstd").parquet(scratch)
    rows = with_slots(spark.read.schema(cut.schema).parquet(scratch), key)
    rows = rows.withColumn("shard", F.floor(F.col("slot") / per_shard))
    # A shard's rows stay together, and a range of shards comes in order.
    dealt = rows.repartitionByRange("shard").sortWithinPartitions("slot")

    def assemble(batches):
        import pyarrow as pa

        entry = pa.list_(pa.struct([("slot", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("n_tokens", pa.int32())]))
        names = ["shard", "first_slot", "n_sequences", "stride", "payload", "entries"]

        def shard_row(shard, held):
            entries = [{"slot": s, "doc_id": d, "piece": p, "n_tokens": n} for s, d, p, n, _ in held]
            # PAD is id 0: a sequence is its ids and then zero bytes up to the stride
            payload = b"".join(h[4].ljust(2 * length, b"\0") for h in held)
            values = (shard, held[0][0], len(held), 2 * length, payload, entries)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), entry)
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        shard, held = None, []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("shard", "slot", "doc_id", "piece", "n_tokens", "ids")]
            for number, *row in zip(*columns):
                if number != shard and held:
                    yield shard_row(shard, held)
                    held = []
                shard = number
                held.append(row)
        if held:
            yield shard_row(shard, held)

    return dealt.select("shard", "slot", "doc_id", "piece", "n_tokens", "ids").mapInArrow(
        assemble,
        "shard bigint, first_slot bigint, n_sequences int, stride int, payload binary, "
        "entries array<struct<slot:bigint,doc_id:bigint,piece:int,n_tokens:int>>",
    )


def write_shards(shards: DataFrame, path: str) -> None:
    """Write the shards, ordered within each file; files come in the order of their shards."""
    shards.write.parquet(path)


def materialised(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """The shards of :func:`training_shards` written to ``path`` and read back; the unpadded sequences are deleted after.

    ``path`` is a fresh folder under the shared checkpoint folder if not given. ``options`` go to
    :func:`training_shards`.
    """
    spark = docs.sparkSession
    base = ensure_checkpoint_dir(spark)
    scratch, path = f"{base}/sequences-{uuid.uuid4().hex}", path or f"{base}/shards-{uuid.uuid4().hex}"
    shards = training_shards(docs, scratch=scratch, **options)
    write_shards(shards, path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(scratch)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return spark.read.schema(shards.schema).parquet(path)


def stored(shards: DataFrame) -> DataFrame:
    """The shards written to a fresh folder that all executors share, as a table of these files."""
    path = f"{ensure_checkpoint_dir(shards.sparkSession)}/shards-{uuid.uuid4().hex}"
    write_shards(shards, path)
    return shards.sparkSession.read.schema(shards.schema).parquet(path)


def read_from(shards: DataFrame, slot: int, per_shard: int = PER_SHARD) -> DataFrame:
    """(slot, ids) of all sequences from ``slot`` on; earlier shards are skipped by the scan."""
    rows = shards.where(F.col("shard") >= slot // per_shard).select("payload", "stride", F.posexplode("entries").alias("place", "e"))
    return rows.where(F.col("e.slot") >= slot).select(
        F.col("e.slot").alias("slot"), F.expr("substring(payload, place * stride + 1, stride)").alias("ids")
    )


def slot_index(shards: DataFrame) -> DataFrame:
    """One row per sequence: slot, shard, byte_offset, doc_id, piece, n_tokens, ids_crc32 of the padded ids."""
    rows = shards.select("shard", "payload", "stride", F.posexplode("entries").alias("place", "e"))
    return rows.select(
        F.col("e.slot").alias("slot"), "shard", (F.col("place").cast("bigint") * F.col("stride")).alias("byte_offset"),
        F.col("e.doc_id").alias("doc_id"), F.col("e.piece").alias("piece"), F.col("e.n_tokens").alias("n_tokens"),
        F.crc32(F.expr("substring(payload, place * stride + 1, stride)")).alias("ids_crc32"),
    )
