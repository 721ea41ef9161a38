"""Best-fit packing of token sequences with a bounded number of open bins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.tokens import default_tokenizer, process_encoder

OUT = (
    "doc_id bigint, piece int, start bigint, length bigint, sequence_id bigint, offset bigint, ids binary"
)


class OpenBins:
    """At most ``limit`` open bins. Bit f of one integer is set while a bin with f free places is open.

    ``place`` puts a piece into the open bin that it fills best, or into a new one. If that is one bin
    too many, the fullest is closed; it could take the least of what is still to come.
    """

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.bits, self.open, self.made = 0, 0, 0
        self.bins: dict[int, list[int]] = {}

    def _take(self, free: int) -> int:
        stack = self.bins[free]
        number = stack.pop()
        if not stack:
            self.bits ^= 1 << free
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset of a piece of 1 to ``capacity`` tokens."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            self.bins.setdefault(left, []).append(number)
            self.bits |= 1 << left
            self.open += 1
            if self.open > self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
        return number, self.capacity - free


def pack_documents(
    docs: DataFrame, tokenizer_path: str | None = None, capacity: int = 4096, open_bins: int = 512,
    end_id: int = 1,
) -> DataFrame:
    """Pack the token ids of every document into sequences of at most ``capacity`` tokens.

    Uses the columns ``doc_id`` and ``text`` only; other columns, whatever their names, are left out.
    A document is its ids and then ``end_id``; one that is longer than ``capacity`` is cut into full
    pieces and a rest. Each task packs the pieces it reads, in the order it reads them, so nothing is
    shuffled; a task leaves a few bins open at its end, at most ``open_bins``. A task that is run again
    reads the same rows and gives the same bins.

    Null and empty texts give one piece of one token. A null ``doc_id`` stays null. Repeated rows are
    packed each. An empty table gives no rows. ``ids`` is little-endian unsigned 32-bit.
    """
    path = tokenizer_path or default_tokenizer()

    def pack(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        names = ("doc_id", "piece", "start", "length", "sequence_id", "offset", "ids")
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        encoder, bins = process_encoder(path), OpenBins(capacity, open_bins)
        base = TaskContext.get().partitionId() << 33
        end = np.array([end_id], np.uint32)

        def table(rows):
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays(columns, list(names))

        rows, held = [], 0
        for batch in batches:
            doc_ids, column = batch.column("doc_id").to_pylist(), batch.column("text")
            encoded = (x for at in range(0, len(doc_ids), 128) for x in encoder.encode_all(column.slice(at, 128).to_pylist()))
            for doc_id, ids in zip(doc_ids, encoded):
                ids = np.concatenate([ids, end]).astype("<u4", copy=False)
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    number, offset = bins.place(len(part))
                    rows.append((doc_id, piece, start, len(part), base + number, offset, part.tobytes()))
                    held += 4 * len(part)
                    if held > 4 << 20 or len(rows) >= 10_000:
                        yield table(rows)
                        rows, held = [], 0
        if rows:
            yield table(rows)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(pack, OUT)


def packing_digest(packed: DataFrame) -> DataFrame:
    """The packed pieces with a checksum of their ids in place of the ids."""
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )
