"""Best-fit packing of tokenized documents into sequences of a fixed length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import common
from .transducer import tokenizer_of

SEQUENCE = 2048
OPEN_BINS = 1024
#: Pieces that wait to be placed longest first. Each longer than half a sequence opens a bin, and no more bins than
#: OPEN_BINS can wait for the short pieces that come last: a larger window closes bins before these arrive.
WINDOW = 2 * OPEN_BINS


class BestFit:
    """Online best-fit with a bounded number of open bins.

    ``free`` is a bitset: bit s is set when some open bin has s free places, so the tightest bin
    for a piece is the lowest set bit at or above its length. When all bins are open, the fullest
    one is closed for the new one.
    """

    def __init__(self, capacity: int = SEQUENCE, bins: int = OPEN_BINS):
        self.capacity, self.bins = capacity, bins
        self.free, self.open, self.count = 0, 0, 0
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) for a piece."""
        if not 0 < length <= self.capacity:
            raise ValueError(f"a piece has 1 to {self.capacity} tokens, not {length}")
        fits = self.free >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            bin_ = self._take(space)
        else:
            if self.open == self.bins:
                self._take((self.free & -self.free).bit_length() - 1)
            bin_, space = self.count, self.capacity
            self.count += 1
        left = space - length
        if left:
            self.by_space[left].append(bin_)
            self.free |= 1 << left
            self.open += 1
        return bin_, self.capacity - space

    def _take(self, space: int) -> int:
        held = self.by_space[space]
        bin_ = held.pop()
        if not held:
            self.free &= ~(1 << space)
        self.open -= 1
        return bin_


SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack(docs: DataFrame, model_path: str, capacity: int = SEQUENCE, bins: int = OPEN_BINS, end_id: int = 0, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Pack every row's token ids, followed by `end_id`, into sequences of at most `capacity` ids.

    Only longer documents are cut, into pieces of `capacity`; the last may be shorter. One row per
    piece: its place in its document (piece, start), its length, the CRC-32 of its ids as
    little-endian unsigned 32-bit numbers, and its place (sequence_id, offset). A null or empty text
    is one piece of the end id; a very long one is cut into full pieces and a last one; repeated rows
    are packed again; of bins with equal room the one opened to that room last is taken, and pieces of
    equal length keep their order; a null doc_id stays null; an empty table gives an empty one; only
    doc_id and text are read, so other columns can't clash.

    Each input partition packs on its own, so nothing is shuffled: sequence_id holds the partition
    number above its 33 low bits. The pieces of a look-ahead window of `window` pieces go to
    best-fit longest first. A partition leaves at most `bins` sequences short of full.
    """
    spark = common.prepare(docs.sparkSession)
    held = spark.sparkContext.broadcast(common.file_bytes(model_path))
    schema = SCHEMA.append(pa.field("ids", pa.list_(pa.int64()))) if with_ids else SCHEMA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(held.value)
        packer = BestFit(capacity, bins)
        top = TaskContext.get().partitionId() << 33
        end = np.array([end_id], "<u4")
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            rows.sort(key=lambda r: -r[3])
            placed = [packer.place(r[3]) for r in rows]
            columns = list(zip(*rows, strict=True))
            out = common.batch_of(schema, *columns[:5], [top + b for b, _ in placed], [o for _, o in placed], *columns[5:])
            rows.clear()
            return out

        for batch in common.slices(batches, "text"):
            ids = batch.column(0).to_pylist()
            encoded = tokenizer.encode([t or "" for t in batch.column(1).to_pylist()])
            for doc_id, own in zip(ids, encoded, strict=True):
                own = np.concatenate([own, end])
                for piece, start in enumerate(range(0, len(own), capacity)):
                    part = own[start : start + capacity]
                    rows.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes()), *([part.tolist()] if with_ids else [])))
            if len(rows) >= window:
                yield flush()
        if rows:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(run, DDL + ", ids array<long>" * with_ids)
