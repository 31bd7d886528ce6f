"""Shared parts of the training-data operators: sessions, shared tables and Arrow text batches."""

from __future__ import annotations

import atexit
import contextlib
import gc
import os
import tempfile
import time
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows of an Arrow batch between the JVM and a Python worker, and bytes of text handled at once.
BATCH_ROWS = 512
SLICE_BYTES = 4 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Ship this package to the Python workers and keep Arrow batches small.

    Spark takes the size of Arrow batches from the session when a plan runs, so the session's setting
    is changed; a batch of long texts at Spark's own 10,000 rows would not fit a worker.
    """
    context = spark.sparkContext
    if getattr(context, "_quillstone_shipped", None) is None:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        package = os.path.join(root, "quillstone")
        folder = tempfile.mkdtemp(prefix="quillstone-")
        target = os.path.join(folder, "quillstone_pkg.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
            for at, _, names in sorted(os.walk(package)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(at, name)
                        out.write(path, os.path.relpath(path, root))
        context.addPyFile(target)
        context._quillstone_shipped = target
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 * SLICE_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a Parquet table; the selection reaches the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster shares, from spark.checkpoint.dir; a local one only where none is set (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = os.path.join(tempfile.gettempdir(), "checkpoints")
    return folder.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """A folder of this application's own below the shared one; it is removed when the driver's Python ends."""
    context = spark.sparkContext
    path = f"{shared_folder(spark)}/quillstone-{context.applicationId}"
    if getattr(context, "_quillstone_folder", None) != path:
        hadoop = context._jvm.org.apache.hadoop.fs.Path(path)
        files = hadoop.getFileSystem(context._jsc.hadoopConfiguration())

        def remove() -> None:
            with contextlib.suppress(Exception):  # the JVM may be gone; what stays is only disk
                files.delete(hadoop, True)

        atexit.register(remove)
        context._quillstone_folder = path
    return path


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write df to the run's shared folder and read it back: lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner see that earlier steps are no longer referenced, so that their shuffle files go.

    Spark removes a shuffle's files once the JVM has collected its last reference; without this they
    would stay until the end of a job of many steps.
    """
    for _ in range(2):  # the first pass frees what holds the references, the second the plans
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def file_bytes(path: str, bound: int = 16 << 20) -> bytes:
    """A vocabulary file, read on the driver to be broadcast; its size is checked."""
    with open(path, "rb") as source:
        data = source.read(bound + 1)
    if len(data) > bound:
        raise ValueError(f"{path} is larger than {bound} bytes")
    return data


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about `limit` bytes of text; a longer text stands alone."""
    for batch in batches:
        lengths = batch.column(column).cast(pa.large_binary())
        sizes = np.diff(np.frombuffer(lengths.buffers()[1], np.int64, len(lengths) + 1, lengths.offset * 8)) if len(lengths) else []
        begin, held = 0, 0
        for row, size in enumerate(sizes):
            if row > begin and held + size > limit:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += int(size)
        if begin < batch.num_rows:
            yield batch.slice(begin)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


# ---- words: maximal runs of bytes other than space and 0x09-0x0D ----

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.array([(1 << 8 * k) - 1 for k in range(8)], np.uint64)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_S = np.uint64(29)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * _M1
    h = (h ^ (h >> _S)) * _M2
    return h ^ (h >> np.uint64(32))


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], eight bytes at a time for all spans at once."""
    size = (end - start).astype(np.int64)
    h = mix(size.astype(np.uint64) + _M1)
    if not len(start):
        return h
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    view = np.ndarray((len(padded) - 7,), "<u8", buffer=padded, strides=(1,))
    live, at, left = np.arange(len(start)), start.astype(np.int64), size
    keep = left > 0
    live, at, left = live[keep], at[keep], left[keep]
    while len(live):
        chunk = view[at]
        short = left < 8
        chunk[short] &= _MASK[left[short]]
        h[live] = mix(h[live] ^ chunk)
        keep = left > 8
        live, at, left = live[keep], at[keep] + 8, left[keep] - 8
    return h


class Words:
    """The words of a text column.

    ``start`` and ``end`` are byte positions in ``data``; document i has the words
    ``first[i]:first[i + 1]``.
    """

    def __init__(self, column: pa.Array, lower: bool = False):
        data, offsets = text_bytes(column)
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        inside = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        stops[:-1] &= ~inside[1:] | edge[1:-1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.inside = inside

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.start, self.end)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sums over each document's bytes."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k consecutive values (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = mix(h[:n] + _M2)  # scrambled first: a sum alone would not tell the order of two words
    for j in range(1, k):
        out = mix(out + h[j : j + n])
    return out
