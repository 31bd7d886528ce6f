"""Token counts of documents by the compiled tokenizer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common
from .transducer import tokenizer_of

SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def count_tokens(docs: DataFrame, model_path: str, limit: int = 2048) -> DataFrame:
    """UTF-8 bytes, tokens, and whether the tokens exceed `limit`, for each row.

    One row per input row, repeated rows included; a null text counts as empty (0 bytes, 0 tokens)
    and a null doc_id stays null; an empty table gives an empty one. Only doc_id and text are read, so
    other columns can't clash. No shuffle; a worker holds a few MB of text (or one longer text, whose
    chunks' state maps are composed) and a bounded table of pieces.
    """
    spark = common.prepare(docs.sparkSession)
    held = spark.sparkContext.broadcast(common.file_bytes(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(held.value)
        for batch in common.slices(batches, "text"):
            _, offsets = common.text_bytes(batch.column(1))
            tokens = tokenizer.counts([t or "" for t in batch.column(1).to_pylist()])
            yield common.batch_of(SCHEMA, batch.column(0), np.diff(offsets), tokens, tokens > limit)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
