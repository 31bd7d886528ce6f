"""Extras on Structured Streaming; the batch loader needs none of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from quillstone.contracts import Contract
from quillstone.operators.merge import latest_by_order
from quillstone.sources.loader import merge_batch


def merge_stream(rows: DataFrame, root: str, contract: Contract, checkpoint: str, run_prefix: str = "stream") -> StreamingQuery:
    """Merge each micro-batch of declared text columns and `__row` into the raw layer; ends when all is read.

    The merge is an upsert by key, so a batch that runs again after a failure changes nothing.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        merge_batch(latest_by_order(batch, contract.primary_key, ["__row"]).select(*contract.columns), root, contract, f"{run_prefix}-{epoch}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, key: str, size: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Tumbling (or sliding) window counts that accept events up to `late` behind; batch frames work too."""
    window = F.window(time, size, slide) if slide else F.window(time, size)
    return events.withWatermark(time, late).groupBy(window, key).agg(F.count("*").alias("n_events")).select(F.col("window.start").alias("window_start"), key, "n_events")


def sessions(events: DataFrame, time: str, key: str, gap: str, late: str = "10 minutes") -> DataFrame:
    """Sessions of a key, ended by a gap."""
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap), key).agg(F.count("*").alias("n_events")).select(F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), key, "n_events")
