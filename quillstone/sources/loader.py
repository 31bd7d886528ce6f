"""The incremental load: a watermark window of each extract, merged into the raw layer."""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.contracts import Contract, all_contracts
from quillstone.operators import merge

from . import files, raw
from .csv_source import METADATA, select_rows

OVERLAP_DAYS = 7


class StateError(ValueError):
    pass


class Restated(ValueError):
    """An immutable row came back with other values."""


def _state(root: str, name: str) -> str:
    return f"{root}/_state/{name}.json"


class Watermarks:
    """The newest arrival landed, per table; it only moves forward and is saved last."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, _state(root, "watermarks")
        text = files.read_text(spark, self.path)
        try:
            self.held: dict[str, str] = json.loads(text) if text else {}
            for day in self.held.values():
                datetime.date.fromisoformat(day)
        except (ValueError, AttributeError, TypeError) as error:
            raise StateError(f"{self.path} is not a map of tables to dates") from error

    def bound(self, table: str, overlap_days: int) -> str | None:
        if overlap_days < 0:
            raise StateError("the overlap can't be negative")
        day = self.held.get(table)
        return (datetime.date.fromisoformat(day) - datetime.timedelta(days=overlap_days)).isoformat() if day else None

    def advance(self, table: str, day: str | None) -> None:
        if day and day > self.held.get(table, ""):
            self.held[table] = day
            files.write_text(self.spark, self.path, json.dumps(self.held, sort_keys=True))


VERSIONS = "table string, key array<string>, effective_date string"


@dataclass
class Affected:
    """What is owed a new judgement: periods with changed content, and new dimension versions.

    Periods are few and kept as text; versions are as many as a load brings and stay in Parquet, a
    folder per load.
    """

    periods: set[str] = field(default_factory=set)
    folders: list[str] = field(default_factory=list)

    @staticmethod
    def _versions(root: str) -> str:
        return f"{root}/_state/affected_versions"

    @staticmethod
    def load(spark: SparkSession, root: str) -> Affected:
        text = files.read_text(spark, _state(root, "affected_periods"))
        # Spark marks a folder as whole when all of it is written.
        own = [f"{Affected._versions(root)}/{n}" for n in files.names(spark, Affected._versions(root))]
        return Affected(set(json.loads(text)) if text else set(), [f for f in own if files.exists(spark, f"{f}/_SUCCESS")])

    def versions(self, spark: SparkSession) -> DataFrame:
        """(table, key, effective_date) of the versions owed."""
        return spark.read.schema(VERSIONS).parquet(*self.folders).distinct() if self.folders else spark.createDataFrame([], VERSIONS)

    @staticmethod
    def record(spark: SparkSession, root: str, periods: Sequence[str] = (), versions: DataFrame | None = None) -> None:
        path = _state(root, "affected_periods")
        while periods:
            number = files.version(spark, path)
            try:
                files.write_text(spark, path, json.dumps(sorted({*Affected.load(spark, root).periods, *periods})), number)
                break
            except files.Conflict:
                continue  # another load has recorded its own: add to those
        if versions is not None:
            versions.write.parquet(f"{Affected._versions(root)}/{uuid.uuid4().hex}")

    def clear(self, spark: SparkSession, root: str) -> None:
        """Forget what this object holds; what was recorded after it was read stays owed."""
        path = _state(root, "affected_periods")
        while True:
            number = files.version(spark, path)
            left = sorted(Affected.load(spark, root).periods - self.periods)
            try:
                files.write_text(spark, path, json.dumps(left), number)
                break
            except files.Conflict:
                continue
        for f in self.folders:
            files.delete(spark, f)


@dataclass
class LoadReport:
    table: str
    rows_read: int = 0
    inserted: int = 0
    updated: int = 0
    evicted: int = 0
    periods: list[str] = field(default_factory=list)
    digest: str = ""


def merge_batch(batch: DataFrame, root: str, contract: Contract, run_id: str) -> LoadReport:
    """Merge rows (declared columns, one per key) into the raw layer.

    Of the whole layer only the keys are read, to see which rows move between partitions; other
    columns are read, compared and rewritten in the partitions that the batch touches or moves keys
    out of. What is dirty is recorded before anything is written, so a crash in between can't lose it.
    """
    spark = batch.sparkSession
    keys, columns = list(contract.primary_key), contract.columns
    others = [c for c in columns if c not in keys]
    batch = batch.cache()
    found = None
    try:
        report = LoadReport(contract.table, batch.count())
        if not report.rows_read:
            return report
        targets, moved = None, []
        if contract.partition_by:
            incoming = batch.withColumn(raw.PERIOD, F.substring(contract.partition_by, 1, 7))
            gone = dict(merge.moved_keys(raw.read_keys(spark, root, contract), incoming, keys, raw.PERIOD).groupBy(f"old_{raw.PERIOD}").count().collect())
            moved, report.evicted = list(gone), sum(gone.values())
            targets = sorted({r[0] for r in incoming.select(raw.PERIOD).distinct().collect()} | set(moved))
        standing = raw.read(spark, root, contract, targets)
        found = merge.compared(batch, standing, keys, others, ["_first_run_id"]).cache()
        changed = found.where("outcome <> 'same'")
        counts = dict(changed.groupBy("outcome").count().collect())
        report.inserted, report.updated = counts.get("inserted", 0), counts.get("updated", 0)
        if contract.rows_are_immutable and report.updated:
            broken = changed.where("outcome = 'updated'").first()
            raise Restated(f"{contract.table} {[broken[k] for k in keys]}: {', '.join(broken['columns_changed'])} changed")
        if contract.partition_by:
            dirty = {r[0] for r in changed.select(F.substring(contract.partition_by, 1, 7)).distinct().collect()}
            report.periods = sorted(dirty | set(moved))
            Affected.record(spark, root, report.periods)
        elif contract.rows_are_immutable and report.inserted:
            date = next((k for k in keys if contract.column(k).type == "date"), None)
            if date:
                fresh = changed.select(F.lit(contract.table).alias("table"), F.array(*[k for k in keys if k != date]).alias("key"), F.col(date).alias("effective_date"))
                Affected.record(spark, root, versions=fresh)
        new = merge.stamped(found, columns, run_id)
        raw.write(merge.merge_rows(standing.select(*columns, *METADATA), new.select(*columns, *METADATA), keys), root, contract, targets)
        return report
    finally:
        batch.unpersist()
        if found is not None:
            found.unpersist()


def load_table(spark: SparkSession, source: str, root: str, contract: Contract, run_id: str, overlap_days: int = OVERLAP_DAYS, full: bool = False) -> LoadReport:
    path = f"{source}/{contract.table}.csv"
    marks = Watermarks(spark, root)
    bound = None if full else marks.bound(contract.table, overlap_days)
    rows = select_rows(spark, path, contract, bound)
    batch = merge.latest_by_order(rows, contract.primary_key, ["__row"]).drop("__row")
    report = merge_batch(batch, root, contract, run_id)
    report.digest = files.digest(spark, path)
    if contract.watermark:
        marks.advance(contract.table, rows.agg(F.max(contract.watermark)).first()[0])
    return report


def load_source(spark: SparkSession, source: str, root: str, run_id: str, tables: Sequence[str] | None = None, overlap_days: int = OVERLAP_DAYS, full: bool = False) -> list[LoadReport]:
    contracts = all_contracts()
    return [load_table(spark, source, root, contracts[t], run_id, overlap_days, full) for t in (tables or contracts)]
