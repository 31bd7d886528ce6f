"""The raw layer: text columns in Parquet, by accounting period, with run provenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.contracts import Contract
from quillstone.functions.core import fingerprint

from . import parts
from .csv_source import METADATA

PERIOD = "accounting_period"
WHOLE = "whole"

#: Column types that may leave the engine; anything else is refused.
EXPORTABLE = {"string": "text", "date": "date", "bigint": "bigint", "int": "bigint", "boolean": "boolean"}


class UnmappedType(TypeError):
    pass


def exported_type(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return f"numeric({kind.precision},{kind.scale})"
    name = kind.simpleString()
    if name not in EXPORTABLE:
        raise UnmappedType(f"{name} has no counterpart")
    return EXPORTABLE[name]


class EmptyTable(LookupError):
    """A partitioned table that should hold rows holds none."""


def schema(contract: Contract) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in (*contract.columns, *METADATA)])


def _base(root: str, contract: Contract) -> str:
    return f"{root}/{contract.table}"


def periods(spark: SparkSession, root: str, contract: Contract) -> list[str]:
    return sorted(parts.held(spark, _base(root, contract))) if contract.partition_by else []


def read(spark: SparkSession, root: str, contract: Contract, only: Sequence[str] | None = None, required: bool = False) -> DataFrame:
    """Declared columns and provenance ('' in files without it), and the period where there is one.

    `only` names the partitions to read. With `required`, a table without any partition is refused
    instead of read as empty.
    """
    held = parts.held(spark, _base(root, contract))
    if required and not held:
        raise EmptyTable(f"{contract.table} holds nothing under {root}")
    paths = [f"{_base(root, contract)}/{f}" for p, f in sorted(held.items()) if only is None or not contract.partition_by or p in only]
    columns = [*contract.columns, *METADATA]
    if not paths:
        empty = spark.createDataFrame([], schema(contract))
        return empty.withColumn(PERIOD, F.lit(None).cast("string")) if contract.partition_by else empty
    rows = spark.read.schema(schema(contract)).parquet(*paths)
    rows = rows.withColumns({c: F.coalesce(c, F.lit("")) for c in METADATA}).select(*columns)
    return rows.withColumn(PERIOD, F.substring(contract.partition_by, 1, 7)) if contract.partition_by else rows


def read_keys(spark: SparkSession, root: str, contract: Contract, only: Sequence[str] | None = None) -> DataFrame:
    """The key, and the period where there is one: the scan reads no other column but the one that dates the row."""
    rows = read(spark, root, contract, only)
    return rows.select(*contract.primary_key, *([PERIOD] if contract.partition_by else []))


def count_rows(spark: SparkSession, root: str, contract: Contract) -> dict[str, int]:
    """Rows of each partition (or WHOLE), in one job that reads no column: the Parquet footers say how many rows a file has."""
    base = _base(root, contract)
    held = parts.held(spark, base)
    if not held:
        return {}
    rows = spark.read.schema(schema(contract)).parquet(*[f"{base}/{f}" for f in held.values()])
    part = F.regexp_extract(F.col("_metadata.file_path"), f"/{PERIOD}=([^/]+)/", 1) if contract.partition_by else F.lit(WHOLE)
    return dict(rows.groupBy(part.alias("part")).count().collect())


def write(rows: DataFrame, root: str, contract: Contract, targets: Sequence[str] | None = None) -> None:
    """Replace the partitions of rows, all in one change; `targets` without rows are dropped.

    Rows are sorted by key within a partition; adaptive execution splits a large one into several files.
    """
    columns = [*contract.columns, *METADATA]
    if contract.partition_by:
        out = rows.select(*columns, F.substring(contract.partition_by, 1, 7).alias(PERIOD))
        parts.replace(out.hint("rebalance", PERIOD).sortWithinPartitions(PERIOD, *contract.primary_key), _base(root, contract), (PERIOD,), targets or ())
    else:
        parts.replace(rows.select(*columns).hint("rebalance").sortWithinPartitions(*contract.primary_key), _base(root, contract), (), whole=WHOLE)


def export(rows: DataFrame, path: str) -> dict[str, str]:
    """Copy a table out as Parquet, replacing nothing; the exported type of each column. A type without a counterpart is refused before anything is written."""
    kinds = {f.name: exported_type(f.dataType) for f in rows.schema}
    rows.write.parquet(path)
    return kinds


def checksum(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(checksum, n_rows): one digest of a table's rows in any order, provenance left out.

    It folds all row digests, so it is for tables of bounded size; `rolling_checksum` is for others.
    """
    return rows.select(fingerprint([F.col(c) for c in columns]).alias("h")).agg(F.sha2(F.concat_ws("", F.sort_array(F.collect_list("h"))), 256).alias("checksum"), F.count("*").alias("n_rows"))


def rolling_checksum(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(checksum, n_rows) as a sum of row hashes: order-free, and folded by every task."""
    h = F.xxhash64(*[F.col(c) for c in columns]).cast("decimal(38,0)")
    return rows.agg(F.coalesce(F.sum(h), F.lit(0)).cast("string").alias("checksum"), F.count("*").alias("n_rows"))
