"""Every ledger query against its DuckDB equivalent."""

import datetime
import decimal
import struct

import duckdb
import pyarrow.parquet as pq
import pytest
import xxhash

from quillstone.plans import lake_queries  # noqa: F401  (registers its queries)
from quillstone.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def plain(v):
    if v is None or v != v:
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int | float | decimal.Decimal):
        return f"{float(v) + 0.0:.6f}"
    if isinstance(v, datetime.datetime | datetime.date):
        return v.isoformat().removesuffix("T00:00:00").replace("+00:00", "")
    return str(v)


def sorted_rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([plain(r[i]) for i in order] for r in data)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted_rows(got.columns, [tuple(r) for r in got.collect()]) == sorted_rows(want.columns, want.fetchall())


def test_flags_have_the_declared_columns(spark):
    flags = QUERIES["quantile_interval_flags"](spark, SF)
    assert {"score", "side", "model_family", "run_id"} <= set(flags.columns)


def test_rolling_checksum_of_a_large_table(spark):
    """Every row's hash, column by column with the hash so far as seed, by the library."""
    table = pq.read_table(f"{SF}/lineitem.parquet")
    columns = []
    for name, kind in zip(table.column_names, table.schema.types, strict=True):
        values = table[name].cast("int64").to_pylist() if str(kind).startswith("timestamp") else table[name].to_pylist()
        form = {"int32": "<i", "double": "<d"}.get(str(kind), "<q")
        columns.append([v.encode() if isinstance(v, str) else struct.pack(form, v) for v in values])
    total = 0
    for row in zip(*columns, strict=True):
        h = 42
        for data in row:
            h = xxhash.xxh64_intdigest(data, h)
        total += h - (h >> 63 << 64)
    got = QUERIES["row_checksum_rolling"](spark, SF).first()
    assert (got.checksum, got.n_rows) == (str(total), table.num_rows)
