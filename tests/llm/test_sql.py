"""The queries against their DuckDB equivalents, over whole documents."""

import duckdb
import pytest

from quillstone.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_rows_equal_sql(spark, name):
    got = QUERIES[name](spark, SF)
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = connection.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda columns, data: sorted(str([r[columns.index(c)] for c in sorted(columns)]) for r in data)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())
