"""Every registered query against its DuckDB oracle on the driver's sf0.001 tables
(the correctness gate of the test driver, on its smallest scale factor)."""

from __future__ import annotations

import duckdb
import pytest

from souk.catalog import all_oracles, all_queries
from tests.helpers import rows

SF = "/root/testdata/sf0.001"
DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(all_oracles()))
def test_query_matches_oracle_on_driver_tables(key, spark, duck):
    got = all_queries()[key](spark, SF).toPandas()
    want = duck.execute(all_oracles()[key]).fetchdf()
    assert rows(got) == rows(want), key
