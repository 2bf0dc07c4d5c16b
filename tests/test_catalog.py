"""Every registered query against SQL over the same tables."""

import duckdb
import pytest

from ledgerloom.plans.catalog import QUERIES
from ledgerloom.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in ("customer", "orders", "lineitem", "events"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def normal(rows):
    return sorted(tuple(repr(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, tables, name):
    got = QUERIES[name](spark, SF)
    columns = ", ".join(f'"{c}"' for c in got.columns)
    want = tables.execute(f"select {columns} from ({ORACLE[name]})").fetchall()
    assert got.count() > 0
    assert normal(map(tuple, got.collect())) == normal(want)


def test_approximate_days_are_close(spark):
    exact = {r.day: r.addresses for r in QUERIES["daa_exact"](spark, SF).collect()}
    close = {r.day: r.addresses for r in QUERIES["daa_approx"](spark, SF).collect()}
    assert exact.keys() == close.keys()
    assert all(abs(close[d] - n) <= max(1, 0.1 * n) for d, n in exact.items())


def test_only_inexpressible_queries_lack_sql():
    assert set(QUERIES) - set(ORACLE) == {"daa_approx", "extract_addresses"}
