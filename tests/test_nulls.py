"""Every grouping, joining and window query against its twin on tables with nulls in groups, orders and values."""

import duckdb
import pytest

from lotwise.plans import CATALOGUE
from lotwise.sources.tables import SCHEMAS
from tests.conftest import SMALL
from tests.oracle import compare, connect

#: Column and which of its rows lose it (key, modulus).
HOLES = {
    "part": {"p_brand": ("p_partkey", 7), "p_type": ("p_partkey", 5)},
    "supplier": {"s_nationkey": ("s_suppkey", 3)},
    "customer": {"c_nationkey": ("c_custkey", 6), "c_mktsegment": ("c_custkey", 11)},
    "orders": {"o_totalprice": ("o_orderkey", 13), "o_orderdate": ("o_orderkey", 17), "o_custkey": ("o_orderkey", 19)},
    "lineitem": {"l_extendedprice": ("l_orderkey + l_linenumber", 11), "l_quantity": ("l_orderkey + l_linenumber", 9)},
    "events": {"user_id": ("event_id", 8), "value": ("event_id", 10)},
}
AREAS = ("WIN-", "AGG-", "SUB-", "JOIN-", "MIG-", "SET-", "SRT-", "UPD-", "DW-")


@pytest.fixture(scope="module")
def holes(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("nulls"))
    connection = duckdb.connect()
    for name in SCHEMAS:
        shown = [f"CASE WHEN ({key}) % {n} <> 0 THEN {column} END AS {column}" for column, (key, n) in HOLES.get(name, {}).items()]
        replaced = f"* REPLACE ({', '.join(shown)})" if shown else "*"
        connection.execute(f"COPY (SELECT {replaced} FROM '{SMALL}/{name}.parquet') TO '{folder}/{name}.parquet'")
    return folder, connect(folder)


@pytest.mark.parametrize("key", [key for key in CATALOGUE if key.startswith(AREAS)])
def test_matches_sql_with_nulls(spark, holes, key):
    folder, connection = holes
    verdict, detail, _ = compare(spark, connection, CATALOGUE[key], folder)
    assert verdict in ("ok", "empty"), detail
