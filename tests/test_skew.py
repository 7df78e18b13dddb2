"""The tables with a third of the rows on one order, part, supplier, customer and user, and chunks cut very small: every
result must still equal its SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
import check
from tradevault.functions import ordered
from tradevault.operators import joins

HOT_LINES = """
SELECT * EXCLUDE (rn) REPLACE (CASE WHEN rn % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey, CASE WHEN rn % 3 = 1 THEN 3 ELSE l_partkey END AS l_partkey,
  CASE WHEN rn % 3 = 2 THEN 4 ELSE l_suppkey END AS l_suppkey)
FROM (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_shipdate) AS rn FROM src)"""
HOT = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey) FROM src",
    "lineitem": HOT_LINES,
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 2 ELSE user_id END AS user_id) FROM src",
}


@pytest.fixture(scope="module")
def hot_dir(sf, tmp_path_factory):
    out = tmp_path_factory.mktemp("hot")
    con = duckdb.connect()
    for t in check.TABLES.split():
        con.sql(f"CREATE OR REPLACE VIEW src AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
        con.sql(f"COPY ({HOT.get(t, 'SELECT * FROM src')}) TO '{out}/{t}.parquet' (FORMAT parquet)")
    return str(out)


@pytest.fixture(autouse=True)
def small_chunks(monkeypatch):
    monkeypatch.setattr(ordered, "TARGET_ROWS", 60)
    monkeypatch.setattr(joins, "TARGET_ROWS", 60)
    monkeypatch.setattr(joins.expand_left, "__defaults__", (60, None, None))


@pytest.mark.parametrize("name", [
    "V1_order_reconstruction", "B1_trade_lifecycle", "B9_best_execution", "DV3_satellite_load", "DV7_point_in_time_table",
    "J2_pit_lookup", "J12_derived_order_link", "W5_fill_progress", "W8_allocate", "X2_file_names", "X7_audit_trail", "Q9_state_machine",
])
def test_hot_keys(spark, hot_dir, name):
    problem, n = check.compare(entry.queries()[name](spark, hot_dir), check.connect(hot_dir), entry.oracle_sql()[name])
    assert problem is None and n > 0
