"""Every catalogued query against its SQL twin in DuckDB, on the smallest tables."""

import datetime as dt
import os
import re
from decimal import Decimal

import pytest

import __spark_entry__ as entry
from quotemill.plans import catalogue

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def cell(value):
    assert value is None or isinstance(value, (int, float, str, Decimal, dt.date))
    return repr(value + 0.0 if isinstance(value, float) else value)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, db, name):
    df = catalogue.QUERIES[name](spark, SF_DIR)
    result = db.execute(catalogue.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    theirs = sorted([cell(v) for v in row] for row in result.fetchall())
    ours = sorted([cell(row[c]) for c in names] for row in df.collect())
    assert ours == theirs
    assert ours


def test_every_query_has_a_twin():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)
    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_no_python_functions_and_no_products_in_any_plan(spark):
    for name, run in catalogue.QUERIES.items():
        plan = run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        found = re.search(r"Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", plan)
        assert not found, (name, found)


def test_flagship(spark):
    assert entry.entry(spark).columns == [
        "periodo",
        "producto",
        "precio_surtidor_mediana",
        "volumen_total",
    ]


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["source_filter", "oil_window"])
def test_date_ranges_reach_the_scan(spark, name):
    plan = executed(catalogue.QUERIES[name](spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert "Exchange" not in plan


def test_scans_read_only_what_a_query_needs(spark):
    plan = executed(catalogue.QUERIES["monthly_mean_filled"](spark, SF_DIR))
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


@pytest.mark.parametrize(
    "name", ["monthly_mean_filled", "fuel_month_product", "fuel_pipeline", "fuel_staging", "cleaning_audit"]
)
def test_fact_table_is_read_once(spark, name):
    plan = executed(catalogue.QUERIES[name](spark, SF_DIR))
    facts = [line for line in plan.splitlines() if re.search(r"FileScan parquet \[[lo]_", line)]
    assert len(facts) == 1


def test_line_items_are_not_shuffled_for_their_dimensions(spark):
    plan = executed(catalogue.QUERIES["whitelist_projection"](spark, SF_DIR))
    assert "Exchange hashpartitioning" not in plan
