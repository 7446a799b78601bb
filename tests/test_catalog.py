"""Every query with a checking SQL gives the same rows in both engines."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from orderflow.catalog import fixtures, runs
from orderflow.plans import daily

TABLES = "region nation customer supplier part orders lineitem events".split()
# The library's own queries; the training-data operators, if they are there, have tests of their own.
QUERIES, CHECKS = ({n: v for n, v in found.items() if n.startswith("q_")} for found in (entry.queries(), entry.oracle_sql()))


@pytest.fixture(scope="module")
def other(data):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{data}/{table}.parquet'")
    yield connection
    connection.close()


def text(value):
    return repr(value) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_same_rows(spark, other, data, name):
    df = QUERIES[name](spark, data)
    columns = sorted(df.columns)
    got = sorted(tuple(text(r[c]) for c in columns) for r in df.collect())
    result = other.execute(CHECKS[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = sorted(tuple(text(r[p]) for p in places) for r in result.fetchall())
    assert got == want


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


def test_no_nested_column_is_compared(spark, data):
    x = fixtures.Inputs(spark, data)
    for df in (daily.keyed_orders(x.orders)[0], QUERIES["q_items_flat"](spark, data)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        keys = re.findall(r"(?:Sort|WindowGroupLimit) \[(.*?)\]", plan)
        assert keys and not any("Details" in k or "Items" in k for k in keys)


def test_feed_scan_is_pruned_by_the_orders_days(spark, data):
    plan = runs.pruned_match(fixtures.Inputs(spark, data))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruningexpression", plan)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_date", "store", "order_count", "net_amount", "tax_amount"] and df.count() > 0


def test_inputs_take_every_store_and_customer(spark):
    x = fixtures.Inputs(spark, "/root/testdata/sf0.01")
    stores = {r.updated_code for r in x.raw_stores.collect()}
    named = {r.StoreCode for r in x.headers.select("StoreCode").distinct().collect()}
    assert len(stores) == x.raw_stores.count() == x.table("supplier").count()
    assert stores <= named and named - stores
    assert x.customers.count() == x.table("customer").count()
    many = x.sql(fixtures.STORES_SQL, supplier=spark.range(2000).selectExpr("id s_suppkey", "id % 25 s_nationkey"))
    assert many.select("updated_code").distinct().count() == 2000
