"""Every registered query against its SQL: names, types and whole results."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from storeledger.plans.catalog import build_queries
from storeledger.plans.oracle import build_oracle
from star_fixtures import EDGES, EMPTY, write_star

ROOT = Path(os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01"))
QUERIES = build_queries()
ORACLE = build_oracle()
TYPE_NAMES = {"string": "varchar", "int": "integer"}


def _connect(root):
    connection = duckdb.connect()
    for table in root.glob("*.parquet"):
        files = f"{table}/*.parquet" if table.is_dir() else table
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{files}'")
    return root, connection


@pytest.fixture(scope="module")
def given():
    if not ROOT.exists():
        pytest.skip("driver tables not present")
    return _connect(ROOT)


@pytest.fixture(scope="module")
def edges(spark, tmp_path_factory):
    return _connect(write_star(spark, tmp_path_factory.mktemp("edges"), EDGES))


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return _connect(write_star(spark, tmp_path_factory.mktemp("empty"), EMPTY))


@pytest.fixture(scope="module")
def skewed(given, tmp_path_factory):
    """The given tables with a third of the lines on one order and on one part, a third of the orders on one customer."""
    _, source = given
    folder = tmp_path_factory.mktemp("skewed")
    for table in ("nation", "customer", "part"):
        source.execute(f"COPY {table} TO '{folder}/{table}.parquet'")
    source.execute(f"""COPY (
        SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey) FROM orders
    ) TO '{folder}/orders.parquet' (ROW_GROUP_SIZE 4000)""")
    source.execute(f"""COPY (
        SELECT * EXCLUDE n REPLACE (
            CASE WHEN n % 3 = 0 THEN 42 ELSE l_orderkey END AS l_orderkey,
            CASE WHEN n % 3 = 1 THEN 11 ELSE l_partkey END AS l_partkey
        ) FROM (SELECT *, row_number() OVER () AS n FROM lineitem)
    ) TO '{folder}/lineitem.parquet' (ROW_GROUP_SIZE 4000)""")
    return _connect(folder)


@pytest.fixture
def small_cluster_settings(spark):
    """Only tiny sides are broadcast, and a few kilobytes on one key count as skew."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.files.maxPartitionBytes": "200k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def _compare(spark, shop, name):
    root, connection = shop
    result = QUERIES[name](spark, str(root))
    relation = connection.sql(ORACLE[name])
    types = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in result.schema}
    assert types == {c: str(t).lower() for c, t in zip(relation.columns, relation.types)}
    columns = sorted(types)
    ours = [tuple(row[c] for c in columns) for row in result.collect()]
    theirs = [tuple(row[relation.columns.index(c)] for c in columns) for row in relation.fetchall()]
    assert sorted(ours, key=repr) == sorted(theirs, key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_given_tables(spark, given, name):
    _compare(spark, given, name)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_edge_cases(spark, edges, name):
    _compare(spark, edges, name)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    _compare(spark, empty, name)


@pytest.mark.parametrize(
    "name",
    [
        "orders_with_customer",
        "order_totals",
        "revenue_by_category",
        "customer_spend",
        "top_customers",
        "stock_cover",
        "anomalies_per_customer",
        "discount_by_rate",
        "revenue_by_city",
        "products_never_validly_sold_in_quarter",
        "check_foreign_key",
        "delete_cascade",
        "assign_ids",
    ],
)
def test_skewed_tables(spark, skewed, small_cluster_settings, name):
    _compare(spark, skewed, name)


def test_entry(spark):
    assert contract.entry(spark).columns == ["category", "revenue", "units"]
