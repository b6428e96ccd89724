"""The retail tables as views over a TPC-H-like star schema (customer, nation, part, orders, lineitem)."""

from __future__ import annotations

from dataclasses import replace
from decimal import Decimal
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.config import Rules
from storeledger.sources.tables import Tables

# Only the columns a binding uses; the scan reads fewer still.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_discount double, "
        "l_shipdate timestamp_ntz"
    ),
}

# Status P plays the cancelled order; bounds follow the size of these orders and stocks.
STAR_RULES = replace(
    Rules(),
    statuses=("F", "O", "P"),
    excluded_statuses=("P",),
    price_threshold=Decimal("950"),
    city="NATION_7",
    basket_bounds=(Decimal("50000"), Decimal("100000")),
    big_basket=Decimal("100000"),
    sales_months=80,
    # Labels here are plain ASCII, where byte order is alphabetical order.
    text_collation=None,
)


def read_star(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{root}/{table}.parquet")


def star_tables(spark: SparkSession, root: str, prices: bool = True) -> Tables:
    """Bind the star to `Tables`, lazily.

    The price paid is the catalogue price less the line's discount, which takes a join with `part`; `prices=False`
    leaves the column and the join out for jobs that only count or add quantities. A stored line has its price: bind
    once, write, and run every job from there. The star has no signup date either; the account balance stands in for
    it, one day per five units from 1995 on and none for a negative balance.
    """
    table = partial(read_star, spark, root)
    return Tables(
        customers=lambda: _customers(table("customer"), table("nation")),
        products=lambda: _products(table("part")),
        orders=lambda: _orders(table("orders")),
        order_lines=lambda: _priced_lines(table("lineitem"), table("part")) if prices else _lines(table("lineitem")),
        unpriced_lines=lambda: _lines(table("lineitem")),
    )


def _customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").selectExpr(
        "c_custkey AS id",
        "c_name AS last_name",
        "c_mktsegment AS first_name",
        "concat(lower(replace(c_name, '#', '.')), '@example.com') AS email",
        "n_name AS city",
        "CASE WHEN c_acctbal >= 0 THEN date_add(DATE'1995-01-01', CAST(floor(c_acctbal / 5) AS INT)) END AS signup_date",
    )


# The one rule by which the star's binary prices become decimals.
_PRICE = "CAST(p_retailprice AS DECIMAL(10,2))"


def _products(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "p_partkey AS id",
        "p_name AS name",
        "p_type AS category",
        f"{_PRICE} AS price",
        "p_size AS stock",
    )


def _orders(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey AS id",
        "o_custkey AS customer_id",
        "CAST(o_orderdate AS DATE) AS order_date",
        "o_orderstatus AS status",
    )


_LINE = (
    "CAST(l_linenumber AS BIGINT) AS id",
    "l_orderkey AS order_id",
    "l_partkey AS product_id",
    "CAST(l_quantity AS INT) AS quantity",
)


def _lines(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(*_LINE)


def _priced_lines(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """A left join: a line whose part is unknown stays, without a price, for the checks to report.

    Price and discount have two decimals, so the price paid is worked out in whole cents, half a cent rounding up.
    """
    prices = part.selectExpr("p_partkey", f"CAST({_PRICE} * 100 AS BIGINT) AS cents")
    paid_cents = "(cents * (100 - CAST(rint(l_discount * 100) AS INT)) + 50) DIV 100"
    return lineitem.join(prices, F.col("l_partkey") == F.col("p_partkey"), "left").selectExpr(
        *_LINE, f"CAST(CAST({paid_cents} AS DECIMAL(10,0)) * 0.01 AS DECIMAL(10,2)) AS unit_price"
    )


def shipped_lines(spark: SparkSession, root: str) -> DataFrame:
    """Lines next to the date of their order: id, order_id, order_date, ship_date."""
    orders = read_star(spark, root, "orders").selectExpr("o_orderkey", "CAST(o_orderdate AS DATE) AS order_date")
    lines = read_star(spark, root, "lineitem")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "CAST(l_linenumber AS BIGINT) AS id",
        "l_orderkey AS order_id",
        "order_date",
        "CAST(l_shipdate AS DATE) AS ship_date",
    )
