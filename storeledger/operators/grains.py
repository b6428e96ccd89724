"""Intermediate grains the jobs share.

The rule throughout: aggregate the big side down to the join key first, then join key to key. Partial aggregation runs
before the shuffle, so a product, customer or order that owns a third of all rows reaches the join as one row.

Where rows must join undiminished, they are the preserved or probe side and both inputs are fresh shuffles: that is the
shape in which adaptive execution splits a hot key over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.config import Rules
from storeledger.functions.measures import MONEY, is_valid_order, line_amount
from storeledger.sources.tables import Tables, lines_of


def line_totals(tables: Tables) -> DataFrame:
    """order_id, total over all lines of the order, whatever its status or date: the join with orders selects."""
    return tables.stored_lines.groupBy("order_id").agg(F.sum(line_amount()).alias("total"))


def order_amounts(tables: Tables, rules: Rules) -> DataFrame:
    """One row per valid order that has lines: order_id, customer_id, order_date, status, total."""
    if tables.order_amounts is not None:
        return tables.order_amounts.select("order_id", "customer_id", "order_date", "status", "total")
    orders = tables.orders.filter(is_valid_order(rules)).withColumnRenamed("id", "order_id")
    return orders.join(line_totals(tables), "order_id").select(
        "order_id", "customer_id", "order_date", "status", F.col("total").cast(MONEY).alias("total")
    )


def valid_lines(tables: Tables, rules: Rules) -> DataFrame:
    return lines_of(tables.stored_lines, tables.orders.filter(is_valid_order(rules)))


def customer_sales(amounts: DataFrame) -> DataFrame:
    """Per customer: orders, priced_orders (those with a total), revenue."""
    return amounts.groupBy("customer_id").agg(
        F.count("*").alias("orders"), F.count("total").alias("priced_orders"), F.sum("total").alias("revenue")
    )


def sales_by_paid_price(tables: Tables, rules: Rules) -> DataFrame:
    """Valid sales per product and price paid, next to the catalogue: category, price, unit_price, lines, units.

    Every discount figure is a sum over this grain, so line rows meet the catalogue only after being counted.
    """
    paid = (
        valid_lines(tables, rules)
        .groupBy("product_id", "unit_price")
        .agg(F.count("*").alias("lines"), F.sum("quantity").alias("units"))
    )
    catalogue = tables.products.select(F.col("id").alias("product_id"), "category", "price")
    return paid.join(catalogue, "product_id").drop("product_id")
