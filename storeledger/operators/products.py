"""Products without sales, and stock cover of those that sell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.config import Rules
from storeledger.functions.measures import percent, ratio, total
from storeledger.functions.ordering import asc, desc, present, text
from storeledger.operators.grains import order_amounts, valid_lines
from storeledger.sources.tables import Tables


def _without(products: DataFrame, sold: DataFrame) -> DataFrame:
    """Products absent from `sold`. Keys are made distinct first: the build side of an anti join is never split, and
    distinct collapses a best-seller before the shuffle."""
    keys = sold.select(F.col("product_id").alias("id")).distinct()
    return products.join(keys, "id", "left_anti")


def _never_ordered(tables: Tables) -> DataFrame:
    return _without(tables.products, tables.order_lines)


def products_never_ordered(tables: Tables, rules: Rules) -> DataFrame:
    """In no order at all; a cancelled order counts as a sale."""
    return _never_ordered(tables).select("name", "category", "price", "stock")


def products_never_validly_sold(tables: Tables, rules: Rules) -> DataFrame:
    """In no valid order; products seen only in cancelled orders are listed too."""
    unsold = _without(tables.products, valid_lines(tables, rules))
    unsold = present(unsold, rules, text("category", rules), text("name", rules), asc("id"))
    return unsold.select("name", "category", "price", "stock")


def unsold_stock_value(tables: Tables, rules: Rules) -> DataFrame:
    """Count and catalogue value of the stock of never-ordered products."""
    return _never_ordered(tables).agg(
        F.count("*").alias("products"), total(F.col("price") * F.col("stock")).alias("stock_value")
    )


def _cover(tables: Tables, rules: Rules) -> DataFrame:
    """Per sold product: units, units sold in big baskets, and risk class.

    Classes compare stock * months with bound * units, the division-free form, which is exact on the bounds.

    Order amounts computed in the same plan are already partitioned by order, and Spark would join lines to them in
    place, where a hot order cannot be split. Joining on the complement of the id then gives both sides a fresh shuffle;
    the extra one moves an id and a flag per order. A stored snapshot has no such partitioning, or has it on purpose.
    """
    order_id = F.col("order_id") if tables.order_amounts is not None else F.bitwise_not("order_id")
    order_key = order_id.alias("order_key")
    baskets = order_amounts(tables, rules).select(order_key, (F.col("total") >= rules.big_basket).alias("is_big"))
    lines = tables.unpriced_lines.select(order_key, "product_id", "quantity")
    sales = (
        lines.join(baskets, "order_key")
        .groupBy("product_id")
        .agg(
            F.sum("quantity").alias("units"),
            F.sum(F.when(F.col("is_big"), F.col("quantity")).otherwise(0)).alias("big_basket_units"),
        )
    )
    products = tables.products.select(F.col("id").alias("product_id"), "name", "category", "stock")
    high, watch = rules.cover_bounds
    at_risk, to_watch, enough = rules.risk_labels
    months_of_stock = F.col("stock").cast("decimal(38,0)") * rules.sales_months
    units = F.nullif(F.col("units"), F.lit(0))
    risk = (
        F.when(months_of_stock < units * high, at_risk).when(months_of_stock < units * watch, to_watch).otherwise(enough)
    )
    return sales.join(products, "product_id").withColumn("risk_class", risk)


def stock_cover(tables: Tables, rules: Rules) -> DataFrame:
    """The products with the least months of stock at the current sales rate."""
    months = F.lit(rules.sales_months)
    stock = F.col("stock").cast("decimal(38,0)")
    covered = _cover(tables, rules).select(
        F.col("product_id").alias("id"),
        "name",
        "category",
        "stock",
        "units",
        ratio(F.col("units"), months, 1).alias("units_per_month"),
        ratio(stock * rules.sales_months, F.col("units"), 1).alias("months_of_cover"),
        percent(F.col("big_basket_units"), F.col("units"), 1).alias("big_basket_pct"),
        "risk_class",
    )
    return covered.orderBy(asc("months_of_cover"), asc("id")).limit(rules.tightest_stocks)


def risk_class_counts(tables: Tables, rules: Rules) -> DataFrame:
    counts = _cover(tables, rules).groupBy("risk_class").agg(F.count("*").alias("products"))
    return present(counts, rules, desc("products"), text("risk_class", rules))
