"""Baskets classed by order total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.config import Rules
from storeledger.functions.measures import total
from storeledger.functions.ordering import asc, desc, present, text
from storeledger.operators.grains import order_amounts
from storeledger.operators.sales import with_share
from storeledger.sources.tables import Tables


def basket_class(rules: Rules) -> Column:
    """Half-open classes: each bound belongs to the class above it."""
    value = F.col("total")
    low, high = rules.basket_bounds
    small, medium, large = rules.basket_labels
    return (
        F.when(value.isNull(), rules.basket_unknown_label)
        .when(value < low, small)
        .when(value < high, medium)
        .otherwise(large)
    )


def classify_baskets(tables: Tables, rules: Rules) -> DataFrame:
    classed = order_amounts(tables, rules).select(
        "order_id", "order_date", "status", "total", basket_class(rules).alias("basket_class")
    )
    return present(classed, rules, desc("total"), asc("order_id"))


def basket_class_summary(tables: Tables, rules: Rules) -> DataFrame:
    summary = (
        order_amounts(tables, rules)
        .groupBy(basket_class(rules).alias("basket_class"))
        .agg(F.count("*").alias("orders"), total("total").alias("revenue"))
    )
    return present(summary, rules, desc("revenue"), text("basket_class", rules))


def basket_class_shares(tables: Tables, rules: Rules) -> DataFrame:
    """Each class's share of orders and of revenue, one decimal."""
    summary = basket_class_summary(tables, rules.unordered())
    shares = with_share(summary, orders="orders_pct", revenue="revenue_pct")
    return present(shares, rules, desc("revenue"), text("basket_class", rules))
