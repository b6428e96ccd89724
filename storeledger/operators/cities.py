"""Sales per customer city."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.config import Rules
from storeledger.functions.measures import ratio, total
from storeledger.functions.ordering import desc, present, text
from storeledger.operators.grains import customer_sales, order_amounts
from storeledger.operators.sales import with_share
from storeledger.sources.tables import Tables


def revenue_by_city(tables: Tables, rules: Rules) -> DataFrame:
    """Customers are counted from their subtotals, so no distinct count is needed. The share is of all valid sales, those
    of unknown customers included.

    Unknown customers stay in the report as a group of their own until the shares are taken, so one pass serves both.
    """
    sales = customer_sales(order_amounts(tables, rules))
    cities = tables.customers.select(F.col("id").alias("customer_id"), "city", F.lit(True).alias("known"))
    per_city = (
        sales.join(cities, "customer_id", "left")
        .groupBy("city", "known")
        .agg(
            F.count("*").alias("customers"),
            F.sum("orders").alias("orders"),
            F.sum("priced_orders").alias("priced_orders"),
            total("revenue").alias("revenue"),
        )
    )
    shares = with_share(per_city, revenue="revenue_pct")
    revenue = F.col("revenue")
    report = shares.filter("known").select(
        "city",
        "customers",
        "orders",
        "revenue",
        ratio(revenue, F.col("priced_orders"), 2).alias("average_basket"),
        ratio(revenue, F.col("customers"), 2).alias("revenue_per_customer"),
        "revenue_pct",
    )
    return present(report, rules, desc("revenue"), text("city", rules))
