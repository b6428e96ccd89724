"""Revenue, units, customers' spending and headline figures."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storeledger.config import Rules
from storeledger.functions.measures import MONEY, is_excluded, is_valid_order, line_amount, month_start, percent, ratio, total
from storeledger.functions.ordering import asc, desc, present, text
from storeledger.operators.grains import customer_sales, line_totals, order_amounts, valid_lines
from storeledger.sources.tables import Tables


def _product_columns(tables: Tables, *columns: str) -> DataFrame:
    return tables.products.select(F.col("id").alias("product_id"), *columns)


def revenue_by_category(tables: Tables, rules: Rules) -> DataFrame:
    per_product = (
        valid_lines(tables, rules)
        .groupBy("product_id")
        .agg(F.sum(line_amount()).alias("revenue"), F.sum("quantity").alias("units"))
    )
    per_category = (
        per_product.join(_product_columns(tables, "category"), "product_id")
        .groupBy("category")
        .agg(total("revenue").alias("revenue"), F.sum("units").alias("units"))
    )
    return present(per_category, rules, desc("revenue"), text("category", rules))


def category_shares(tables: Tables, rules: Rules) -> DataFrame:
    """Share of each category in revenue, one decimal."""
    per_category = revenue_by_category(tables, rules.unordered()).select("category", "revenue")
    shares = with_share(per_category, revenue="revenue_pct")
    return present(shares, rules, desc("revenue"), text("category", rules))


def top_products_by_quantity(tables: Tables, rules: Rules) -> DataFrame:
    units = valid_lines(tables, rules).groupBy("product_id").agg(F.sum("quantity").alias("units"))
    named = units.join(_product_columns(tables, "name", "category"), "product_id")
    top = named.orderBy(desc("units"), asc("product_id")).limit(rules.top_products)
    return top.select(F.col("product_id").alias("id"), "name", "category", "units")


def products_by_revenue(tables: Tables, rules: Rules) -> DataFrame:
    revenue = valid_lines(tables, rules).groupBy("product_id").agg(total(line_amount()).alias("revenue"))
    named = revenue.join(_product_columns(tables, "name", "category"), "product_id").select(
        F.col("product_id").alias("id"), "name", "category", "revenue"
    )
    return present(named, rules, desc("revenue"), asc("id"))


def customer_spend(tables: Tables, rules: Rules) -> DataFrame:
    """Every customer: number of orders with cancelled ones counted, money spent without them; 0 and 0 for none."""
    totals = line_totals(tables).withColumnRenamed("order_id", "id")
    spent = F.when(is_valid_order(rules), F.coalesce("total", F.lit(0))).otherwise(0)
    per_customer = (
        tables.orders.join(totals, "id", "left")
        .groupBy("customer_id")
        .agg(F.count("*").alias("orders"), F.sum(spent).alias("spend"))
    )
    customers = tables.customers.select(F.col("id").alias("customer_id"), "last_name", "first_name")
    spend = customers.join(per_customer, "customer_id", "left").select(
        F.col("customer_id").alias("id"),
        "last_name",
        "first_name",
        F.coalesce("orders", F.lit(0)).alias("orders"),
        F.coalesce("spend", F.lit(0)).cast(MONEY).alias("spend"),
    )
    return present(spend, rules, desc("spend"), asc("id"))


def basket_kpis(tables: Tables, rules: Rules) -> DataFrame:
    amounts = order_amounts(tables, rules)
    return amounts.agg(
        total("total").alias("revenue"),
        F.count("*").alias("orders"),
        ratio(total("total"), F.count("total"), 2).alias("average_basket"),
    )


def basket_by_month(tables: Tables, rules: Rules) -> DataFrame:
    per_month = (
        order_amounts(tables, rules)
        .groupBy(month_start("order_date").alias("month"))
        .agg(
            F.count("*").alias("orders"),
            total("total").alias("revenue"),
            ratio(total("total"), F.count("total"), 2).alias("average_basket"),
        )
    )
    return present(per_month, rules, asc("month"))


def _kpis(amounts: DataFrame) -> DataFrame:
    """Counting customers from their subtotals keeps the distinct count exact without carrying id sets around."""
    return customer_sales(amounts).agg(
        total("revenue").alias("revenue"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
        ratio(total("revenue"), F.sum("orders"), 2).alias("average_basket"),
        F.count("customer_id").alias("active_customers"),
    )


def sales_kpis(tables: Tables, rules: Rules) -> DataFrame:
    return _kpis(order_amounts(tables, rules))


def active_customers_window(tables: Tables, rules: Rules, as_of: datetime.date) -> DataFrame:
    """The headline figures over the months before `as_of`, that day included."""
    end = F.lit(as_of)
    recent = F.col("order_date").between(F.date_add(F.add_months(end, -rules.active_months), 1), end)
    return _kpis(order_amounts(tables, rules).filter(recent))


def cancellation_rate(tables: Tables, rules: Rules) -> DataFrame:
    """Over all orders. Unknown statuses count as not cancelled."""
    cancelled = F.sum(F.when(is_excluded(rules), 1).otherwise(0))
    orders = F.count("*")
    return tables.orders.agg(
        orders.alias("orders"),
        cancelled.alias("cancelled_orders"),
        percent(cancelled, orders, 2).alias("cancelled_pct"),
    )


def top_customers(tables: Tables, rules: Rules) -> DataFrame:
    customers = tables.customers.select(F.col("id").alias("customer_id"), "last_name", "first_name", "city")
    best = (
        customer_sales(order_amounts(tables, rules))
        .join(customers, "customer_id")
        .orderBy(desc("revenue"), asc("customer_id"))
        .limit(rules.top_customers)
    )
    return best.select(
        "customer_id",
        "last_name",
        "first_name",
        "city",
        "orders",
        F.col("revenue").cast(MONEY).alias("revenue"),
        ratio(F.col("revenue"), F.col("orders"), 2).alias("average_basket"),
    )


def top_customer_cities(tables: Tables, rules: Rules) -> DataFrame:
    """Cities of the best customers."""
    cities = top_customers(tables, rules).groupBy("city").agg(F.count("*").alias("customers"))
    return present(cities, rules, desc("customers"), text("city", rules))


def with_share(df: DataFrame, digits: int = 1, **shares: str) -> DataFrame:
    """Add, for each measure=alias, the measure's percentage of its total over all rows of a finished report.

    The window has no partition because it sees one row per reported group, never facts. A scalar subquery over the same
    aggregation would depend on adaptive execution planning both branches alike, or else read the facts twice.
    """
    whole_report = Window.partitionBy()
    return df.select(
        "*", *[percent(F.col(m), F.sum(m).over(whole_report), digits).alias(alias) for m, alias in shares.items()]
    )
