"""Customers and sales of the trailing months, at the end of every month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeledger.config import Rules
from storeledger.functions.measures import MONEY, month_start, ratio
from storeledger.functions.ordering import asc, present
from storeledger.operators.grains import order_amounts
from storeledger.sources.tables import Tables


def active_customers_by_month(tables: Tables, rules: Rules) -> DataFrame:
    """month, revenue, orders, average_basket, active_customers: the headline figures of the `active_months` up to the end of
    each month, from the first month with an order to the last, those without orders included.

    A sweep: an order counts from its own month on until the window has passed it. Orders are summed per customer and
    month first; a customer's stretch ends where the next one begins, so overlapping stretches count once. What remains are
    one event where figures begin and one where they end, summed per month, and a running sum over the calendar. No
    order meets a window, no window counts distinct customers, and a customer with a third of all orders is a row for
    each month.
    """
    dated = order_amounts(tables, rules).filter("order_date IS NOT NULL")
    per_month = dated.groupBy("customer_id", month_start("order_date").alias("start"), _until(rules).alias("until")).agg(
        F.count("*").alias("orders"), F.count("total").alias("priced"), F.sum("total").alias("revenue")
    )
    figures = ["orders", "priced", "revenue", "customers"]
    nobody = F.lit(0).cast("long")
    sales = per_month.groupBy("start", "until").agg(*[F.sum(c).alias(c) for c in figures[:3]]).withColumn("customers", nobody)

    # A stretch with a later end (see `_until`) also begins last among those of its month, or ends with the next one.
    stretches = per_month.filter("customer_id IS NOT NULL").groupBy("customer_id", "start").agg(F.max("until").alias("until"))
    following = F.lead("start").over(Window.partitionBy("customer_id").orderBy("start"))
    stretches = stretches.select("start", F.least("until", following).alias("until"))
    customers = stretches.groupBy("start", "until").agg(F.count("*").alias("customers"))
    customers = customers.select("start", "until", nobody.alias("orders"), nobody.alias("priced"), F.lit(0).cast(MONEY).alias("revenue"), "customers")

    spans = sales.select("start", "until", "orders", "priced", F.coalesce(F.col("revenue"), F.lit(0)).cast(MONEY).alias("revenue"), "customers").union(customers)
    begun = spans.select(F.col("start").alias("month"), *figures)
    ended = spans.select(F.col("until").alias("month"), *[(-F.col(c)).alias(c) for c in figures])
    changes = begun.union(ended).groupBy("month").agg(*[F.sum(c).alias(c) for c in figures])

    ends = sales.agg(F.min("start").alias("first"), F.max("start").alias("last")).filter("first IS NOT NULL")
    spine = ends.select(F.explode(F.expr("sequence(first, last, INTERVAL 1 MONTH)")).alias("month"))
    # One row for each month of the calendar.
    so_far = Window.orderBy("month")
    running = spine.join(changes, "month", "left").select("month", *[F.coalesce(F.sum(c).over(so_far), F.lit(0)).alias(c) for c in figures])
    revenue = F.when(F.col("priced") > 0, F.col("revenue")).cast(MONEY)
    found = running.select(
        F.date_format("month", "yyyy-MM").alias("month"),
        revenue.alias("revenue"),
        F.col("orders").cast("long").alias("orders"),
        ratio(revenue, F.col("orders"), 2).alias("average_basket"),
        F.col("customers").cast("long").alias("active_customers"),
    )
    return present(found, rules, asc("month"))


def _until(rules: Rules) -> Column:
    """The first month at whose end the order no longer counts.

    The window reaches back from a month's last day to the day after the same day of the month so many before, which is not
    that month's last day if the month is longer: the 29th of February still counts on the 28th a year later.
    """
    span = rules.active_months
    last_day = F.last_day(F.add_months(F.trunc("order_date", "MM"), span))
    still = F.add_months(last_day, -span) < F.col("order_date")
    return F.add_months(F.trunc("order_date", "MM"), span + still.cast("int"))
