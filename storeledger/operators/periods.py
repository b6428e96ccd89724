"""Monthly and half-yearly summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeledger.config import Rules
from storeledger.functions.measures import MONEY, month_start, percent, ratio, total
from storeledger.functions.ordering import asc, desc, present
from storeledger.operators.grains import order_amounts
from storeledger.sources.tables import Tables


def monthly_revenue(tables: Tables, rules: Rules) -> DataFrame:
    """One row per month, labelled YYYY-MM. Grouping is on the date; only finished groups are formatted as text."""
    if tables.monthly_revenue is not None:
        return tables.monthly_revenue
    per_month = (
        order_amounts(tables, rules)
        .groupBy(month_start("order_date").alias("start"))
        .agg(F.count("*").alias("orders"), total("total").alias("revenue"))
    )
    return per_month.select(
        F.date_format("start", "yyyy-MM").alias("month"),
        "orders",
        "revenue",
        ratio(F.col("revenue"), F.col("orders"), 2).alias("average_basket"),
    )


def monthly_revenue_chrono(tables: Tables, rules: Rules) -> DataFrame:
    return present(monthly_revenue(tables, rules), rules, asc("month"))


def best_months(tables: Tables, rules: Rules) -> DataFrame:
    months = monthly_revenue(tables, rules).select("month", "revenue", "orders")
    return months.orderBy(desc("revenue"), asc("month")).limit(rules.top_months)


def worst_months(tables: Tables, rules: Rules) -> DataFrame:
    months = monthly_revenue(tables, rules).select("month", "revenue", "orders")
    return months.orderBy(asc("revenue"), asc("month")).limit(rules.top_months)


def semester_summary(tables: Tables, rules: Rules) -> DataFrame:
    per_semester = _per_half_year(tables, rules).select(_semester_label(rules), "orders", "revenue")
    return present(per_semester, rules, asc("semester"))


def _per_half_year(tables: Tables, rules: Rules) -> DataFrame:
    """start, orders, revenue of each half-year that has orders; a month without a label has no half-year."""
    month = F.to_date(F.concat("month", F.lit("-01")))
    half = F.add_months(F.trunc(month, "YEAR"), F.when(F.month(month) <= 6, 0).otherwise(6))
    figures = monthly_revenue(tables, rules).groupBy(half.alias("start"))
    return figures.agg(F.sum("orders").alias("orders"), total("revenue").alias("revenue"))


def _semester_label(rules: Rules) -> Column:
    first, second = rules.semester_labels
    half = F.when(F.month("start") <= 6, first).otherwise(second)
    return F.concat(F.date_format("start", "yyyy"), F.lit(" - "), half).alias("semester")


def complete(figures: DataFrame, months: int) -> DataFrame:
    """`figures` (start, orders, revenue) with a row for every step of `months` from the first to the last, 0 orders and
    no revenue where there is none. The spine has one row for each step, made by one row."""
    ends = figures.agg(F.min("start").alias("first"), F.max("start").alias("last")).filter("first IS NOT NULL")
    spine = ends.select(F.explode(F.expr(f"sequence(first, last, INTERVAL {months} MONTHS)")).alias("start"))
    # Both sides are a report's size.
    return spine.join(figures, "start", "left").select(
        "start",
        F.coalesce("orders", F.lit(0).cast("long")).alias("orders"),
        F.when(F.col("orders").isNull(), F.lit(0)).otherwise(F.col("revenue")).cast(MONEY).alias("revenue"),
    )


def monthly_calendar(tables: Tables, rules: Rules) -> DataFrame:
    """monthly_revenue without gaps: every month from the first to the last, with 0 orders, revenue 0 and no basket where
    nothing was sold."""
    figures = monthly_revenue(tables, rules).select(
        F.to_date(F.concat("month", F.lit("-01"))).alias("start"), "orders", "revenue"
    )
    average = ratio(F.col("revenue"), F.col("orders"), 2).alias("average_basket")
    months = complete(figures, 1).select(F.date_format("start", "yyyy-MM").alias("month"), "orders", "revenue", average)
    return present(months, rules, asc("month"))


def semester_calendar(tables: Tables, rules: Rules) -> DataFrame:
    """semester_summary without gaps."""
    halves = complete(_per_half_year(tables, rules), 6).select(_semester_label(rules), "orders", "revenue")
    return present(halves, rules, asc("semester"))


def semester_growth(tables: Tables, rules: Rules) -> DataFrame:
    """Each semester that has orders against the half-year just before: change of revenue and of average basket, one decimal.

    After a half-year without orders there is nothing to compare with, so both are NULL. The average basket is compared
    unrounded: as revenue times the other semester's orders.
    The window sees one row per half-year of the calendar, so its single partition stays tiny.
    """
    previous = Window.orderBy("start")
    steps = complete(_per_half_year(tables, rules), 6).select(
        "*",
        F.nullif(F.lag("orders").over(previous), F.lit(0)).alias("previous_orders"),
        F.lag("revenue").over(previous).alias("previous_revenue"),
    )
    revenue, before = F.col("revenue"), F.col("previous_revenue")
    now_scaled = revenue * F.col("previous_orders")
    before_scaled = before * F.col("orders")
    growth = steps.filter("orders > 0").select(
        _semester_label(rules),
        "orders",
        "revenue",
        ratio(revenue, F.col("orders"), 2).alias("average_basket"),
        percent(revenue - before, before, 1).alias("revenue_growth_pct"),
        percent(now_scaled - before_scaled, before_scaled, 1).alias("average_basket_growth_pct"),
    )
    return present(growth, rules, asc("semester"))
