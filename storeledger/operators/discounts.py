"""What discounts cost and whether they sell more. All figures are sums over the grain of product and price paid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.config import Rules
from storeledger.functions.measures import percent, ratio, total
from storeledger.functions.ordering import asc, desc, present, text
from storeledger.operators.grains import sales_by_paid_price
from storeledger.operators.sales import with_share
from storeledger.sources.tables import Tables


def _units_at(price: Column) -> Column:
    return F.col("units") * price


def _discount() -> Column:
    return _units_at(F.col("price") - F.col("unit_price"))


def _discounted_lines() -> Column:
    return F.sum(F.when(F.col("unit_price") < F.col("price"), F.col("lines")).otherwise(0))


def _line_count() -> Column:
    return F.coalesce(F.sum("lines"), F.lit(0))


def discount_overview(tables: Tables, rules: Rules) -> DataFrame:
    return sales_by_paid_price(tables, rules).agg(
        _line_count().alias("lines"),
        _discounted_lines().alias("discounted_lines"),
        percent(_discounted_lines(), F.sum("lines"), 1).alias("discounted_pct"),
        total(_units_at(F.col("price"))).alias("catalogue_revenue"),
        total(_units_at(F.col("unit_price"))).alias("revenue"),
        total(_discount()).alias("discount"),
    )


def discount_by_rate(tables: Tables, rules: Rules) -> DataFrame:
    """Per whole-percent rate; lines of a product with catalogue price 0 have no rate and form their own group."""
    rate = percent(F.col("price") - F.col("unit_price"), F.col("price"), 0).cast("bigint")
    by_rate = (
        sales_by_paid_price(tables, rules)
        .groupBy(rate.alias("discount_pct"))
        .agg(
            _line_count().alias("lines"),
            F.sum("units").alias("units"),
            ratio(F.sum("units"), F.sum("lines"), 2).alias("units_per_line"),
            total(_units_at(F.col("unit_price"))).alias("revenue"),
            total(_discount()).alias("discount"),
        )
    )
    return present(by_rate, rules, asc("discount_pct"))


def discount_by_category(tables: Tables, rules: Rules) -> DataFrame:
    by_category = (
        sales_by_paid_price(tables, rules)
        .groupBy("category")
        .agg(
            _line_count().alias("lines"),
            percent(_discounted_lines(), F.sum("lines"), 1).alias("discounted_pct"),
            total(_discount()).alias("discount"),
        )
    )
    return present(by_category, rules, desc("discount"), text("category", rules))


def discount_rate_shares(tables: Tables, rules: Rules) -> DataFrame:
    """Share of lines per discount rate, one decimal."""
    by_rate = discount_by_rate(tables, rules.unordered()).select("discount_pct", "lines")
    return present(with_share(by_rate, lines="lines_pct"), rules, asc("discount_pct"))


def discount_cost_pct(tables: Tables, rules: Rules) -> DataFrame:
    """Discounts as a percentage of revenue at catalogue price, one decimal."""
    overview = discount_overview(tables, rules)
    return overview.select(
        "catalogue_revenue", "discount", percent(F.col("discount"), F.col("catalogue_revenue"), 1).alias("discount_cost_pct")
    )


def lines_above_catalogue(tables: Tables, rules: Rules) -> DataFrame:
    """Number of lines paid above the catalogue price."""
    above = sales_by_paid_price(tables, rules).filter(F.col("unit_price") > F.col("price"))
    return above.agg(_line_count().alias("lines"))
