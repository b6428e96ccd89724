"""Every analysis of a shop under its name, and a run of all of them over one's own tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable
from functools import partial

from pyspark.sql import DataFrame

from storeledger.config import Rules
from storeledger.operators import activity, baskets, cities, discounts, explore, periods, products, quality, sales
from storeledger.operators.grains import order_amounts
from storeledger.sources.sinks import export_result
from storeledger.sources.tables import Tables

Job = Callable[[Tables, Rules], DataFrame]


def _rows(table: str) -> Job:
    return lambda tables, rules: explore.row_count(getattr(tables, table), table)


# Jobs that read no price paid: where the price takes a join to find, they do without it.
UNPRICED: dict[str, Job] = {
    "product_catalog": explore.product_catalog,
    "products_above_price": explore.products_above_price,
    "customers_in_city": explore.customers_in_city,
    "customers_per_city": explore.customers_per_city,
    "orders_with_customer": explore.orders_with_customer,
    "top_products_by_quantity": sales.top_products_by_quantity,
    "customers_without_orders": quality.customers_without_orders,
    "cancellation_rate": sales.cancellation_rate,
    "orders_before_signup": quality.orders_before_signup,
    "orders_before_signup_count": quality.orders_before_signup_count,
    "products_never_ordered": products.products_never_ordered,
    "products_never_validly_sold": products.products_never_validly_sold,
    "unsold_stock_value": products.unsold_stock_value,
    "table_row_counts": explore.table_row_counts,
    "row_count_customers": _rows("customers"),
    "row_count_products": _rows("products"),
    "row_count_orders": _rows("orders"),
    "row_count_order_lines": _rows("order_lines"),
    "missing_customers": quality.missing_customers,
    "missing_products": quality.missing_products,
    "missing_orders": quality.missing_orders,
    "anomalies_per_customer": quality.anomalies_per_customer,
    "anomaly_gap_range": quality.anomaly_gap_range,
}

PRICED: dict[str, Job] = {
    "line_amounts": explore.line_amounts,
    "order_totals": explore.order_totals,
    # Sales by category, product and customer.
    "revenue_by_category": sales.revenue_by_category,
    "products_by_revenue": sales.products_by_revenue,
    "customer_spend": sales.customer_spend,
    "basket_kpis": sales.basket_kpis,
    "basket_by_month": sales.basket_by_month,
    # Order amounts and what is read from them.
    "order_amounts": order_amounts,
    "classify_baskets": baskets.classify_baskets,
    "basket_class_summary": baskets.basket_class_summary,
    "monthly_revenue": periods.monthly_revenue,
    "monthly_revenue_chrono": periods.monthly_revenue_chrono,
    "best_months": periods.best_months,
    "worst_months": periods.worst_months,
    "semester_summary": periods.semester_summary,
    "monthly_calendar": periods.monthly_calendar,
    "semester_calendar": periods.semester_calendar,
    "active_customers_by_month": activity.active_customers_by_month,
    "sales_kpis": sales.sales_kpis,
    "top_customers": sales.top_customers,
    "missing_order_lines": quality.missing_order_lines,
    # Stock, discounts, cities.
    "stock_cover": products.stock_cover,
    "discount_overview": discounts.discount_overview,
    "discount_by_rate": discounts.discount_by_rate,
    "discount_by_category": discounts.discount_by_category,
    "revenue_by_city": cities.revenue_by_city,
    # Figures derived from the above.
    "basket_class_shares": baskets.basket_class_shares,
    "semester_growth": periods.semester_growth,
    "risk_class_counts": products.risk_class_counts,
    "discount_rate_shares": discounts.discount_rate_shares,
    "discount_cost_pct": discounts.discount_cost_pct,
    "lines_above_catalogue": discounts.lines_above_catalogue,
    "top_customer_cities": sales.top_customer_cities,
    "category_shares": sales.category_shares,
}

JOBS: dict[str, Job] = UNPRICED | PRICED


def active_customers(as_of: datetime.date) -> Job:
    """The headline figures of the year up to a day."""
    return partial(sales.active_customers_window, as_of=as_of)


def run(tables: Tables, rules: Rules, out: str, fmt: str = "parquet", names: Iterable[str] | None = None) -> list[str]:
    """Write the result of each job, or of those named, to `<out>/<name>`, replacing an earlier run's; the folders written.

    Give it tables with snapshots (`maintain.refresh_snapshots`) to have order amounts and months computed once.
    """
    folders = []
    for name in names or JOBS:
        folder = f"{out.rstrip('/')}/{name}"
        export_result(JOBS[name](tables, rules), folder, fmt)
        folders.append(folder)
    return folders
