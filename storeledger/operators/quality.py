"""Missing values, customers without orders, and orders dated before the customer signed up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeledger.config import Rules
from storeledger.functions.ordering import asc, desc, present
from storeledger.functions.text import is_blank
from storeledger.sources.tables import Tables


def missing_values(df: DataFrame, columns: Sequence[str], blank_is_missing: bool = True) -> DataFrame:
    """One row, one `<column>_missing` count per column, in a single pass over `df`."""
    types = {field.name: field.dataType for field in df.schema}

    def missing(name: str):
        if blank_is_missing and isinstance(types[name], T.StringType):
            return is_blank(F.col(name))
        return F.col(name).isNull()

    return df.agg(*[F.count_if(missing(name)).alias(f"{name}_missing") for name in columns])


def missing_customers(tables: Tables, rules: Rules) -> DataFrame:
    return missing_values(tables.customers, ["last_name", "first_name", "email", "city", "signup_date"])


def missing_products(tables: Tables, rules: Rules) -> DataFrame:
    return missing_values(tables.products, ["name", "category", "price", "stock"])


def missing_orders(tables: Tables, rules: Rules) -> DataFrame:
    """NULLs only: a blank status is the domain check's business."""
    return missing_values(tables.orders, ["customer_id", "order_date", "status"], blank_is_missing=False)


def missing_order_lines(tables: Tables, rules: Rules) -> DataFrame:
    return missing_values(
        tables.order_lines, ["order_id", "product_id", "quantity", "unit_price"], blank_is_missing=False
    )


def customers_without_orders(tables: Tables, rules: Rules) -> DataFrame:
    """No order at all; a cancelled order counts. Buyers are made distinct first so that a hot buyer is one row."""
    buyers = tables.orders.select(F.col("customer_id").alias("id")).distinct()
    idle = tables.customers.join(buyers, "id", "left_anti").select("id", "last_name", "first_name", "email")
    return present(idle, rules, asc("id"))


def _early_orders(tables: Tables) -> DataFrame:
    """Cancelled orders included. An equi join plus a row filter, never a range join."""
    orders = tables.orders.withColumnRenamed("id", "order_id")
    signups = tables.customers.select(F.col("id").alias("customer_id"), "signup_date")
    early = orders.join(signups, "customer_id").filter(F.col("order_date") < F.col("signup_date"))
    return early.select(
        "order_id",
        "customer_id",
        "order_date",
        "signup_date",
        F.datediff("signup_date", "order_date").alias("days_early"),
        "status",
    )


def orders_before_signup(tables: Tables, rules: Rules) -> DataFrame:
    return present(_early_orders(tables), rules, desc("days_early"), asc("order_id"))


def orders_before_signup_count(tables: Tables, rules: Rules) -> DataFrame:
    return _early_orders(tables).agg(F.count("*").alias("anomalies"))


def anomalies_per_customer(tables: Tables, rules: Rules) -> DataFrame:
    """Orders are counted per customer and day before they meet the signups, so a hot customer joins as one row a day."""
    days = tables.orders.groupBy("customer_id", "order_date").agg(F.count("*").alias("orders"))
    signups = tables.customers.select(F.col("id").alias("customer_id"), "signup_date")
    early = days.join(signups, "customer_id").filter(F.col("order_date") < F.col("signup_date"))
    per_customer = early.groupBy("customer_id").agg(F.sum("orders").alias("early_orders"))
    return present(per_customer, rules, desc("early_orders"), asc("customer_id"))


def anomaly_gap_range(tables: Tables, rules: Rules) -> DataFrame:
    return _early_orders(tables).agg(
        F.min("days_early").alias("min_days_early"), F.max("days_early").alias("max_days_early")
    )
