"""First look at the tables: listings, counts, line and order amounts, schema report."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeledger.config import Rules
from storeledger.functions.measures import MONEY, line_amount
from storeledger.functions.ordering import asc, desc, present, text
from storeledger.operators.grains import line_totals
from storeledger.sources.tables import Tables


def product_catalog(tables: Tables, rules: Rules) -> DataFrame:
    products = present(tables.products, rules, text("category", rules), text("name", rules), asc("id"))
    return products.select("name", "category", "price", "stock")


def products_above_price(tables: Tables, rules: Rules) -> DataFrame:
    products = tables.products.filter(F.col("price") > rules.price_threshold)
    return present(products, rules, desc("price"), asc("id")).select("name", "category", "price", "stock")


def customers_in_city(tables: Tables, rules: Rules) -> DataFrame:
    customers = tables.customers.filter(F.col("city") == rules.city)
    return present(customers, rules, text("last_name", rules), text("first_name", rules), asc("id"))


def customers_per_city(tables: Tables, rules: Rules) -> DataFrame:
    counts = tables.customers.groupBy("city").agg(F.count("*").alias("customers"))
    return present(counts, rules, desc("customers"), text("city", rules))


def orders_with_customer(tables: Tables, rules: Rules) -> DataFrame:
    orders = tables.orders.withColumnRenamed("id", "order_id")
    customers = tables.customers.withColumnRenamed("id", "customer_id")
    joined = orders.join(customers, "customer_id").select(
        "order_id",
        "order_date",
        "status",
        "customer_id",
        "last_name",
        "first_name",
        "email",
        "city",
        "signup_date",
    )
    return present(joined, rules, asc("order_date"), asc("order_id"))


def line_amounts(tables: Tables, rules: Rules) -> DataFrame:
    """Every line with its amount, cancelled orders included.

    The product ends the sort keys for sources whose line ids repeat: a hot order must not become one range partition.
    """
    lines = tables.order_lines.select(
        "id", "order_id", "product_id", "quantity", "unit_price", line_amount().cast(MONEY).alias("amount")
    )
    return present(lines, rules, asc("order_id"), asc("id"), asc("product_id"))


def order_totals(tables: Tables, rules: Rules) -> DataFrame:
    """Every order with its total, cancelled orders included; 0 for an order without lines."""
    totals = line_totals(tables).withColumnRenamed("order_id", "id")
    orders = tables.orders.join(totals, "id", "left").select(
        "id", "order_date", "status", F.coalesce("total", F.lit(0)).cast(MONEY).alias("total")
    )
    return present(orders, rules, asc("id"))


def table_row_counts(tables: Tables, rules: Rules) -> DataFrame:
    named = {
        "customers": tables.customers,
        "products": tables.products,
        "orders": tables.orders,
        "order_lines": tables.order_lines,
    }
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in named.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def row_count(df: DataFrame, alias: str) -> DataFrame:
    return df.agg(F.count("*").alias(alias))


# SQL names of the column types a report shows.
_SQL_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
    "timestamp_ntz": "TIMESTAMP",
}

_REPORT_SCHEMA = "table_name string, position int, column_name string, data_type string, max_length int, is_nullable string"


def schema_report(spark: SparkSession, schemas: Mapping[str, T.StructType]) -> DataFrame:
    """One row per column, in declared order; built from schemas alone, no data is read."""
    rows = [
        (
            table,
            position,
            field.name,
            _SQL_TYPES.get(field.dataType.simpleString(), field.dataType.simpleString().upper()),
            field.metadata.get("max_length"),
            "YES" if field.nullable else "NO",
        )
        for table in sorted(schemas)
        for position, field in enumerate(schemas[table], start=1)
    ]
    return spark.createDataFrame(rows, _REPORT_SCHEMA)
