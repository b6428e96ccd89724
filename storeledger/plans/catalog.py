"""Every registered query: a name, and the job it runs over the whole star schema."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.config import Rules
from storeledger.functions.measures import is_valid_order
from storeledger.operators import baskets, integrity, loading, maintain, membership, periods, refresh, removal, sales
from storeledger.operators.grains import order_amounts
from storeledger.plans.jobs import PRICED, UNPRICED, Job, active_customers
from storeledger.sources.schema import ALL_TABLES, PRODUCTS, Minimum
from storeledger.sources.sinks import CSV, export_result, shared_folder, write_table
from storeledger.sources.star import STAR_RULES, shipped_lines, star_tables
from storeledger.sources.tables import Tables, read_table, read_tables

Query = Callable[[SparkSession, str], DataFrame]

# Quarter in which not every customer buys and not every product sells.
QUIET_QUARTER = ("1996-01-01", "1996-03-31")
ACTIVITY_DAY = datetime.date(2000, 12, 31)
# From this day on the snapshot to refresh is behind: lines of that month, cancellations of the next, all later orders.
STALE_FROM = datetime.date(1999, 11, 1)


def _query(job: Job, prices: bool = True, period: tuple[str, str] | None = None) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        tables = star_tables(spark, root, prices=prices)
        return job(tables.in_period(*period) if period else tables, STAR_RULES)

    return run


def _analyses() -> dict[str, Query]:
    in_quarter = {
        name: _query(UNPRICED[name], prices=False, period=QUIET_QUARTER)
        for name in (
            "customers_without_orders",
            "products_never_ordered",
            "products_never_validly_sold",
            "unsold_stock_value",
        )
    }
    return (
        {name: _query(job, prices=False) for name, job in UNPRICED.items()}
        | {name: _query(job) for name, job in PRICED.items()}
        | {f"{name}_in_quarter": query for name, query in in_quarter.items()}
        | {"active_customers_window": _query(active_customers(ACTIVITY_DAY))}
    )


def _checks_and_maintenance() -> dict[str, Query]:
    unpriced = partial(_query, prices=False)
    return {
        "read_tables": _read_profile,
        "monthly_summary": lambda spark, root: periods.monthly_revenue(_stored_months(spark, root), STAR_RULES),
        "monthly_summary_chrono": lambda spark, root: periods.monthly_revenue_chrono(_stored_months(spark, root), STAR_RULES),
        "write_table": _query(_stored_order_amounts),
        "export_result": _query(_exported_categories),
        "check_not_null": unpriced(lambda t, r: integrity.check_not_null(t.customers, t.customers.columns)),
        "check_primary_key": unpriced(lambda t, r: integrity.check_primary_key(t.order_lines, "order_id", "id")),
        "check_unique": unpriced(lambda t, r: integrity.check_unique(t.products, "name")),
        "check_unique_email": unpriced(lambda t, r: integrity.check_unique(t.customers, "email")),
        # Lines of cancelled orders are the orphans of the valid ones.
        "check_foreign_key": unpriced(
            lambda t, r: integrity.check_foreign_key(t.order_lines, "order_id", _valid_orders(t, r))
        ),
        "check_range": unpriced(lambda t, r: integrity.check_range(t.products, Minimum("stock", 10))),
        "check_domain": unpriced(lambda t, r: integrity.check_domain(t.orders, "status", ("F", "O"))),
        "check_length": unpriced(lambda t, r: integrity.check_length(t.products, "name", 10)),
        "constraint_report": _query(_constraint_counts),
        "apply_defaults": _read_defaults,
        "check_temporal_order": lambda spark, root: integrity.check_temporal_order(
            shipped_lines(spark, root), "order_date", "ship_date"
        ),
        "delete_cascade": unpriced(lambda t, r: _left_after_delete(t, r)[1]),
        "delete_cascade_parents": unpriced(lambda t, r: _left_after_delete(t, r)[0]),
        "delete_restrict_blockers": unpriced(
            lambda t, r: maintain.delete_restrict_blockers(
                t.customers.filter(F.col("city") == r.city), t.orders, "customer_id"
            )
        ),
        "assign_ids": unpriced(_new_line_ids),
        "refresh_months": _query(_refreshed_amounts),
        "checked_load": _query(_load_verdicts),
        "delete_rows": unpriced(_rows_after_deletes),
        "delete_rows_blockers": unpriced(lambda t, r: _products_deleted(t).blockers),
        "batch_orphans": unpriced(_lines_of_invalid_orders),
        "check_misdecoded": unpriced(lambda t, r: integrity.check_misdecoded(_misread_customers(t), ["last_name", "city"])),
        "repair_text": unpriced(lambda t, r: maintain.repair_text(_misread_customers(t))),
        "remap_ids": unpriced(_remapped_ranges),
        "remap_ids_revenue": _query(lambda t, r: sales.revenue_by_category(_remapped(t), r)),
        "check_encoding": unpriced(lambda t, r: integrity.check_encoding(t.orders, "status", ("F", "O", "p"))),
    }


def _valid_orders(tables: Tables, rules: Rules) -> DataFrame:
    return tables.orders.filter(is_valid_order(rules))


def _work_folder(spark: SparkSession) -> str:
    """A new folder where the tables go anyway, or where the cluster says."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work"
    return shared_folder(spark, root)


def _stored_shop(spark: SparkSession, root: str, without_stock: bool = False) -> Tables:
    """The star's shop as files, products without the column that has a default, as the reader finds it."""
    bound = star_tables(spark, root)
    folder = _work_folder(spark)
    shop = bound.replaced(products=lambda: bound.products.drop("stock")) if without_stock else bound
    for spec in ALL_TABLES:
        getattr(shop, spec.name).write.parquet(f"{folder}/{spec.name}")
    return read_tables(spark, folder)


def _stored_months(spark: SparkSession, root: str) -> Tables:
    """The shop with its monthly table written and read again."""
    bound = star_tables(spark, root)
    folder = f"{_work_folder(spark)}/monthly_summary"
    export_result(periods.monthly_revenue(bound, STAR_RULES), folder)
    return bound.replaced(monthly_revenue=spark.read.parquet(folder))


def _read_profile(spark: SparkSession, root: str) -> DataFrame:
    return _table_profile(_stored_shop(spark, root, without_stock=True), STAR_RULES)


def _read_defaults(spark: SparkSession, root: str) -> DataFrame:
    folder = _work_folder(spark)
    star_tables(spark, root).products.drop("stock").write.parquet(f"{folder}/products")
    return read_table(spark, folder, PRODUCTS)


def _table_profile(tables: Tables, rules: Rules) -> DataFrame:
    """What was read: rows, distinct keys and a total per table, to compare with the source."""

    def profile(name: str, df: DataFrame, key: str, measure: str) -> DataFrame:
        return df.agg(
            F.count("*").alias("rows"),
            F.max(key).alias("max_key"),
            F.sum(F.col(measure).cast("decimal(28,2)")).cast("decimal(38,2)").alias("measure"),
        ).select(F.lit(name).alias("table_name"), "*")

    return (
        profile("customers", tables.customers, "id", "id")
        .unionByName(profile("products", tables.products, "id", "price"))
        .unionByName(profile("orders", tables.orders, "id", "customer_id"))
        .unionByName(profile("order_lines", tables.order_lines, "order_id", "unit_price"))
    )


def _stored_order_amounts(tables: Tables, rules: Rules) -> DataFrame:
    """Write the snapshot as a table, drop the table's name, and summarise the files per class."""
    spark = tables.orders.sparkSession
    folder = _work_folder(spark)
    name = f"order_amounts_{folder[-12:]}"
    schema = write_table(order_amounts(tables, rules), name, path=folder).schema
    spark.sql(f"DROP TABLE {name}")
    return baskets.basket_class_summary(tables.replaced(order_amounts=spark.read.schema(schema).parquet(folder)), rules)


def _exported_categories(tables: Tables, rules: Rules) -> DataFrame:
    """Write the category report as CSV and read the part files back."""
    spark = tables.orders.sparkSession
    folder = _work_folder(spark)
    report = sales.revenue_by_category(tables, rules)
    export_result(report, folder, "csv")
    return spark.read.schema(report.schema).options(**CSV).csv(folder)


def _constraint_counts(tables: Tables, rules: Rules) -> DataFrame:
    return integrity.constraint_report(tables, integrity.with_status_domain(rules.statuses))


def _left_after_delete(tables: Tables, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Orders and order lines that remain once the cancelled orders are deleted."""
    cancelled = tables.orders.filter(F.col("status").isin(*rules.excluded_statuses))
    return maintain.delete_cascade(tables.orders, tables.order_lines, cancelled, "order_id")


def _new_line_ids(tables: Tables, rules: Rules) -> DataFrame:
    """The star's lines have no key: number them all after the largest line number, and report the ids handed out and
    the columns that came along."""
    folder = _work_folder(tables.order_lines.sparkSession)
    numbered = maintain.assign_ids(tables.order_lines, tables.order_lines, folder=folder)
    return numbered.agg(
        F.count("*").alias("rows"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.sum(F.col("id").cast("decimal(28,0)")).alias("id_sum"),
        F.sum("quantity").alias("units"),
        F.sum(F.col("order_id").cast("decimal(28,0)")).alias("order_id_sum"),
        F.sum(F.col("product_id").cast("decimal(28,0)")).alias("product_id_sum"),
    )


def _refreshed_amounts(tables: Tables, rules: Rules) -> DataFrame:
    """Order amounts after a snapshot that is behind from STALE_FROM on was brought up to date month by month."""
    spark = tables.orders.sparkSession
    prefix, folder = f"refresh_{uuid.uuid4().hex}_", _work_folder(spark)
    day = F.col("order_date")
    second, third = (F.add_months(F.lit(STALE_FROM), n) for n in (1, 2))
    uncancelled = F.when((day >= second) & F.col("status").isin(*rules.excluded_statuses), F.lit(rules.statuses[0]))
    old_orders = tables.orders.filter(day < third).withColumn("status", F.coalesce(uncancelled, "status"))
    late = tables.orders.filter((day >= F.lit(STALE_FROM)) & (day < second)).select(F.col("id").alias("order_id"))
    old_lines = tables.order_lines.join(late, "order_id", "left_anti")
    maintain.refresh_snapshots(tables.replaced(orders=old_orders, order_lines=old_lines), rules, prefix, by_month=True)

    changed = tables.orders.filter(day >= F.lit(STALE_FROM))
    fresh = refresh.refresh_months(tables, rules, changed, prefix, folder)
    export_result(order_amounts(fresh, rules), f"{folder}/amounts")
    for name in ("order_amounts", "monthly_revenue", "monthly_summary"):
        spark.sql(f"DROP TABLE {prefix}{name}")
    return spark.read.parquet(f"{folder}/amounts")


def _load_verdicts(tables: Tables, rules: Rules) -> DataFrame:
    """Rows accepted and rejected for each reason, where orders may not be cancelled and a line's key is order and number."""
    lines = tables.order_lines.withColumn("id", F.col("order_id") * 10 + F.col("id"))
    specs = integrity.with_status_domain([s for s in rules.statuses if s not in rules.excluded_statuses])
    loaded = loading.checked_load(tables.replaced(order_lines=lines), _work_folder(lines.sparkSession), specs)
    parts = []
    for spec in specs:
        name = F.lit(spec.name).alias("table_name")
        accepted = getattr(loaded.accepted, spec.name).select(name, F.lit("accepted").alias("verdict"))
        parts += [accepted, loaded.rejected[spec.name].select(name, F.explode(loading.REASONS).alias("verdict"))]
    return reduce(DataFrame.union, parts).groupBy("table_name", "verdict").agg(F.count("*").alias("rows"))


def _lines_of_invalid_orders(tables: Tables, rules: Rules) -> DataFrame:
    """The foreign-key check of all lines, as a batch, against the valid orders, as the stored table."""
    folder = _work_folder(tables.orders.sparkSession)
    return membership.batch_orphans(tables.order_lines, "order_id", _valid_orders(tables, rules), folder=folder)


def _misread_customers(tables: Tables) -> DataFrame:
    """Customers with an accent in each name, the even ones read as Latin-1 and every fourth one twice over."""
    accented = F.concat("last_name", F.lit(" payée"))
    once = F.decode(F.encode(accented, "UTF-8"), "ISO-8859-1")
    twice = F.decode(F.encode(once, "UTF-8"), "ISO-8859-1")
    id_ = F.col("id")
    name = F.when(id_ % 4 == 0, twice).when(id_ % 2 == 0, once).otherwise(accented)
    return tables.customers.withColumn("last_name", name)


def _products_deleted(tables: Tables) -> removal.Deleted:
    folder = _work_folder(tables.products.sparkSession)
    return removal.delete_rows(tables, "products", tables.products.filter("stock < 10"), folder=folder)


def _rows_after_deletes(tables: Tables, rules: Rules) -> DataFrame:
    """What remains of each table once the cancelled orders, and apart from that the products short in stock, are deleted."""
    cancelled = tables.orders.filter(F.col("status").isin(*rules.excluded_statuses))
    of_orders = removal.delete_rows(tables, "orders", cancelled, folder=_work_folder(tables.orders.sparkSession))
    plans = {"orders": of_orders, "products": _products_deleted(tables)}
    parts = [
        rows.agg(F.count("*").alias("rows"), F.sum(F.col("id").cast("decimal(28,0)")).alias("id_sum")).select(
            F.lit(plan).alias("deleted_from"), F.lit(name).alias("table_name"), "rows", "id_sum"
        )
        for plan, deleted in plans.items()
        for name, rows in deleted.remaining.items()
    ]
    return reduce(DataFrame.union, parts)


def _remapped(tables: Tables) -> Tables:
    return loading.remap_ids(tables, tables, folder=_work_folder(tables.orders.sparkSession))


def _remapped_ranges(tables: Tables, rules: Rules) -> DataFrame:
    """The shop's rows loaded a second time: the new ids of each table, and how many references still find their parent."""
    found = _remapped(tables)
    parts = []
    for spec in ALL_TABLES:
        rows = getattr(found, spec.name)
        matched = F.lit(0).cast("long")
        for r in spec.references:
            parent = getattr(found, r.parent).select(F.col("id").alias(r.column), F.lit(1).alias(f"has_{r.column}"))
            rows = rows.join(parent, r.column, "left")
            matched = matched + F.count(f"has_{r.column}")
        parts.append(
            rows.agg(F.count("*").alias("rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id"), matched.alias("matched")).select(
                F.lit(spec.name).alias("table_name"), "*"
            )
        )
    return reduce(DataFrame.union, parts)


def build_queries() -> dict[str, Query]:
    return _analyses() | _checks_and_maintenance()
