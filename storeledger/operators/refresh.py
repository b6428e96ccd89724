"""Incremental refresh of the stored months that changed orders touch."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.config import Rules
from storeledger.functions.measures import month_start
from storeledger.operators.grains import order_amounts
from storeledger.operators.periods import monthly_revenue
from storeledger.sources.sinks import drop_partition, overwrite_partitions, staged, write_table
from storeledger.sources.tables import MONTH_FOLDER, Tables, lines_of

Months = Sequence[datetime.date | None]


def refresh_months(tables: Tables, rules: Rules, changed_orders: DataFrame, prefix: str = "", folder: str | None = None) -> Tables:
    """Bring the stored order amounts and monthly tables up to date with `tables`; the result reads from them.

    The snapshots are those of `maintain.refresh_snapshots(..., by_month=True)` under the same `prefix`, and `tables` is the
    shop as it is now. `changed_orders` (order_date) has the date of each order that was added, removed or cancelled, whose
    lines or status changed, or whose date moved; the latter under its old and its new date. Other columns are ignored.

    Only the months of those dates are worked out again, replaced as whole folders, and read back; a month left without
    orders loses its folder. Intermediate files go to a new folder below `folder`, or below `spark.checkpoint.dir`. Months are few whatever the data's size, so their list is what the driver holds. Every step
    replaces, so a run that broke off is repeated from the start. No dates leave the snapshots as they are.
    """
    spark = tables.orders.sparkSession
    amounts, monthly = f"{prefix}order_amounts", f"{prefix}monthly_revenue"
    live = tables.replaced(order_amounts=None, monthly_revenue=None)
    months = [row[0] for row in changed_orders.select(month_start("order_date")).distinct().collect()]
    if months:
        orders = live.orders.filter(dated_in("order_date", months))
        touched = live.replaced(orders=orders, stored_lines=lambda: lines_of(live.stored_lines, orders))
        # Staged, so that the rows written and the months that have any come from one computation.
        fresh = staged(order_amounts(touched, rules).withColumn(MONTH_FOLDER, month_start("order_date")), folder)
        overwrite_partitions(fresh, amounts, [MONTH_FOLDER])
        held = {row[0] for row in fresh.select(MONTH_FOLDER).distinct().collect()}
        for month in set(months) - held:
            drop_partition(spark, amounts, MONTH_FOLDER, month)
        spark.catalog.refreshTable(amounts)

        stored = live.replaced(order_amounts=spark.table(amounts).filter(in_folders(months)))
        labels = [None if m is None else m.strftime("%Y-%m") for m in months]
        kept = spark.table(monthly).filter(~_among("month", labels))
        # One row a month; staged, because the table it replaces is read.
        held_months = staged(kept.unionByName(monthly_revenue(stored, rules)), folder)
        write_table(held_months, monthly)
        write_table(held_months, f"{prefix}monthly_summary")
    return live.replaced(order_amounts=spark.table(amounts), monthly_revenue=spark.table(monthly))


def _among(column: str, values: Sequence[object]) -> Column:
    """True for the values, NULL among them if it is listed; never NULL."""
    known = [v for v in values if v is not None]
    found = F.coalesce(F.col(column).isin(*known), F.lit(False)) if known else F.lit(False)
    return found | F.col(column).isNull() if None in values else found


def in_folders(months: Months) -> Column:
    """Rows of a stored table in the folders of `months`, a filter that selects folders."""
    parts = [F.col(MONTH_FOLDER) == F.lit(m) if m is not None else F.col(MONTH_FOLDER).isNull() for m in months]
    return reduce(Column.__or__, parts)


def dated_in(column: str, months: Months) -> Column:
    """Dates of `months`, given by their first days: one range for each run of neighbouring months, which reaches the scan."""
    runs: list[list[datetime.date]] = []
    for first in sorted(m for m in months if m is not None):
        after = datetime.date(first.year + first.month // 12, first.month % 12 + 1, 1)
        if runs and runs[-1][1] == first:
            runs[-1][1] = after
        else:
            runs.append([first, after])
    parts = [(F.col(column) >= F.lit(a)) & (F.col(column) < F.lit(b)) for a, b in runs]
    if None in months:
        parts.append(F.col(column).isNull())
    return reduce(Column.__or__, parts, F.lit(False)) if len(parts) != 1 else parts[0]
