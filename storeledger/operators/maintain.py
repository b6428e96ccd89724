"""Keeping tables whole: defaults, deletes across references, new ids, snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from storeledger.config import Rules
from storeledger.functions.measures import month_start
from storeledger.functions.text import canonical, repaired
from storeledger.operators.grains import order_amounts
from storeledger.operators.periods import monthly_revenue
from storeledger.sources.schema import ALL_TABLES, TableSpec
from storeledger.sources.sinks import staged, write_table
from storeledger.sources.tables import MONTH_FOLDER, Tables, read_tables


def refresh_snapshots(tables: Tables, rules: Rules, prefix: str = "", by_month: bool = False) -> Tables:
    """Rebuild the stored order amounts and both monthly tables; the result reads from them. Safe to rerun.

    With `by_month` the amounts are stored in one folder per month, and a period reads the folders of its months only.
    """
    live = tables.replaced(order_amounts=None, monthly_revenue=None)
    amounts = order_amounts(live, rules)
    if by_month:
        amounts = amounts.withColumn(MONTH_FOLDER, month_start("order_date"))
    held = write_table(amounts, f"{prefix}order_amounts", partition_by=[MONTH_FOLDER] if by_month else ())
    stored = live.replaced(order_amounts=held)
    monthly = write_table(monthly_revenue(stored, rules), f"{prefix}monthly_revenue")
    write_table(monthly, f"{prefix}monthly_summary")
    return stored.replaced(monthly_revenue=monthly)


def normalised_orders(orders: DataFrame, rules: Rules) -> DataFrame:
    """Orders with each status in its declared Unicode spelling. Unknown statuses stay, for the checks to report."""
    status = F.col("status")
    return orders.withColumn("status", F.coalesce(canonical(status, rules.statuses), status))


def store_tables(tables: Tables, rules: Rules, root: str) -> Tables:
    """Write the base tables to `<root>/<table>`, statuses normalised and absent defaults filled, and read them there."""
    for spec in ALL_TABLES:
        df = apply_defaults(getattr(tables, spec.name), spec)
        if spec.name == "orders":
            df = normalised_orders(df, rules)
        df.write.mode("overwrite").parquet(f"{root}/{spec.name}")
    return read_tables(df.sparkSession, root)


def repair_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """`df` with UTF-8 text that was read as Latin-1 or code page 1252 put right, in all text columns or those named.

    A value is repaired whole or not at all (see `functions.text.redecoded`); sound text, NULL and the other columns stay.
    """
    names = columns if columns is not None else [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    return df.withColumns({name: repaired(F.col(f"`{name}`")) for name in names}) if names else df


def apply_defaults(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add each defaulted column that is absent. A NULL that was given stays NULL, for the not-null check to find."""
    absent = {c: F.lit(v).cast(spec.schema[c].dataType) for c, v in spec.defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def delete_cascade(
    parents: DataFrame, children: DataFrame, doomed: DataFrame, child_key: str, key: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """Parents and children that remain after deleting the parents whose key is in `doomed`.

    The large tables are on the preserved side of each anti join, where a hot key can be split.
    """
    keys = doomed.select(key)
    child_keys = keys.withColumnRenamed(key, child_key)
    return (
        parents.join(keys, key, "left_anti").select(*parents.columns),
        children.join(child_keys, child_key, "left_anti").select(*children.columns),
    )


def delete_restrict_blockers(doomed: DataFrame, children: DataFrame, child_key: str, key: str = "id") -> DataFrame:
    """Keys in `doomed` that may not be deleted because child rows use them, with the number of those rows."""
    used = children.groupBy(F.col(child_key).alias(key)).agg(F.count("*").alias("children"))
    return used.join(doomed.select(key), key, "left_semi")


def assign_ids(
    incoming: DataFrame, existing: DataFrame, id_column: str = "id", folder: str | None = None
) -> DataFrame:
    """`incoming`, all its columns, with consecutive ids that continue after the largest one in `existing`.

    This job acts when it is called: it writes to a new folder below `folder`, or below `spark.checkpoint.dir`.

    Each row's id is its partition's offset plus its position in the partition: no shuffle and no global sort of the
    rows. Positions depend on how rows fell into partitions, so they are written to shared storage before the offsets
    are computed; a task rerun after a lost executor then reads the same positions. The running sum covers one row per
    partition, which also bounds what is broadcast.
    """
    kept = [F.col(f"`{c}`") for c in incoming.columns if c != id_column]
    prefix = "_"
    while any(c.startswith(prefix) for c in incoming.columns):
        prefix += "_"
    part, position, count, offset = (prefix + name for name in ("part", "position", "count", "offset"))
    position_bits = (1 << 33) - 1
    placed = staged(
        incoming.select(
            *kept,
            F.spark_partition_id().alias(part),
            F.monotonically_increasing_id().bitwiseAND(F.lit(position_bits)).alias(position),
        ),
        folder,
    )
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part)
        .agg(F.count("*").alias(count))
        .select(part, F.coalesce(F.sum(count).over(before), F.lit(0)).alias(offset))
    )
    last = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("long").alias("last")).scalar()
    new_id = (last + F.col(offset) + F.col(position) + 1).alias(id_column)
    return placed.join(F.broadcast(offsets), part).select(new_id, *kept)
