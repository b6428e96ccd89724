"""The inputs of every job, and the readers that build them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeledger.sources.schema import ALL_TABLES, TableSpec
from storeledger.sources.sinks import CSV

# Column of a stored order-amounts table that names its month's folder.
MONTH_FOLDER = "order_month"

Frame = DataFrame | Callable[[], DataFrame]


class Tables:
    """The four base tables, plus snapshots that jobs read instead of recomputing when they are given.

    A table may be given as a function; it is then built when a job first asks for it, so that a job over orders does
    not pay for binding products.
    """

    def __init__(
        self,
        customers: Frame,
        products: Frame,
        orders: Frame,
        order_lines: Frame,
        order_amounts: Frame | None = None,
        monthly_revenue: Frame | None = None,
        stored_lines: Frame | None = None,
        unpriced_lines: Frame | None = None,
    ) -> None:
        self._sources = {
            "customers": customers,
            "products": products,
            "orders": orders,
            "order_lines": order_lines,
            "order_amounts": order_amounts,
            "monthly_revenue": monthly_revenue,
            "stored_lines": stored_lines,
            "unpriced_lines": unpriced_lines,
        }

    def _frame(self, name: str) -> DataFrame | None:
        source = self._sources[name]
        return source() if callable(source) else source

    @cached_property
    def customers(self) -> DataFrame:
        return self._frame("customers")

    @cached_property
    def products(self) -> DataFrame:
        return self._frame("products")

    @cached_property
    def orders(self) -> DataFrame:
        return self._frame("orders")

    @cached_property
    def order_lines(self) -> DataFrame:
        return self._frame("order_lines")

    @cached_property
    def order_amounts(self) -> DataFrame | None:
        return self._frame("order_amounts")

    @cached_property
    def monthly_revenue(self) -> DataFrame | None:
        return self._frame("monthly_revenue")

    @cached_property
    def stored_lines(self) -> DataFrame:
        """All lines, for jobs that join them with `orders` anyway; `order_lines` when no period was chosen."""
        lines = self._frame("stored_lines")
        return self.order_lines if lines is None else lines

    @cached_property
    def unpriced_lines(self) -> DataFrame:
        """All lines, for jobs that read no price: where the price takes a join to find, the source leaves it out here."""
        lines = self._frame("unpriced_lines")
        return self.stored_lines if lines is None else lines

    def replaced(self, **frames: Frame | None) -> Tables:
        return Tables(**(self._sources | frames))

    def in_period(self, start: str, end: str) -> Tables:
        """The same shop seen through the orders dated from `start` to `end`, both included.

        `order_lines` follows the orders through a semi join with lines on the probe side, so a hot order is split by
        adaptive skew handling instead of landing in one task.
        """
        orders = self.orders.filter(between_dates(start, end))
        amounts = self.order_amounts
        return self.replaced(
            orders=orders,
            order_lines=lambda: lines_of(self.stored_lines, orders),
            order_amounts=None if amounts is None else amounts.filter(_in_months(amounts, start, end) & between_dates(start, end)),
            monthly_revenue=None,
            stored_lines=lambda: self.stored_lines,
        )


def lines_of(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """The lines that belong to `orders`."""
    keys = orders.select(F.col("id").alias("order_id"))
    return lines.join(keys, "order_id", "left_semi").select(*lines.columns)


def _in_months(amounts: DataFrame, start: str, end: str) -> Column:
    """The folders a period touches, if the table has them."""
    if MONTH_FOLDER not in amounts.columns:
        return F.lit(True)
    first, last = (F.trunc(F.lit(day).cast("date"), "MM") for day in (start, end))
    return F.col(MONTH_FOLDER).between(first, last)


def between_dates(start: str, end: str) -> Column:
    return F.col("order_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def read_tables(
    spark: SparkSession,
    root: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    names: Mapping[str, str] | None = None,
) -> Tables:
    """Read `<root>/<table>` with the declared schemas; no inference pass over the files.

    A declared column that the files lack gets its default, or stops the job here if it has none. CSV files need a header
    with the declared columns in order; a value of the wrong type stops the job. They are read one task per file, since a value may
    hold line breaks, so many moderate files read faster than one. `names` maps "table" and "table.column" to what they are
    called in the files, for instance `schema.FRENCH_NAMES`.

    Statuses are read as they are, in either Unicode form; `maintain.store_tables` writes them in the declared one.
    """
    return Tables(**{spec.name: read_table(spark, root, spec, fmt, options, names) for spec in ALL_TABLES})


def read_table(
    spark: SparkSession,
    root: str,
    spec: TableSpec,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """One table, as `read_tables` reads it."""
    reader_options = {**(CSV if fmt == "csv" else {}), **(options or {})}
    called = {f.name: (names or {}).get(f"{spec.name}.{f.name}", f.name) for f in spec.schema}
    folder = f"{root}/{(names or {}).get(spec.name, spec.name)}"
    present = spark.read.format(fmt).options(**reader_options).load(folder).columns
    absent = [name for name in spec.schema.names if called[name] not in present]
    if unknown := [called[name] for name in absent if name not in spec.defaults]:
        raise ValueError(f"{folder} has no column {', '.join(unknown)}")
    given = {called[f.name]: f for f in spec.schema if f.name not in absent}
    schema = T.StructType([T.StructField(c, f.dataType) for c, f in given.items()])
    files = spark.read.schema(schema).format(fmt).options(**reader_options).load(folder)
    columns = [
        F.lit(spec.defaults[f.name]).cast(f.dataType).alias(f.name) if f.name in absent else F.col(f"`{called[f.name]}`").alias(f.name)
        for f in spec.schema
    ]
    return files.select(*columns) if names or absent else files


def tables_from_rows(spark: SparkSession, rows: Mapping[str, Iterable[tuple]]) -> Tables:
    """Tables from literal rows, for a handful of records typed by hand; a NULL in a required column is rejected."""
    return Tables(**{spec.name: spark.createDataFrame(list(rows.get(spec.name, ())), spec.schema) for spec in ALL_TABLES})
