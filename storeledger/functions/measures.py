"""Column expressions shared by the jobs. Amounts stay decimal from the line to the report; nothing goes through double."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from storeledger.config import Rules
from storeledger.functions.text import spellings

# Widest decimal with two digits: a total over any number of lines fits.
MONEY = "decimal(38,2)"
WHOLE = "decimal(38,0)"


def line_amount() -> Column:
    """Amount of an order line: quantity at the price actually paid."""
    return F.col("quantity") * F.col("unit_price")


def total(column: str | Column) -> Column:
    return F.sum(column).cast(MONEY)


def is_valid_order(rules: Rules) -> Column:
    """True when the status counts as a sale. NULL status gives NULL, which a filter drops.

    Both Unicode forms of a status are plain values, so the filter reaches the scan whatever form the files hold.
    """
    return ~is_excluded(rules)


def is_excluded(rules: Rules) -> Column:
    return F.col("status").isin(*spellings(rules.excluded_statuses))


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """numerator / denominator rounded half away from zero, exact; NULL on a zero or NULL denominator.

    A decimal quotient in Spark has a fixed scale, and rounding it a second time can land on the wrong side of a
    half. Both operands carry at most two decimals, so the quotient is rounded once, by whole-number division after
    moving the numerator half a denominator away from zero. The remainder is taken off before dividing, which leaves
    nothing to round; a value beyond 38 digits stops the job.
    """
    n = (numerator.cast(MONEY) * (200 * 10**digits)).cast(WHOLE)
    d = (denominator.cast(MONEY) * 100).cast(WHOLE)
    half = F.when(n < 0, -F.abs(d)).otherwise(F.abs(d))
    moved, step = (n + half).cast(WHOLE), F.nullif((d * 2).cast(WHOLE), F.lit(0))
    steps = ((moved - moved % step) / step).cast(WHOLE)
    return (steps * Decimal(1).scaleb(-digits)).cast(f"decimal(38,{digits})")


def percent(part: Column, whole: Column, digits: int) -> Column:
    return ratio(part.cast(MONEY) * 100, whole, digits)


def month_start(column: str) -> Column:
    return F.trunc(column, "MM")
