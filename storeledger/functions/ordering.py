"""Sort keys with explicit NULL placement: last when ascending, first when descending."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.config import Rules


def asc(column: str) -> Column:
    return F.col(column).asc_nulls_last()


def desc(column: str) -> Column:
    return F.col(column).desc_nulls_first()


def text(column: str, rules: Rules) -> Column:
    key = F.col(column)
    if rules.text_collation:
        key = F.collate(key, rules.text_collation)
    return key.asc_nulls_last()


def present(df: DataFrame, rules: Rules, *keys: Column) -> DataFrame:
    """Sort a finished result. Callers end the keys with an id, so no run of equal keys lands in one range partition."""
    return df.orderBy(*keys) if rules.ordered else df
