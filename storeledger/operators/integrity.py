"""Constraint checks. Parquet tables do not enforce keys, references or value rules, so each is a query that lists or
counts what breaks it. NULL passes every rule except not-null, as in SQL."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from storeledger.functions.text import canonical, redecoded, repaired
from storeledger.sources.schema import ALL_TABLES, Minimum, TableSpec
from storeledger.sources.tables import Tables


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, violations: all columns counted in one pass."""
    return _counted(df, {name: F.col(name).isNull() for name in columns}).withColumnRenamed("rule", "column_name")


def check_primary_key(df: DataFrame, *columns: str) -> DataFrame:
    """Key values that occur more than once, or that are NULL in part, with the number of rows."""
    incomplete = reduce(Column.__or__, [F.col(c).isNull() for c in columns])
    return df.groupBy(*columns).agg(F.count("*").alias("rows")).filter((F.col("rows") > 1) | incomplete)


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs never clash."""
    return check_primary_key(df.filter(F.col(column).isNotNull()), column)


def check_foreign_key(child: DataFrame, column: str, parent: DataFrame, key: str = "id") -> DataFrame:
    """Child keys without a parent, with the number of child rows. Counting per key comes first, so a hot key joins as
    one row."""
    used = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return used.join(parent.select(F.col(key).alias(column)), column, "left_anti")


def _below(minimum: Minimum) -> Column:
    value = F.col(minimum.column)
    return value < minimum.bound if minimum.inclusive else value <= minimum.bound


def check_range(df: DataFrame, minimum: Minimum) -> DataFrame:
    """Rows under the minimum."""
    return df.filter(_below(minimum))


def check_domain(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Values outside the domain, with the number of rows."""
    return df.filter(~F.col(column).isin(*domain)).groupBy(column).agg(F.count("*").alias("rows"))


def check_length(df: DataFrame, column: str, max_length: int) -> DataFrame:
    """Rows whose text has more than `max_length` characters."""
    return df.filter(F.char_length(column) > max_length)


def check_temporal_order(df: DataFrame, earlier: str, later: str) -> DataFrame:
    """Rows where `later` comes before `earlier`: rules across two joined tables, which no column constraint can hold."""
    return df.filter(F.col(later) < F.col(earlier))


def check_encoding(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Values outside the domain with the domain value they spell in another Unicode form, NULL when none.

    The comparison under collation runs on the few distinct values, not on every row.
    """
    return check_domain(df, column, domain).withColumn("canonical", canonical(F.col(column), domain))


def check_misdecoded(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column_name, value, repaired, rows: text that was UTF-8 and read as Latin-1 or code page 1252, and what it was.

    All text columns, or those named, in one pass; the test runs on the distinct values.
    """
    names = columns if columns is not None else [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    pairs = [F.struct(F.lit(name).alias("column_name"), F.col(f"`{name}`").alias("value")) for name in names]
    none = F.array().cast("array<struct<column_name:string,value:string>>")
    values = df.select(F.explode(F.array(*pairs) if pairs else none).alias("pair")).select("pair.*")
    counts = values.filter(F.col("value").rlike("[^\\x00-\\x7F]")).groupBy("column_name", "value").agg(F.count("*").alias("rows"))
    found = counts.withColumn("repaired", F.when(redecoded(F.col("value")).isNotNull(), repaired(F.col("value"))))
    return found.filter(F.col("repaired").isNotNull()).select("column_name", "value", "repaired", "rows")


def _counted(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rule, violations: every row rule of a table in one scan."""
    counts = df.agg(*[F.count_if(broken).alias(rule) for rule, broken in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")


def with_status_domain(statuses: Sequence[str]) -> list[TableSpec]:
    """The declared tables for a shop whose orders have other statuses."""
    return [replace(s, domains={"status": tuple(statuses)}) if s.name == "orders" else s for s in ALL_TABLES]


def row_rules(spec: TableSpec) -> dict[str, Column]:
    """The declared rules that a row breaks by itself, as "column|constraint"."""
    rules = {f"{field.name}|not null": F.col(field.name).isNull() for field in spec.schema if not field.nullable}
    rules |= {f"{m.column}|minimum": _below(m) for m in spec.minimums}
    rules |= {f"{column}|domain": ~F.col(column).isin(*domain) for column, domain in spec.domains.items()}
    rules |= {f"{column}|length": F.char_length(column) > size for column, size in spec.max_lengths.items()}
    return rules


def _key_rule(rule: str, broken: DataFrame) -> DataFrame:
    return broken.agg(F.count("*").alias("violations")).select(F.lit(rule).alias("rule"), "violations")


def constraint_report(tables: Tables, specs: Sequence[TableSpec] = ALL_TABLES) -> DataFrame:
    """table_name, column_name, constraint, violations: all declared constraints. Row rules count rows, key rules count
    offending keys."""
    parts = []
    for spec in specs:
        df = getattr(tables, spec.name)
        counts = [_counted(df, row_rules(spec))]
        # Key rules read no price, and a price may take a join to find.
        keyed = tables.unpriced_lines if spec.name == "order_lines" else df
        counts.append(_key_rule(f"{spec.primary_key}|primary key", check_primary_key(keyed, spec.primary_key)))
        counts += [_key_rule(f"{column}|unique", check_unique(keyed, column)) for column in spec.unique]
        counts += [
            _key_rule(f"{r.column}|reference", check_foreign_key(keyed, r.column, getattr(tables, r.parent)))
            for r in spec.references
        ]
        parts += [c.select(F.lit(spec.name).alias("table_name"), "rule", "violations") for c in counts]
    report = reduce(DataFrame.unionByName, parts)
    return report.select(
        "table_name",
        F.split_part("rule", F.lit("|"), F.lit(1)).alias("column_name"),
        F.split_part("rule", F.lit("|"), F.lit(2)).alias("constraint"),
        "violations",
    )
