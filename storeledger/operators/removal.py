"""Deleting rows across all references at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.sources.schema import ALL_TABLES, TableSpec
from storeledger.sources.sinks import staged
from storeledger.sources.tables import Tables


class Deleted(NamedTuple):
    """`remaining` has what is left of each table; `blockers` (deleted_id, table_name, column_name, key, rows) what forbids the rest."""

    remaining: dict[str, DataFrame]
    blockers: DataFrame


def delete_rows(
    tables: Tables | Mapping[str, DataFrame],
    table: str,
    keys: DataFrame,
    specs: Sequence[TableSpec] = ALL_TABLES,
    folder: str | None = None,
) -> Deleted:
    """Delete the rows of `table` whose primary key is in `keys`, with all rows that references of kind "cascade" reach.

    A row is not deleted, nor anything its deletion would reach, if a row of a "restrict" reference refers to it or to a row
    that it would take along, even one that would go too: restriction comes first. The rest of `keys` is deleted. Keys that
    no row has do nothing. As a row may be reached from several of the keys, it goes if one of them may go. No row left
    refers to a row that went; a NULL reference refers to nothing.

    `specs` lists parents before children. Tables that references lead back to are not supported, as no such order
    exists. What travels down the references are keys, not rows, and children that nothing refers to are told by their
    reference alone. The keys to delete and the blockers are written below `folder`, or below `spark.checkpoint.dir`, when the
    job is called; the rows are then on the preserved side of plain anti joins with those files, where a hot key can be split.
    """
    frames = {s.name: tables[s.name] if isinstance(tables, Mapping) else getattr(tables, s.name) for s in specs}
    by_name = {s.name: s for s in specs}
    parents = {r.parent for s in specs for r in s.references}
    start = by_name[table]
    wanted = keys.select(F.col(start.primary_key).alias("key")).filter("key IS NOT NULL").distinct()
    present = frames[table].select(F.col(start.primary_key).alias("key"))
    reached = {table: wanted.join(present, "key", "left_semi").select(F.col("key").alias("deleted_id"), "key")}
    for spec in specs[[s.name for s in specs].index(table) + 1 :]:
        found = [
            frames[spec.name]
            .select(F.col(r.column).alias("parent_key"), F.col(spec.primary_key).alias("child_key"))
            .join(reached[r.parent].withColumnRenamed("key", "parent_key"), "parent_key")
            .select("deleted_id", F.col("child_key").alias("key"))
            for r in spec.references
            if r.on_delete == "cascade" and r.parent in reached and spec.name in parents
        ]
        if found:
            reached[spec.name] = reduce(DataFrame.union, found).distinct()

    blocking = []
    for spec in specs:
        for r in spec.references:
            if r.on_delete == "restrict" and r.parent in reached:
                used = frames[spec.name].groupBy(F.col(r.column).alias("key")).agg(F.count("*").alias("rows"))
                names = F.lit(spec.name).alias("table_name"), F.lit(r.column).alias("column_name")
                blocking.append(reached[r.parent].join(used, "key").select("deleted_id", *names, "key", "rows"))
    nothing = reached[table].limit(0).select(
        "deleted_id", F.lit("").alias("table_name"), F.lit("").alias("column_name"), "key", F.lit(0).cast("long").alias("rows")
    )
    blockers = staged(reduce(DataFrame.union, blocking) if blocking else nothing, folder)
    blocked = blockers.select("deleted_id").distinct()
    gone = {
        name: staged(df.join(blocked, "deleted_id", "left_anti").select("key").distinct(), folder) for name, df in reached.items()
    }

    remaining = dict(frames)
    for spec in specs:
        rows = frames[spec.name]
        if spec.name == table:
            rows = _without(rows, spec.primary_key, gone[table])
        for r in spec.references:
            if r.on_delete == "cascade" and r.parent in gone:
                rows = _without(rows, r.column, gone[r.parent])
        remaining[spec.name] = rows
    return Deleted(remaining, blockers)


def _without(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    return rows.join(keys.withColumnRenamed("key", column), column, "left_anti").select(*rows.columns)
