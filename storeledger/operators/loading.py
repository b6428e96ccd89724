"""Loading of rows that may break the declared constraints, and of rows whose keys are provisional."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.operators.integrity import row_rules
from storeledger.operators.maintain import assign_ids
from storeledger.sources.schema import ALL_TABLES, TableSpec
from storeledger.sources.sinks import shared_folder, staged
from storeledger.sources.tables import Tables

ACCEPTED, REASONS = "accepted", "reasons"


class Loaded(NamedTuple):
    """`accepted` reads the rows that keep all constraints, `rejected` has the others of each table with their reasons."""

    accepted: Tables
    rejected: dict[str, DataFrame]


def checked_load(tables: Tables, root: str | None = None, specs: Sequence[TableSpec] = ALL_TABLES) -> Loaded:
    """Write each table to `<root>/<table>` (a new shared folder by default), split into accepted and rejected rows.

    A rejected row lists every rule it breaks, as "column|constraint" with the constraints of `constraint_report`. All rows
    that share a primary key or a unique value are rejected, since none of them is the right one; NULLs never clash in a
    unique column. A row that refers to a missing parent has the reason "reference", one whose parents of that key are all
    rejected "parent rejected": so no accepted row is an orphan. Every given row is in exactly one of the two parts.

    This job acts when it is called. `specs` lists parents before children; each table is written once, in one folder for
    either part, and children see their parents' verdicts there. Keys are counted before they are joined, and only the
    offending ones meet the rows again. They are staged for that, below `<root>/_keys`: where they are few, the rows do not
    travel at all, and else the rows are on the side of the join where a hot key can be split.
    """
    spark = getattr(tables, specs[0].name).sparkSession
    root = root or shared_folder(spark)
    written: dict[str, DataFrame] = {}
    for spec in specs:
        folder = f"{root.rstrip('/')}/{spec.name}"
        tagged = tagged_rows(getattr(tables, spec.name), spec, written, f"{root.rstrip('/')}/_keys")
        whole = tagged.withColumn(ACCEPTED, F.size(REASONS) == 0)
        whole.write.mode("overwrite").partitionBy(ACCEPTED).parquet(folder)
        written[spec.name] = spark.read.schema(whole.schema).parquet(folder)
    accepted = {name: df.filter(F.col(ACCEPTED)).drop(ACCEPTED, REASONS) for name, df in written.items()}
    rejected = {name: df.filter(~F.col(ACCEPTED)).drop(ACCEPTED) for name, df in written.items()}
    return Loaded(Tables(**accepted), rejected)


def tagged_rows(df: DataFrame, spec: TableSpec, parents: dict[str, DataFrame], folder: str | None = None) -> DataFrame:
    """`df` with `reasons`, the rules each row breaks. `parents` are the tables it refers to, with the column `accepted`.

    Offending keys are written to new folders below `folder`.
    """
    if clash := {ACCEPTED, REASONS} & {c.lower() for c in df.columns}:
        raise ValueError(f"{spec.name} has a column {', '.join(sorted(clash))}")
    flags: dict[str, Column] = dict(row_rules(spec))
    out, marks = df, []
    keyed = [(spec.primary_key, "primary key"), *((c, "unique") for c in spec.unique)]
    for column, rule in keyed:
        repeated = df.groupBy(column).agg(F.count("*").alias("rows")).filter("rows > 1")
        bad = repeated.filter(F.col(column).isNotNull()).select(column, F.lit(rule).alias("verdict"))
        out, mark = _marked(out, column, staged(bad, folder), marks)
        flags[f"{column}|{rule}"] = F.col(mark).isNotNull()
        if rule == "primary key":
            flags[f"{column}|{rule}"] |= F.col(column).isNull()
    for reference in spec.references:
        column = reference.column
        known = parents[reference.parent].groupBy(F.col(_key_of(reference.parent)).alias(column)).agg(F.bool_or(ACCEPTED).alias("sound"))
        used = df.filter(F.col(column).isNotNull()).select(column).distinct().join(known, column, "left")
        verdict = F.when(F.col("sound").isNull(), "reference").when(~F.col("sound"), "parent rejected")
        bad = used.select(column, verdict.alias("verdict")).filter("verdict IS NOT NULL")
        out, mark = _marked(out, column, staged(bad, folder), marks)
        flags[f"{column}|reference"] = F.col(mark) == "reference"
        flags[f"{column}|parent rejected"] = F.col(mark) == "parent rejected"
    broken = F.array_compact(F.array(*[F.when(flag, F.lit(rule)) for rule, flag in flags.items()]))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], broken.alias(REASONS))


def _key_of(table: str) -> str:
    return next((s.primary_key for s in ALL_TABLES if s.name == table), "id")


def _marked(rows: DataFrame, column: str, bad: DataFrame, marks: list[str]) -> tuple[DataFrame, str]:
    """`rows` with the verdict on their value of `column`, in a column whose name is new, and that name."""
    mark = f"__verdict_{len(marks)}"
    marks.append(mark)
    key = f"{mark}_key"
    return rows.join(bad.select(F.col(column).alias(key), F.col("verdict").alias(mark)), F.col(column) == F.col(key), "left").drop(key), mark


def remap_ids(incoming: Tables, existing: Tables, specs: Sequence[TableSpec] = ALL_TABLES, folder: str | None = None) -> Tables:
    """`incoming` with new ids that continue after the largest ones of `existing`, and with its references rewritten to them.

    The keys of `incoming` are provisional: they tell which child belongs to which parent of the same batch, and may clash
    with those of `existing`. A reference to no parent of the batch becomes NULL, for the checks to report, since the old
    value may by now be another parent's id; if several parents share a provisional key, their children go to the first of the
    new ids. All other columns stay.

    This job acts when it is called: positions are written to a new folder below `folder` (see `assign_ids`), and all later
    steps read them there, so a task rerun after a lost executor gives the same ids. So are the pairs of old and new ids, one
    for each parent; children are on the preserved side of the join with these, where a hot parent is split.
    """
    numbered: dict[str, DataFrame] = {}
    for spec in specs:
        rows = getattr(incoming, spec.name)
        old = f"__given_{spec.primary_key}"
        kept = rows.withColumn(old, F.col(spec.primary_key))
        numbered[spec.name] = assign_ids(kept, getattr(existing, spec.name), spec.primary_key, folder)
    out = {}
    for spec in specs:
        rows, columns = numbered[spec.name], getattr(incoming, spec.name).columns
        for reference in spec.references:
            parent = next(s for s in specs if s.name == reference.parent)
            old = f"__given_{parent.primary_key}"
            ids = numbered[parent.name].groupBy(F.col(old).alias("__key")).agg(F.min(parent.primary_key).alias("__new"))
            rows = rows.join(staged(ids, folder), F.col(reference.column) == F.col("__key"), "left").withColumn(reference.column, F.col("__new")).drop("__key", "__new")
        out[spec.name] = rows.select(*columns)
    return Tables(**out)
