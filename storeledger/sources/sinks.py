"""Writing snapshots and exports."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


# One set of options for writers and readers, under which text comes back as it left: spaces, quotes (doubled inside
# quoted text), line breaks, and empty text apart from NULL.
CSV = {
    "mode": "FAILFAST",
    "header": "true",
    "enforceSchema": "false",
    "escape": '"',
    "quoteAll": "true",
    "multiLine": "true",
    "lineSep": "\n",
    "nullValue": "\\N",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Full refresh of a managed table (or an external one at `path`) and the DataFrame that reads it back.

    `bucket_by=(n, "order_id")` on both orders and lines lets later joins and per-order sums skip the shuffle. It also
    ties a bucket to one task, so leave it out where one key holds a large share of the rows.
    """
    if bucket_by:
        # The bucket of a row is its hash partition, so each task writes the one file of its bucket.
        count, key = bucket_by
        writer = df.repartition(count, key).write.bucketBy(count, key).sortBy(key)
    else:
        writer = _rebalanced(df, partition_by).write
    writer = writer.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def overwrite_partitions(df: DataFrame, name: str, partition_by: Sequence[str]) -> None:
    """Replace the folders of table `name` that `df` has rows for, and leave the others as they are.

    `df` has the table's columns in the table's order, partition columns last, and does not read the table.
    """
    conf, mode = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(mode)
    conf.set(mode, "dynamic")
    try:
        _rebalanced(df, partition_by).write.insertInto(name, overwrite=True)
    finally:
        conf.set(mode, before)


def drop_partition(spark: SparkSession, name: str, column: str, value: datetime.date | None) -> None:
    """Remove the folder of one date, or of NULL, from table `name`."""
    shown = "null" if value is None else f"DATE'{value.isoformat()}'"
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({column} = {shown})")


def export_result(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Write a result as a directory of part files, in parallel, replacing the previous export.

    CSV files are to be read with the same options (`CSV`), one task per file, so they should be many and moderate.
    """
    writer = _rebalanced(df, partition_by).write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def _rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Group rows by partition value before a partitioned write: few files per value, and AQE splits the large ones."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def shared_folder(spark: SparkSession, root: str | None = None) -> str:
    """A new folder, on storage that every executor sees, for files a job hands to itself."""
    root = root or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("name a folder shared by all executors, here or in spark.checkpoint.dir")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def staged(df: DataFrame, root: str | None = None) -> DataFrame:
    """Write `df` to shared storage and read it back, so that values tied to partition layout survive a lost executor.

    Columnar files rather than an RDD checkpoint: whoever reads one column afterwards does not read the others.
    """
    folder = shared_folder(df.sparkSession, root)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
