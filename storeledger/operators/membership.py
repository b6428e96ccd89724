"""Keys of a small batch against the keys of a large stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.sources.sinks import staged

BATCH_BYTES = 64 << 20  # keys that are sent to every task, measured


def known_keys(batch: DataFrame, column: str, stored: DataFrame, key: str = "id", folder: str | None = None) -> DataFrame:
    """`column`: the distinct values of `batch` that `stored` has as `key`. NULL is not looked for.

    The stored keys do not travel. The batch's distinct keys are written below `folder` (or `spark.checkpoint.dir`); their
    bounds go into the scan of the stored table, where they skip row groups, and what passes meets the keys themselves, sent
    to every task while they take up to BATCH_BYTES. Beyond that both sides are shuffled by key, and Spark's runtime Bloom
    filter keeps most stored keys from the shuffle (`spark.sql.optimizer.runtime.bloomFilter.*`; raise its
    creationSideThreshold above the batch's size). Either way the test is exact.
    """
    keys = staged(batch.filter(F.col(column).isNotNull()).select(column).distinct(), folder)
    text = keys.schema[column].dataType.typeName() == "string"
    size = F.sum(F.octet_length(column) + 16) if text else F.count("*") * 16
    low, high, total = keys.agg(F.min(column), F.max(column), size).first()
    if total is None or low is None:
        return keys
    near = stored.select(F.col(key).alias("stored_key")).filter(F.col("stored_key").between(F.lit(low), F.lit(high)))
    wanted = F.broadcast(keys) if total <= BATCH_BYTES else keys.filter(F.col(column).between(F.lit(low), F.lit(high)))
    met = near.join(wanted, F.col("stored_key") == F.col(column), "left_semi")
    return met.select(F.col("stored_key").alias(column)).distinct()


def batch_orphans(batch: DataFrame, column: str, stored: DataFrame, key: str = "id", folder: str | None = None) -> DataFrame:
    """`check_foreign_key` for a batch: its keys without a parent in `stored`, with the number of batch rows."""
    used = batch.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return used.join(known_keys(batch, column, stored, key, folder), column, "left_anti")


def batch_clashes(batch: DataFrame, column: str, stored: DataFrame, key: str | None = None, folder: str | None = None) -> DataFrame:
    """Values of a key or unique column that a batch may not bring: those it has twice and those `stored` has already.

    `column`, rows (of the batch), stored (whether the table has it); NULLs never clash.
    """
    counts = batch.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    known = known_keys(batch, column, stored, key or column, folder).withColumn("stored", F.lit(True))
    found = counts.join(known, column, "left").withColumn("stored", F.coalesce("stored", F.lit(False)))
    return found.filter((F.col("rows") > 1) | F.col("stored"))
