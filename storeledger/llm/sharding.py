"""Contiguous shards of nearly equal size in bytes, by prefix sums over ordered partitions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm.store import free_names, staged


def shard_by_bytes(items: DataFrame, order: list[str], size: str = "size", shards: int = 16) -> DataFrame:
    """`items` with `shard` (0 to shards - 1) and `slot` (place in the shard, from 0): contiguous in `order`, sizes near equal.

    The rows are dealt to ordered ranges, each range is summed, the sums of the ranges before it are its offset, and a row
    goes to the shard in whose equal share of all bytes its middle falls. A shard differs from its share by less than one
    row's size at either end. Only the columns given travel: pass keys and sizes, and join the payload by key when files
    are written.

    Repeated rows and ties in `order` are kept apart by their place in the input, so a run of equal keys can be cut like
    any other. Nulls come first in the order; a null size counts as 0. No rows give no rows; more shards than bytes leave
    some shards empty.
    """
    items = items.drop("shard", "slot")
    names = free_names(items.columns, "place", "part", "before", "row", "earlier", "rows", "total", "count", "middle", "first")
    place, part, before, row, earlier, rows, total, count, middle, first = names
    given = staged(items.withColumn(place, F.monotonically_increasing_id()))
    ranged = given.repartitionByRange(*order, place).sortWithinPartitions(*order, place).drop(place)
    ranged = ranged.withColumns({part: F.spark_partition_id().cast("long"), before: F.lit(0).cast("long"), row: F.lit(0).cast("long")})
    local = staged(ranged.mapInArrow(_Running(size, before, row), ranged.schema))

    # One row for each partition: its totals, and those of the partitions before it.
    held = F.coalesce(F.col(size), F.lit(0)).cast("long")
    sums = local.groupBy(part).agg(F.max(F.col(before) + held).alias(total), F.max(F.col(row) + 1).alias(count))
    ahead = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        part,
        F.coalesce(F.sum(total).over(ahead), F.lit(0)).alias(earlier),
        F.coalesce(F.sum(count).over(ahead), F.lit(0)).alias(rows),
        F.sum(total).over(Window.partitionBy()).alias(total),
    )
    twice_middle = (F.col(before) + F.col(earlier)) * 2 + held
    share = F.expr(f"cast(least({shards - 1}, (cast({middle} as decimal(30,0)) * {shards}) div greatest(2 * {total}, 1)) as int)")
    placed = (
        local.join(F.broadcast(starts), part)
        .withColumns({middle: twice_middle, row: F.col(row) + F.col(rows)})
        .withColumn("shard", share)
    )
    firsts = placed.groupBy("shard").agg(F.min(row).alias(first))
    return placed.join(F.broadcast(firsts), "shard").select(*items.columns, "shard", (F.col(row) - F.col(first)).alias("slot"))


class _Running:
    """Bytes and rows before each row of its partition."""

    def __init__(self, size: str, before: str, row: str) -> None:
        self.size, self.before, self.row = size, before, row

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = rows = 0
        for batch in batches:
            sizes = batch.column(self.size).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = total + np.cumsum(sizes)
            made = {self.before: pa.array(ends - sizes), self.row: pa.array(rows + np.arange(len(sizes)))}
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([made.get(n, batch.column(i)) for i, n in enumerate(names)], names)
            total, rows = total + int(sizes.sum()), rows + len(sizes)


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, UTF-8 bytes of the text plus 1 (null: 1), CRC-32 of these bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
