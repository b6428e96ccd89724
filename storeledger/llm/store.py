"""Tables between the steps of an operator, and what may be sent whole to every task."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 << 20
_WORD = 63  # bits used of each long, so that no sign gets in the way


def scratch(spark: SparkSession) -> str:
    """A new folder under `spark.checkpoint.dir`, or where that is unset under the warehouse, which executors share too."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work"
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def staged(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write `df` to the shared folder and read it back: what follows survives a lost executor and repeats nothing."""
    folder = scratch(df.sparkSession)
    df.write.option("compression", codec).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, root: str, name: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet").select(*columns)


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """Names for helper columns that no given column has."""
    prefix = "_"
    while any(name.lower().startswith(prefix) for name in taken):
        prefix += "_"
    return [prefix + name for name in wanted]


def small(df: DataFrame, size: Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """`df`, staged; marked for broadcast only where its measured size (`size` summed) is within `limit`.

    A larger table is left as it is, for a shuffled join.
    """
    held = staged(df)
    total = held.agg(F.sum(size.cast("long"))).first()[0] or 0
    return F.broadcast(held) if total <= limit else held


def filter_bits(keys: int) -> int:
    """Bits, as a power of two, of a filter for so many keys: 1,024 or more for each up to the largest filter, 8 MB."""
    return min(26, max(16, int(keys * 1024).bit_length()))


def key_filter(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """A Bloom filter of 2**bits bits for evenly spread 64-bit keys: those that miss it are not in `keys`.

    Its size is fixed: the driver gets at most 2**bits / 63 longs, and two for each key. Each key sets the bits its
    upper and its next `bits` bits name. A false hit costs a row that a later join drops.
    """
    parts = (
        keys.where(F.col(column).isNotNull())
        .select(F.explode(F.expr(f"array(shiftrightunsigned({column}, {64 - bits}), shiftrightunsigned(shiftleft({column}, {bits}), {64 - bits}))")).alias("slot"))
        .groupBy(F.expr(f"cast(slot div {_WORD} as int)").alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(slot % {_WORD} as int))")).alias("mask"))
    )
    got = parts.toArrow()
    out = np.zeros((1 << bits) // _WORD + 1, np.uint64)
    out[got["word"].to_numpy()] = got["mask"].to_numpy().view(np.uint64)
    return out


def maybe_in(bitmap: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    """Which of the keys may be among those the filter was made of."""

    def has(slot: np.ndarray) -> np.ndarray:
        return (bitmap[(slot // np.uint64(_WORD)).astype(np.int64)] >> slot % np.uint64(_WORD)) & np.uint64(1) != 0

    keys, shift = keys.astype(np.uint64), np.uint64(64 - bits)
    found = has(keys >> shift)
    near = np.flatnonzero(found)
    found[near] = has((keys[near] << np.uint64(bits)) >> shift)
    return found
