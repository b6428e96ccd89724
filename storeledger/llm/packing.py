"""Packing of tokenised documents into training sequences of fixed length."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.llm.store import free_names, staged
from storeledger.llm.text import slices
from storeledger.llm.tokens import Encoder

SEQUENCE = 2048
GROUP_PIECES = 8192
END_ID = 1
ENCODED_BYTES = 1 << 20  # of text encoded at a time

PIECES = "start long, length long, doc_tokens long, ids array<int>, ids_crc32 long"


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
    keys: tuple[str, ...] = ("doc_id",),
    keep_ids: bool = True,
) -> DataFrame:
    """The ids of each text and `end_id` after them, cut into pieces of at most `sequence` ids.

    One row for each piece: the `keys` of its document, start (ids of the document before it), length, doc_tokens (ids of
    the document), ids, ids_crc32 (unsigned CRC-32 of the ids as little-endian unsigned 32-bit numbers). With
    `keep_ids=False` ids is null, for a caller that wants places and checks only.

    `tokenizer` is a tokenizer file every executor can open. A null or empty text has the end id alone. Repeated rows are
    documents of their own. All pieces of a document but the last are full.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keys).schema)
    rows = docs.select(*[F.col(k).alias(f"key{i}") for i, k in enumerate(keys)], F.col("text").alias("text"))
    return rows.mapInArrow(_Pieces(tokenizer, sequence, end_id, keys, keep_ids), f"{schema}, {PIECES}")


class _Pieces:
    def __init__(self, tokenizer: str, sequence: int, end_id: int, keys: tuple[str, ...], keep_ids: bool) -> None:
        self.tokenizer, self.sequence, self.end_id, self.keys, self.keep_ids = tokenizer, sequence, end_id, keys, keep_ids

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(self.tokenizer)
        for batch in batches:
            for part in slices(batch, limit=ENCODED_BYTES):
                yield self._cut(part, encoder)

    def _cut(self, part: pa.RecordBatch, encoder: Encoder) -> pa.RecordBatch:
        flat, offsets = encoder.encode(part.column("text"))
        ids = [np.append(flat[a:b], np.uint32(self.end_id)) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        tokens = np.array([len(x) for x in ids], np.int64)
        counts = -(-tokens // self.sequence)
        row = np.repeat(np.arange(len(ids)), counts)
        start = (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)) * self.sequence
        pieces = [ids[r][s : s + self.sequence] for r, s in zip(row, start)]
        length = np.array([len(x) for x in pieces], np.int64)
        if self.keep_ids:
            flat = np.concatenate(pieces).astype(np.int32) if pieces else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), pa.array(flat))
        else:
            lists = pa.nulls(len(pieces), pa.list_(pa.int32()))
        keys = part.select([f"key{i}" for i in range(len(self.keys))]).take(pa.array(row)).columns
        crc = pa.array([zlib.crc32(x.tobytes()) for x in pieces], pa.int64())
        columns = [*keys, pa.array(start), pa.array(length), pa.array(tokens[row]), lists, crc]
        return pa.RecordBatch.from_arrays(columns, [*self.keys, "start", "length", "doc_tokens", "ids", "ids_crc32"])


def pack(pieces: DataFrame, length: str = "length", sequence: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """`pieces` with `sequence_id` and `offset`: each piece whole in one sequence, sequences of at most `sequence` ids.

    The pieces are dealt at random to groups of about `group_pieces`, however many there are, and each group is packed by
    first-fit decreasing on its own: pieces from long to short, each into the first sequence with room. A tournament tree
    over the room left finds that sequence in logarithmic time. A group is small enough for one task and large enough
    that short pieces fill the ends; its number and that of the sequence in it make the sequence_id.

    Only the columns given travel, so ids may ride along or be joined to the result by key. Lengths must lie between 0
    and `sequence`; a null length counts as 0. Rows that are equal in all columns are pieces of their own, since a row's
    group is drawn from its place in the staged input. No rows give no rows. A given sequence_id or offset is replaced.
    """
    pieces = pieces.drop("sequence_id", "offset")
    place, group = free_names(pieces.columns, "place", "group")
    held = staged(pieces.withColumn(place, F.monotonically_increasing_id()))
    groups = max(1, -(-held.count() // group_pieces))
    dealt = held.withColumn(group, F.pmod(F.xxhash64(place), F.lit(groups)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    packed = dealt.groupBy(group).applyInPandas(
        _packer(length, place, group, sequence), f"{fields}, sequence_id long, offset long"
    )
    return packed.drop(place, group)


def _packer(length: str, place: str, group: str, sequence: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def packed(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values([length, place], ascending=[False, True], kind="stable", na_position="last")
        bins, offsets = first_fit(pieces[length].fillna(0).to_numpy(np.int64), sequence)
        pieces["sequence_id"] = (pieces[group].to_numpy(np.int64) << 32) + bins
        pieces["offset"] = offsets
        return pieces

    return packed


def first_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each length in turn, the first bin that has room for it and the room used there before it.

    `tree[1]` is the largest room of all bins, `tree[n]` that of the bins below node n; the leaves are the bins.
    """
    if len(lengths) and (lengths.max() > capacity or lengths.min() < 0):
        raise ValueError(f"lengths must lie between 0 and {capacity}")
    leaves = 1 << max(0, (len(lengths) - 1).bit_length())
    tree = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, size in enumerate(lengths.tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - tree[node]
        tree[node] -= size
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return bins, offsets
