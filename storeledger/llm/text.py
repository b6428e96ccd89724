"""Words and shingles of Arrow text columns as flat numpy arrays, without a Python object per word.

A word is a maximal run of letters and digits, in lower case: ASCII letters and digits, and every character outside ASCII.
Null texts are empty. A batch is cut into slices of about `SLICE_BYTES` between texts, so memory does not follow the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[ord("0") : ord("9") + 1] = _WORD_BYTE[ord("a") : ord("z") + 1] = _WORD_BYTE[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACES = 1 << 12


def _powers(count: int) -> np.ndarray:
    out = np.full(count, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(_PLACES)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the SplitMix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    """`hashes[i]` is word i, found in text `doc[i]` at bytes `start[i]:end[i]` of the slice's UTF-8 data."""

    hashes: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    offsets: np.ndarray  # where each text begins in the slice, and the end of the last

    def first_words(self) -> np.ndarray:
        """Index of each text's first word, and the number of words."""
        return np.searchsorted(self.doc, np.arange(len(self.offsets)))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its values in them."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, wide, len(texts) + 1, texts.offset * wide().itemsize).astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of `batch` with about `limit` bytes of text; a longer text stands alone."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total, row = np.cumsum(lengths), 0
    while row < batch.num_rows:
        done = total[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(total, done + limit, "right")))
        yield batch.slice(row, end - row)
        row = end


def words(texts: pa.Array, lower: bool = True) -> Words:
    data, offsets = utf8(pc.utf8_lower(pc.fill_null(texts, "")) if lower else texts)
    return words_of(data, offsets)


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = _WORD_BYTE[data]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    begins = offsets[:-1][np.diff(offsets) > 0]
    before[begins] = False
    after[begins[1:] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    if not len(start):
        empty = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), empty, empty, empty, offsets)
    value = run_hashes(data[inside], np.cumsum(end - start) - (end - start), np.cumsum(end - start))
    doc = np.searchsorted(offsets, start, "right") - 1
    return Words(mixed(value + (end - start).astype(np.uint64)), doc, start, end, offsets)


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A polynomial hash of each run of bytes; the runs follow one another and cover the data."""
    place = np.arange(len(data), dtype=np.int32) - np.repeat(start.astype(np.int32), end - start)
    place &= _PLACES - 1
    return np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * _POWERS[place], start)


def windows(found: Words, picks: tuple[int, ...], salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """A hash of the words at positions i+p for p in `picks`, for every i whose window stays inside one text, and those i."""
    count = len(found.hashes) - picks[-1]
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    whole = np.flatnonzero(found.doc[picks[-1] :] == found.doc[:count])
    acc = np.full(len(whole), salt + 1, np.uint64) * _BASE
    for p in picks:
        acc = (acc ^ found.hashes[whole + p]) * np.uint64(0xD6E8FEB86659FD93)
        acc ^= acc >> np.uint64(32)
    return mixed(acc), whole


def shingles(found: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words and the text of each; a shorter text that has words is one shingle itself."""
    hashes, at = windows(found, tuple(range(size)))
    doc = found.doc[at]
    first = found.first_words()
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < size))
    if not len(short):
        return hashes, doc
    acc = np.diff(first)[short].astype(np.uint64)
    for place in range(size - 1):
        word = found.hashes[np.minimum(first[short] + place, len(found.hashes) - 1)]
        acc = np.where(place < np.diff(first)[short], mixed(acc ^ word), acc)
    hashes, doc = np.concatenate([hashes, acc]), np.concatenate([doc, short])
    order = np.argsort(doc, kind="stable")
    return hashes[order], doc[order]


def lists(values: np.ndarray, groups: np.ndarray, count: int) -> pa.ListArray:
    """One list for each of `count` groups; `groups` ascends along `values`."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(groups, np.arange(count + 1)), pa.int32()), pa.array(values))
