"""Passages of test items in training documents, found by spaced-seed hashes and verified word by word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.llm.store import filter_bits, free_names, key_filter, maybe_in, small, staged
from storeledger.llm.text import lists, slices, windows, words

# Word positions that each mask looks at; a changed word at any other position leaves the hash as it is. Together they hit
# every stretch of 13 words or more with a fifth of them changed at most, wherever the changes are: true of each placing in
# 13 to 25 words, and a longer stretch has a part of such a length.
MASKS = (
    (0, 1, 2, 4, 5, 7, 8),
    (0, 1, 3, 5, 6, 7, 8),
    (0, 1, 2, 4, 5, 8, 10),
    (0, 1, 2, 3, 7, 10, 11),
    (0, 2, 7, 8, 9, 11, 12),
    (0, 1, 3, 4, 5, 6, 12),
)
WIDEST = 13


def _short_masks(length: int) -> tuple[tuple[int, ...], ...]:
    """Masks that hit an item of so few words wherever a document holds it whole, a fifth changed inside at most."""
    if length < 5:
        return (tuple(range(length)),)
    if length < 10:
        return tuple(tuple(p for p in range(length) if p != left) for left in range(1, length - 1))
    return (0, 1, 3, 4, 5), (0, 1, 3, 6, 7), (0, 1, 4, 6, 8)


MIN_WORDS = 13
SIMILARITY = 0.8
MISMATCH = -3.0  # score of a differing word against 1 for an equal one, in `best_stretch`

HITS = "words array<long>, hash array<long>, pos array<int>"
FOUND = "doc_start int, item_start int, n_words int, n_same int, similarity double"


def find_overlaps(
    docs: DataFrame,
    items: DataFrame,
    masks: tuple[tuple[int, ...], ...] = MASKS,
    min_words: int = MIN_WORDS,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """Stretches that a document (doc_id, text) and a test item (item_id, text) share, one row for each.

    doc_id, text_a, text_b (fingerprint of the document's text), item_id, doc_start and item_start (first word of the
    stretch in each, from 0), n_words, n_same (words that agree), similarity (n_same / n_words). A stretch runs along one
    alignment, without insertions; it has at least `min_words` words, or the whole item where the item is shorter, and
    agrees in at least `similarity` of them. It begins and ends with equal words. All stretches of an alignment that no
    longer one of it contains are given; two of them may overlap.

    Every document row and every item row is looked at, equal rows each by itself; null ids are kept. Null and empty texts
    have no words. With the default masks none is missed, given a `min_words` of 13 and a `similarity` of 0.8 or more.
    Items of fewer than 13 words have masks of their own, which documents are only held against where there are such items.

    Hashes of all windows of the documents are held against a Bloom filter of the items' hashes, of bounded size, where they are
    made; what passes meets the items' hashes in a join. So the documents' windows never travel, and the join keeps the
    few that the filter lets through by accident from doing harm.
    """
    ranges = [(picks, WIDEST, None) for picks in masks]
    ranges += [(picks, n, n) for n in range(1, WIDEST) for picks in _short_masks(n)]
    tests = staged(
        items.select("item_id", "text")
        .withColumn("item", F.monotonically_increasing_id())
        .mapInArrow(_Hits(dict(enumerate(ranges)), ("item_id", "item"), None, 0), f"item_id {_type(items, 'item_id')}, item long, {HITS}")
    )
    lengths = {r.n for r in tests.select(F.least(F.size("words"), F.lit(WIDEST)).alias("n")).distinct().collect()}
    used = {salt: kept for salt, kept in enumerate(ranges) if kept[1] in lengths}
    seeds = tests.select("item", F.explode(F.arrays_zip("hash", "pos")).alias("seed")).select(
        F.col("seed.hash").alias("hash"), "item", F.col("seed.pos").alias("item_pos")
    )
    seeds = staged(seeds)
    bits = filter_bits(seeds.count())
    bitmap = key_filter(seeds, "hash", bits)

    given = docs.select("doc_id", "text").withColumns(
        {"doc": F.monotonically_increasing_id(), "text_a": F.xxhash64("text"), "text_b": F.xxhash64(F.lit("text"), "text")}
    )
    keys = ("doc_id", "doc", "text_a", "text_b")
    schema = f"doc_id {_type(docs, 'doc_id')}, doc long, text_a long, text_b long, {HITS}"
    hit = staged(given.mapInArrow(_Hits(used, keys, bitmap, bits), schema))

    # Equal words may recur in a document and in an item: one candidate for each alignment of the two.
    at = hit.select("doc", F.explode(F.arrays_zip("hash", "pos")).alias("seed"))
    aligned = (
        at.join(small(seeds, F.lit(24)), F.col("seed.hash") == F.col("hash"))
        .select("doc", "item", (F.col("seed.pos") - F.col("item_pos")).alias("shift"))
        .distinct()
    )
    item_words = tests.select("item", "item_id", F.col("words").alias("item_words"))
    pairs = (
        aligned.join(hit.select(*keys, "words"), "doc")
        .join(small(item_words, F.size("item_words") * 8 + 64), "item")
        .select("doc_id", "text_a", "text_b", "item_id", "shift", "words", "item_words")
    )
    out = f"doc_id {_type(docs, 'doc_id')}, text_a long, text_b long, item_id {_type(items, 'item_id')}, {FOUND}"
    return pairs.mapInArrow(_Stretches(min_words, similarity), out)


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """`docs` without the rows whose text shares a stretch with a test item (see `find_overlaps`); columns unchanged.

    Rows with null text stay. The verdict depends on the text alone, so equal texts go or stay together.
    """
    a, b = free_names(docs.columns, "text_a", "text_b")
    found = find_overlaps(docs, items, **options).select(F.col("text_a").alias(a), F.col("text_b").alias(b)).distinct()
    keyed = docs.withColumns({a: F.xxhash64("text"), b: F.xxhash64(F.lit("text"), "text")})
    return keyed.join(small(found, F.lit(16)), [a, b], "left_anti").select(*docs.columns)


class _Hits:
    """The rows with their words, and the hash and place of each masked window; rows without a window in the bitmap go.

    `masks` has, by salt, the places of a mask and the lengths of the items it is for: from, and to or None. Without a
    bitmap the rows are items, and only masks for their lengths count.
    """

    def __init__(self, masks, keys: tuple[str, ...], bitmap: np.ndarray | None, bits: int) -> None:
        self.masks, self.keys, self.bitmap, self.bits = masks, keys, bitmap, bits

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield self._hits(part)

    def _hits(self, part: pa.RecordBatch) -> pa.RecordBatch:
        found = words(part.column("text"))
        first = found.first_words()
        length = np.diff(first)
        seen = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for salt, (picks, low, high) in self.masks.items():
            hashes, at = windows(found, picks, salt)
            if self.bitmap is not None:
                near = maybe_in(self.bitmap, hashes, self.bits)
            else:
                own = length[found.doc[at]]
                near = (own >= low) & (own <= (high or own))
            seen.append((hashes[near], at[near]))
        hashes, at = (np.concatenate(x) for x in zip(*seen))
        doc = found.doc[at]
        order = np.argsort(doc, kind="stable")
        hashes, at, doc = hashes[order], at[order], doc[order]
        rows = np.unique(doc) if self.bitmap is not None else np.arange(part.num_rows)
        begin, end = first[rows], first[rows + 1]
        picked = np.repeat(begin - (np.cumsum(end - begin) - (end - begin)), end - begin) + np.arange((end - begin).sum())
        group = np.searchsorted(rows, doc)
        columns = [
            *part.select(list(self.keys)).take(pa.array(rows)).columns,
            lists(found.hashes[picked].view(np.int64), np.repeat(np.arange(len(rows)), end - begin), len(rows)),
            lists(hashes.view(np.int64), group, len(rows)),
            lists((at - first[doc]).astype(np.int32), group, len(rows)),
        ]
        return pa.RecordBatch.from_arrays(columns, [*self.keys, "words", "hash", "pos"])


class _Stretches:
    def __init__(self, min_words: int, similarity: float) -> None:
        self.min_words, self.similarity = min_words, similarity

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("words", "item_words", "shift")]
            row, found = [], []
            for i, (doc, item, shift) in enumerate(zip(*columns)):
                least = min(self.min_words, len(item.values))
                for stretch in stretches(doc.values.to_numpy(), item.values.to_numpy(), shift.as_py(), least, self.similarity):
                    row.append(i)
                    found.append(stretch)
            kept = batch.select(["doc_id", "text_a", "text_b", "item_id"]).take(pa.array(row, pa.int64()))
            types = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64())
            made = [pa.array([f[k] for f in found], kind) for k, kind in enumerate(types)]
            names = [*kept.schema.names, "doc_start", "item_start", "n_words", "n_same", "similarity"]
            yield pa.RecordBatch.from_arrays([*kept.columns, *made], names)


def stretches(doc: np.ndarray, item: np.ndarray, shift: int, least: int, similarity: float) -> list[tuple[int, int, int, int, float]]:
    """All longest runs of item words j against document words j + shift that begin and end equal, have `least` words or
    more and agree in `similarity` of them: places, length, equal words and their share.

    A run agrees enough if the sum of same - similarity is not lower at its end than at its start. So the furthest end for a
    start is the last one where the highest sum from there on is not below the sum at the start.
    """
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    if high - low < least:
        return []
    same = doc[low + shift : high + shift] == item[low:high]
    starts = np.flatnonzero(same)
    if not len(starts):
        return []
    equal = np.concatenate([[0], np.cumsum(same)])
    total = equal - similarity * np.arange(len(equal))
    onward = np.maximum.accumulate(total[starts + 1][::-1])  # of the ends, from the last to each; an end follows an equal word
    ends = starts[::-1][np.searchsorted(onward, total[starts] - 1e-9)] + 1
    longest = np.concatenate([[True], ends[1:] > np.maximum.accumulate(ends)[:-1]]) & (ends - starts >= least)
    return [
        (low + shift + a, low + a, b - a, int(equal[b] - equal[a]), float((equal[b] - equal[a]) / (b - a)))
        for a, b in zip(starts[longest].tolist(), ends[longest].tolist())
    ]


def best_stretch(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int, int, float] | None:
    """The best-scoring run of item words j against document words j + shift: places, length, equal words and their share."""
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    if low >= high:
        return None
    same = doc[low + shift : high + shift] == item[low:high]
    total = np.concatenate([[0.0], np.cumsum(np.where(same, 1.0, MISMATCH))])
    lowest = np.minimum.accumulate(total)
    end = int(np.argmax(total - lowest))
    if total[end] <= lowest[end]:
        return None
    start = int(np.flatnonzero(total[: end + 1] == lowest[end])[-1])
    equal = int(same[start:end].sum())
    return low + shift + start, low + start, end - start, equal, equal / (end - start)
