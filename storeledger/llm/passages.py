"""Passages that repeat, word changes included, across documents: shared seeds, chained in order, aligned."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.llm.store import filter_bits, key_filter, maybe_in, staged
from storeledger.llm.text import Words, lists, slices, windows, words

MASKS = ((0, 1, 2, 5, 6, 7), (0, 1, 3, 5, 6, 8), (0, 2, 3, 5, 7, 8))  # words of a seed; every fifth word may differ
EVERY = 10  # of the seeds of each mask those whose hash this divides are used, whatever stands around them
VARIED = 4  # words of a seed's stretch that must differ from the word before
SEED = 6  # what a seed is worth in a chain
CONTEXT = 24  # words on either side by which the holders of a seed are ordered
ALIKE = 14  # of these 48 that must agree for two neighbours in this order to be aligned
MIN_WORDS = 50
SIMILARITY = 0.8
GAP = 0.1  # cost of each word between seeds, on either side
CHANGE = -1.0  # score of a differing word against 1 for an equal one, beyond the ends of a chain
REACH = 64  # words looked at beyond either end of a chain
BLOCK = 16  # words that a passage explains together, if it has one of them

RUNS = "array<struct<xs: array<int>, ys: array<int>>>"
SPANS = "doc long, other long, start int, end int, other_start int, other_end int, n_words int, n_same int, similarity double"
NEAR = "doc long, hash long, pos int, after binary, before binary"


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """Passages of at least `min_words` words that a document shares with another, one row for each, from either side.

    doc_id, start and end (words, end not included), other_id, other_start, other_end, n_words (words of the alignment),
    n_same (words that agree), similarity (n_same / n_words, at least `similarity`). A passage may have words changed,
    added or missing. Words are runs of letters and digits, in lower case; one that equals the word before it does not count
    towards `min_words`, so that documents which say one word over and over share no passage by that.

    Documents that have a passage get a row for it; not every pair of them does. Where one says a few words over and over, a
    passage there is left out if its words are, on both sides, in its neighbours of the same pair. First the document of
    the smallest fingerprint that holds a seed stands for all, and the others are held against it if two seeds agree. Then
    the seeds outside the passages found are put in order of the words after them (and, once more, before them), and each is
    held against its neighbour: those that agree longest stand together, however many documents hold pieces of a passage.
    So pairs grow with the seeds and never with their square. Alignments go at most 64 words beyond the outermost seeds.

    Equal documents are passages from end to end, if long enough. What repeats within one document only is not reported.
    Null and empty texts have no words; null ids are kept as they are. Rows equal in id and text are one document, known
    by a 64-bit fingerprint of both, so results do not depend on how files are cut.
    """
    given = docs.select("doc_id", "text").withColumn("doc", F.xxhash64("doc_id", "text"))
    texts = given.select("doc", "text")

    # Seeds of two documents or more, and the first of these documents.
    held = texts.mapInArrow(_Seeds(), "hash long, doc long")
    ends = held.groupBy("hash").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
    shared = staged(ends.where("first_doc <> last_doc").select("hash", "first_doc"))
    bits = filter_bits(shared.count())
    near = staged(texts.mapInArrow(_Near(key_filter(shared, "hash", bits), bits), NEAR))

    at = near.select("doc", "hash", "pos")
    firsts = at.join(shared, (at["hash"] == shared["hash"]) & (at["doc"] == shared["first_doc"]))
    firsts = firsts.groupBy(shared["hash"], shared["first_doc"]).agg(F.min("pos").alias("y"))
    matches = at.join(firsts, "hash").where("doc <> first_doc")
    matches = matches.select("doc", F.col("first_doc").alias("other"), F.col("pos").alias("x"), "y")
    spans = _spans(given, _chains(matches, 2), min_words, similarity)

    # What these do not explain, among the nearest holders of each seed.
    low, high = F.floor(F.col("start") / BLOCK), F.floor((F.col("end") - 1) / BLOCK)
    touched = spans.unionByName(_turned(spans)).select("doc", F.explode(F.sequence(low, high)).alias("block"))
    explained = touched.distinct()
    loose = near.withColumn("block", F.floor(F.col("pos") / BLOCK)).join(explained, ["doc", "block"], "left_anti")
    loose = staged(loose.select("doc", "hash", "pos", "after", "before"))
    neighbours = _neighbours(loose, "after", "before").union(_neighbours(loose, "before", "after"))
    spans = spans.union(_spans(given, _chains(neighbours, 1), min_words, similarity))
    found = spans.unionByName(_turned(spans))
    return found.select("doc_id", "start", "end", "other_id", "other_start", "other_end", "n_words", "n_same", "similarity")


def _turned(spans: DataFrame) -> DataFrame:
    """The spans seen from the other document."""
    sides = {"doc": "other", "doc_id": "other_id", "start": "other_start", "end": "other_end"}
    names = {**sides, **{b: a for a, b in sides.items()}}
    return spans.select([F.col(c).alias(names.get(c, c)) for c in spans.columns])


def _chains(matches: DataFrame, least: int) -> DataFrame:
    """Chains of the matches (doc, other, x, y) of each pair that has at least `least` of them, one row for each pair."""
    pairs = matches.groupBy("doc", "other").agg(F.collect_set(F.struct("x", "y")).alias("matches"))
    pairs = pairs.where(F.size("matches") >= least)
    return staged(pairs.mapInArrow(_Chained(least), f"doc long, other long, runs {RUNS}"))


def _neighbours(loose: DataFrame, first: str, second: str) -> DataFrame:
    """Matches of each seed's occurrence with the one before it in order of the words around it, of another document.

    Occurrences are sorted over all tasks, so one seed may fill many. The occurrence that begins a task's range has no
    neighbour in this order.
    """
    order = ("hash", first, second, "doc", "pos")
    return loose.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_adjacent, "doc long, other long, x int, y int")


def _spans(given: DataFrame, chains: DataFrame, min_words: int, similarity: float) -> DataFrame:
    """Passages around the chains, from the words of both documents."""
    id_type = given.schema["doc_id"].dataType.simpleString()
    ends = staged(chains.select("doc").union(chains.select("other")).distinct())
    bits = filter_bits(ends.count())
    # Fingerprints are spread evenly, as the filter asks.
    found = given.mapInArrow(_Words(key_filter(ends, "doc", bits), bits), f"doc_id {id_type}, doc long, words array<int>")
    held = staged(found.groupBy("doc").agg(F.first("doc_id").alias("doc_id"), F.first("words").alias("words")))
    mine, theirs = held.toDF("doc", "doc_id", "mine"), held.toDF("other", "other_id", "theirs")
    sides = _around(_around(chains.join(mine, "doc"), "xs", "mine").join(theirs, "other"), "ys", "theirs")
    return staged(sides.mapInArrow(_Aligned(min_words, similarity), f"doc_id {id_type}, other_id {id_type}, {SPANS}"))


def _around(rows: DataFrame, at: str, text: str) -> DataFrame:
    """Replace a document's words by those within REACH of each chain, and the place of the first of them."""
    low = f"greatest(element_at(run.{at}, 1) - {REACH}, 0)"
    held = f"slice({text}, {low} + 1, element_at(run.{at}, -1) + {1 + REACH} - {low})"
    return rows.withColumn(text, F.expr(f"transform(runs, run -> named_struct('low', {low}, 'words', {held}))"))


def seeds(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the seeds used and the indices of their first words. Runs of one word over and over have none."""
    hashes, at = [], []
    fresh = np.append(0, np.cumsum(found.hashes[1:] != found.hashes[:-1]))
    for salt, mask in enumerate(MASKS):
        values, place = windows(found, mask, salt)
        varied = fresh[place + mask[-1]] - fresh[place] >= VARIED
        used = np.flatnonzero((values % np.uint64(EVERY) == 0) & varied)
        hashes.append(values[used])
        at.append(place[used])
    return np.concatenate(hashes), np.concatenate(at)


class _Seeds:
    """Each seed of a document once."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = words(part.column("text"))
                hashes, at = seeds(found)
                doc = part.column("doc").to_numpy()[found.doc[at]]
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(doc)], ["hash", "doc"])


def told_apart(row: np.ndarray, hashes: np.ndarray, place: np.ndarray, around: list[np.ndarray]) -> np.ndarray:
    """Indices of the seeds that stand for all: a stretch that says a few words over and over is not held at every place.

    A seed with the same words around it as the last one of its hash, at most CONTEXT words before, continues a run. What lies
    between the first and the last of a run is one period over and over, so its places have the same neighbours in any order
    of the words around, and align alike wherever the stretch goes on for REACH words on either side. Of those two
    in CONTEXT words are kept, which lets seeds of a stretch still chain in either order; none that is left out is
    2 * CONTEXT words or more from its kept ones, so passages of MIN_WORDS around these cover it.
    """
    order = np.lexsort((place, hashes, row))
    at, count = place[order], np.arange(len(order))
    runs_on = (row[order][1:] == row[order][:-1]) & (hashes[order][1:] == hashes[order][:-1]) & (np.diff(at) <= CONTEXT)
    again = np.flatnonzero(runs_on)
    for side in around:
        again = again[(side[order[again]] == side[order[again + 1]]).all(1)]
    begins = np.ones(len(order), bool)
    begins[again + 1] = False
    run = np.cumsum(begins) - 1
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(order))[: len(first)] - 1
    past, ahead = at - at[first[run]], at[last[run]] - at
    # Beyond a run's ends its stretch goes on for CONTEXT words.
    kept = (past <= REACH - CONTEXT) | (ahead <= REACH - CONTEXT)
    part = past // CONTEXT
    kept |= (count < 2) | (part != np.append(part[:2], part[:-2])[: len(part)])
    return np.sort(order[kept])


class _Near:
    """The seeds that may be in another document too, one row for each that the words around it, a byte for each, tell apart."""

    def __init__(self, bitmap: np.ndarray, bits: int) -> None:
        self.bitmap, self.bits = bitmap, bits

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = words(part.column("text"))
                hashes, at = seeds(found)
                kept = maybe_in(self.bitmap, hashes, self.bits)
                hashes, at = hashes[kept], at[kept]
                row = found.doc[at]
                place = (at - found.first_words()[row]).astype(np.int32)
                marks = np.maximum(found.hashes >> np.uint64(56), 1).astype(np.uint8)
                sides = []
                for step in (1, -1):
                    around = at[:, None] + step * np.arange(1, CONTEXT + 1)
                    inside = np.clip(around, 0, max(len(marks) - 1, 0))
                    sides.append(np.where((inside == around) & (found.doc[inside] == row[:, None]), marks[inside], 0).astype(np.uint8))
                kept = told_apart(row, hashes, place, sides)
                columns = [pa.array(part.column("doc").to_numpy()[row[kept]]), pa.array(hashes[kept].view(np.int64)), pa.array(place[kept])]
                for held in sides:
                    offsets = np.arange(len(kept) + 1, dtype=np.int32) * CONTEXT
                    columns.append(pa.Array.from_buffers(pa.binary(), len(kept), [None, pa.py_buffer(offsets), pa.py_buffer(held[kept].tobytes())]))
                yield pa.RecordBatch.from_arrays(columns, ["doc", "hash", "pos", "after", "before"])


def _adjacent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    carried = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(name).to_numpy() for name in ("doc", "hash", "pos")]
        for name in ("after", "before"):
            joined = b"".join(batch.column(name).to_pylist())
            rows.append(np.frombuffer(joined, np.uint8).reshape(-1, CONTEXT))
        old = 0 if carried is None else len(carried[0])
        if old:
            rows = [np.concatenate(pair) for pair in zip(carried, rows)]
        doc, hashes, pos, after, before = rows
        begins = np.append(True, (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1]))
        other = np.maximum.accumulate(np.where(begins, np.arange(len(doc)), 0)) - 1  # the row before those of this document
        row = np.flatnonzero((np.arange(len(doc)) >= old) & (other >= 0) & (hashes[other] == hashes))
        other, last = other[row], other[-1]
        alike = sum(((side[row] == side[other]) & (side[row] > 0)).sum(1) for side in (after, before)) if len(row) else np.zeros(0)
        row, other = row[alike >= ALIKE], other[alike >= ALIKE]
        turned = doc[row] < doc[other]
        row, other = np.where(turned, other, row), np.where(turned, row, other)
        columns = [pa.array(doc[row]), pa.array(doc[other]), pa.array(pos[row]), pa.array(pos[other])]
        carried = [side[[max(last, 0), len(doc) - 1]] for side in rows]
        yield pa.RecordBatch.from_arrays(columns, ["doc", "other", "x", "y"])


class _Words:
    """Hashes of the words of the documents whose fingerprint may be in the bitmap."""

    def __init__(self, bitmap: np.ndarray, bits: int) -> None:
        self.bitmap, self.bits = bitmap, bits

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = maybe_in(self.bitmap, batch.column("doc").to_numpy().view(np.uint64), self.bits)
            for part in slices(batch.filter(pa.array(wanted))):
                found = words(part.column("text"))
                short = (found.hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)
                columns = [*part.select(["doc_id", "doc"]).columns, lists(short, found.doc, part.num_rows)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "doc", "words"])


def chains(x: np.ndarray, y: np.ndarray, seed: int = SEED, gap: float = GAP, least: int = 2) -> list[tuple[list[int], list[int]]]:
    """Runs of at least `least` matches that ascend in both texts, best first; every match is in one run at most.

    The best run that ends in match j is worth `seed`, plus the best of a match i before it in both texts, less `gap` for
    each word from i to j in either text. Matches are taken by x, and a Fenwick tree over y keeps the greatest value of
    f(i) + gap * (x(i) + y(i)) for all smaller y, so each takes logarithmic time.
    """
    order = np.lexsort((-y, x))  # of one x the larger y first, so that matches of one x do not chain
    x, y = x[order].tolist(), y[order].tolist()
    rank = {value: i + 1 for i, value in enumerate(sorted(set(y)))}
    tree = [(-np.inf, -1)] * (len(rank) + 1)
    score, before = [0.0] * len(x), [-1] * len(x)
    for j in range(len(x)):
        best, at = (-np.inf, -1), rank[y[j]] - 1
        while at:
            best = max(best, tree[at])
            at &= at - 1
        offset = gap * (x[j] + y[j])
        gained = best[0] - offset
        score[j], before[j] = (seed + gained, best[1]) if gained > 0 else (float(seed), -1)
        value, at = (score[j] + offset, j), rank[y[j]]
        while at <= len(rank):
            tree[at] = max(tree[at], value)
            at += at & -at
    used = [False] * len(x)
    out = []
    for end in sorted(range(len(x)), key=lambda i: -score[i]):
        run, at = [], end
        while at >= 0 and not used[at]:
            used[at] = True
            run.append(at)
            at = before[at]
        if len(run) >= least:
            out.append(([x[i] for i in reversed(run)], [y[i] for i in reversed(run)]))
    return out


class _Chained:
    def __init__(self, least: int) -> None:
        self.least = least

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, found = [0], []
            matches = batch.column("matches")
            bounds = matches.offsets.to_numpy() - matches.offsets[0].as_py()
            xs, ys = (side.to_numpy() for side in matches.flatten().flatten())
            for i in range(batch.num_rows):
                found += chains(xs[bounds[i] : bounds[i + 1]], ys[bounds[i] : bounds[i + 1]], least=self.least)
                ends.append(len(found))
            sides = [pa.array([chain[side] for chain in found], pa.list_(pa.int32())) for side in (0, 1)]
            runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(sides, ["xs", "ys"]))
            made = pa.RecordBatch.from_arrays([*batch.select(["doc", "other"]).columns, runs], ["doc", "other", "runs"])
            yield made.filter(pa.array(np.diff(ends) > 0))


def align(a: np.ndarray, b: np.ndarray, xs: np.ndarray, ys: np.ndarray, similarity: float = SIMILARITY) -> tuple[int, int, int, int, int, int]:
    """Spans of `a` and `b` around a chain, the words of their alignment, and those that agree.

    The words at the chain's places are paired off, and those beyond its ends as long as that gains. Between two places,
    of texts of unequal length there, the surplus words of the longer stand together where most others agree. Of this
    alignment the longest stretch is taken in which `similarity` of the words agree; it begins and ends with such words.
    """
    i, j = int(xs[0]), int(ys[0])
    left = _onward(a[:i][::-1], b[:j][::-1])
    i, j = i - left, j - left
    at_a, at_b, same = [], [], []

    def paired(count: int) -> None:
        nonlocal i, j
        at_a.append(np.arange(i, i + count))
        at_b.append(np.arange(j, j + count))
        same.append(a[i : i + count] == b[j : j + count])
        i, j = i + count, j + count

    for x, y in zip(xs.tolist(), ys.tolist()):
        surplus = (y - j) - (x - i)
        if not surplus:
            paired(x - i)
            continue
        count = min(x - i, y - j)
        more_a, more_b = max(-surplus, 0), max(surplus, 0)
        before = np.append(0, np.cumsum(a[i : i + count] == b[j : j + count]))
        after = np.append(0, np.cumsum(a[i + more_a : i + more_a + count] == b[j + more_b : j + more_b + count]))
        paired(int(np.argmax(before + after[-1] - after)))
        at_a.append(np.arange(i, i + abs(surplus)) if more_a else np.full(more_b, i))
        at_b.append(np.arange(j, j + abs(surplus)) if more_b else np.full(more_a, j))
        same.append(np.zeros(abs(surplus), bool))
        i, j = i + more_a, j + more_b
        paired(x - i)
    paired(_onward(a[i:], b[j:]))
    at_a, at_b, same = np.concatenate(at_a), np.concatenate(at_b), np.concatenate(same)
    low, high = longest(same, similarity)
    return int(at_a[low]), int(at_a[high]) + 1, int(at_b[low]), int(at_b[high]) + 1, high - low + 1, int(same[low : high + 1].sum())


def longest(same: np.ndarray, similarity: float) -> tuple[int, int]:
    """First and last place of the longest stretch with a mean of `similarity` or more that begins and ends true."""
    if not same.any():
        return 0, 0
    total = np.append(0.0, np.cumsum(same - similarity))
    later = np.maximum.accumulate(total[::-1])[::-1]
    # For each start the last end whose total is not below the start's.
    end = len(total) - np.searchsorted(later[::-1], total - 1e-9, "left") - 1
    start = int(np.argmax(end - np.arange(len(total))))
    hit = start + np.flatnonzero(same[start : end[start]])
    return int(hit[0]), int(hit[-1])


def _onward(a: np.ndarray, b: np.ndarray) -> int:
    """How many words from the start on pair off to the greatest gain."""
    count = min(len(a), len(b))
    if not count:
        return 0
    gain = np.cumsum(np.where(a[:count] == b[:count], 1.0, CHANGE))
    end = int(np.argmax(gain))
    return end + 1 if gain[end] > 0 else 0


def varied(words: np.ndarray) -> int:
    """Words that are not equal to the one before."""
    return len(words) - int((words[1:] == words[:-1]).sum())


def fewest(start: list[int], end: list[int]) -> set[int]:
    """The fewest of these spans that cover every place any of them covers."""
    order = sorted(range(len(start)), key=lambda i: (start[i], -end[i]))
    kept, reach, at = set(), 0, 0
    while at < len(order):
        reach, best = max(reach, start[order[at]]), -1
        while at < len(order) and start[order[at]] <= reach:
            if end[order[at]] > (reach if best < 0 else end[best]):
                best = order[at]
            at += 1
        if best >= 0:
            kept.add(best)
            reach = end[best]
    return kept


def without_runs(passages: list[tuple], at: list[tuple[int, int]]) -> list[tuple]:
    """Passages of one pair, of a run only those needed to cover what all of the run cover on both sides.

    `at` is where the chain of each begins in both texts. A run holds one place of a text against places of the other that
    follow each other within CONTEXT words, as in a stretch that says a few words over and over.
    """
    kept = range(len(passages))
    for moving, fixed in ((0, 1), (1, 0)):
        order, runs = sorted(kept, key=lambda i: (at[i][fixed], at[i][moving])), []
        for i in order:
            if runs and at[i][fixed] == at[runs[-1][-1]][fixed] and at[i][moving] - at[runs[-1][-1]][moving] <= CONTEXT:
                runs[-1].append(i)
            else:
                runs.append([i])
        kept = set()
        for run in runs:
            sides = list(zip(*(passages[i] for i in run)))
            kept |= {run[k] for k in fewest(sides[0], sides[1]) | fewest(sides[2], sides[3])}
    return [passages[i] for i in sorted(kept)]


class _Aligned:
    def __init__(self, min_words: int, similarity: float) -> None:
        self.min_words, self.similarity = min_words, similarity

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, out = [], []
            for i, (mine, theirs, runs) in enumerate(zip(*(batch.column(name) for name in ("mine", "theirs", "runs")))):
                passages, at = [], []
                for near, far, run in zip(mine, theirs, runs):
                    low, other_low = near["low"].as_py(), far["low"].as_py()
                    a, b, xs, ys = (side.values.to_numpy() for side in (near["words"], far["words"], run["xs"], run["ys"]))
                    start, end, other_start, other_end, total, same = align(a, b, xs - low, ys - other_low, self.similarity)
                    if min(varied(a[start:end]), varied(b[other_start:other_end])) >= self.min_words:
                        at.append((int(xs[0]), int(ys[0])))
                        passages.append((start + low, end + low, other_start + other_low, other_end + other_low, total, same, same / total))
                passages = without_runs(passages, at)
                row += [i] * len(passages)
                out += passages
            names = ["doc_id", "other_id", "doc", "other"]
            kept = batch.select(names).take(pa.array(row, pa.int64())).columns
            kinds = (*[pa.int32()] * 6, pa.float64())
            columns = list(zip(*out)) if out else [[] for _ in kinds]
            labels = ["start", "end", "other_start", "other_end", "n_words", "n_same", "similarity"]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, k) for c, k in zip(columns, kinds))], [*names, *labels])
