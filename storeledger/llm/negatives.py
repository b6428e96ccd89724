"""Hard negatives by integer inner product: best-first search of packed R-trees of boxes."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm.store import staged

SHARD_ROWS = 16384  # rows of one tree
LEAF_ROWS = 256
FANOUT = 16
LOW, HIGH, WHOLE = 80, 100, 100  # a negative scores LOW to HIGH hundredths of the positive's score
_EXACT = float(1 << 53)


def usable(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, vector (doubles), width, mark (fingerprint of the row): the rows that take part, each distinct one once.

    Rows with a null id, label or vector or a null or non-finite component take no part.
    """
    found = rows.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector")
    )
    found = found.where("vec_id is not null and label is not null and vector is not null")
    found = found.where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    marked = found.withColumns({"width": F.size("vector"), "mark": F.xxhash64("label", "vector")})
    return marked.dropDuplicates(["vec_id", "mark"])


def hard_negatives(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 5,
    low: int = LOW,
    high: int = HIGH,
    whole: int = WHOLE,
    scale: int = 256,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; both frames have vec_id, label, embedding.

    A component x counts as floor(scale * x), and a row's score is its exact inner product with the anchor in these whole
    numbers; higher scores come first, equal ones by smaller vec_id. An anchor's positives are its first `positives` rows of
    its label and another vec_id, and a positive's negatives are the first `negatives` rows of other labels with
    low * positive_score <= whole * negative_score <= high * positive_score. All if there are fewer. Vectors of another width
    than the anchor's are not compared. See `usable` for the rows that take no part; equal rows count once, and rows that
    share a vec_id but differ are rows of their own. A score that no long holds stops the job if it is in the result.

    The search is exact: anchors go to the trees that hold their label for the positives, and to every tree for the negatives,
    whose windows follow from the positives of all trees. A tree answers an anchor with its few best. A task holds the rows
    of one tree at a time and reads the anchors past it. All anchors meet all trees, as an exact search by scores must where
    boxes overlap: work grows with rows times anchors, and larger trees make fewer copies of the anchors.
    """
    found = _index(usable(rows), shard_rows)
    asked = staged(usable(anchors))
    having = found.rows.groupBy("width", "label").agg(F.collect_set("shard").alias("shards"))
    own_label = asked.join(having, ["width", "label"]).withColumn("scores", F.array().cast("array<long>"))
    near = _ask(own_label, found.rows, _Positives(positives, scale))
    order = [F.desc("score"), F.asc("found_id")]
    ranked = near.withColumn("place", F.row_number().over(Window.partitionBy("vec_id", "mark").orderBy(*order, "found_mark")))
    best = staged(ranked.where(F.col("place") <= positives).select("vec_id", "mark", "found_id", "place", "score"))

    windows = best.groupBy("vec_id", "mark").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("found"))
    windows = asked.join(windows, ["vec_id", "mark"]).withColumn("scores", F.col("found.score")).drop("found")
    every_shard = windows.join(F.broadcast(found.shards), "width")
    far = _ask(every_shard, found.rows, _Negatives(negatives, low, high, whole, scale))
    own = Window.partitionBy("vec_id", "mark", "place").orderBy(*order, "found_mark")
    kept = far.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= negatives)
    named = best.select("vec_id", "mark", "place", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return kept.join(named, ["vec_id", "mark", "place"]).select(
        F.col("vec_id").alias("anchor_id"),
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("found_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _spread(column: Column, salt: int) -> Column:
    """`column` as a double, with a fraction drawn from the row, so that many equal values can be cut between them."""
    return column.cast("double") + F.pmod(F.xxhash64(F.lit(salt), "vec_id", "mark"), F.lit(1 << 20)) / float(1 << 20)


class _Index(NamedTuple):
    """Rows with their shard and their place in its tree; `shards` lists the numbers of all shards for each vector width."""

    rows: DataFrame
    shards: DataFrame


def _index(rows: DataFrame, shard_rows: int) -> _Index:
    """Sort-tile-recursive: over the label and the first component for the shards, over all coordinates within one.

    Shards are cut where the quantiles are, about the square root of their number for each of the two; these cuts and one
    row for each width go to every task.
    """
    bounded = F.least(F.greatest(F.coalesce(F.get("vector", F.lit(0)), F.lit(0.0)), F.lit(-1e12)), F.lit(1e12))
    keyed = staged(rows.withColumns({"by_label": _spread(F.col("label"), 1), "by_first": _spread(bounded * 256, 2)}))
    counts = staged(
        keyed.groupBy("width")
        .agg(F.ceil(F.count("*") / shard_rows).alias("wanted"))
        .withColumn("slabs", F.ceil(F.sqrt("wanted")).cast("int"))
        .withColumn("tiles", F.ceil(F.col("wanted") / F.col("slabs")).cast("int"))
        .select("width", "slabs", "tiles")
    )
    slabbed = _cut(keyed, counts, ["width"], "by_label", "slabs", "slab")
    tiled = _cut(slabbed, counts, ["width", "slab"], "by_first", "tiles", "tile")
    shard = F.expr("cast(slab * tiles + tile as long)").alias("shard")
    dealt = tiled.join(F.broadcast(counts), "width").select("width", shard, "vec_id", "label", "mark", "vector")
    packed = dealt.groupBy("width", "shard").applyInPandas(_packed, "width int, shard long, place long, vec_id long, label long, mark long, vector array<double>")
    shards = F.expr("sequence(0L, cast(slabs * tiles - 1 as long))").alias("shards")
    return _Index(staged(packed), counts.select("width", shards))


def _cut(rows: DataFrame, counts: DataFrame, groups: list[str], by: str, pieces: str, name: str) -> DataFrame:
    """`rows` with `name`, the place of `by` among equal quantiles of its group."""
    cuts = []
    for count in [r[0] for r in counts.select(pieces).distinct().collect()]:  # one for each width of vectors, often one in all
        if count > 1:
            steps = [i / count for i in range(1, count)]
            some = rows.join(F.broadcast(counts.where(F.col(pieces) == count)), "width")
            cuts.append(some.groupBy(*groups).agg(F.percentile_approx(by, steps, 100 * count).alias("cuts")))
    if not cuts:
        return rows.withColumn(name, F.lit(0))
    every = cuts[0]
    for more in cuts[1:]:
        every = every.union(more)
    held = rows.join(F.broadcast(staged(every)), groups, "left")
    below = F.size(F.filter("cuts", lambda x: x < F.col(by)))
    return held.withColumn(name, F.when(F.col("cuts").isNull(), 0).otherwise(below)).drop("cuts")


def _packed(rows: pd.DataFrame) -> pd.DataFrame:
    width = int(rows["width"].iloc[0])
    rows = rows.sort_values(["vec_id", "mark"])
    parts = np.stack(rows["vector"].to_numpy()).astype(np.float64).reshape(len(rows), width)
    rows = rows.iloc[packed_order(parts, rows["label"].to_numpy(np.int64), LEAF_ROWS)]
    return rows.assign(place=np.arange(len(rows)))[["width", "shard", "place", "vec_id", "label", "mark", "vector"]]


def packed_order(parts: np.ndarray, labels: np.ndarray, leaf: int) -> np.ndarray:
    """Sort-tile-recursive: rows sorted by one coordinate and cut into slabs, each slab by the next, down to leaves.

    The label comes first, then the components from the widest on. With p pages left for d coordinates, a slab is cut into
    the d-th root of p, two at least.
    """
    keys = [labels, *(parts[:, i] for i in np.argsort(-np.ptp(parts, axis=0), kind="stable"))] if len(parts) else [labels]
    out: list[np.ndarray] = []
    todo = [(np.arange(len(labels)), 0)]
    while todo:
        rows, at = todo.pop()
        pages = -(-len(rows) // leaf)
        if pages <= 1:
            out.append(rows)
            continue
        rows = rows[np.argsort(keys[at % len(keys)][rows], kind="stable")]
        slabs = max(2, math.ceil(pages ** (1 / max(1, len(keys) - at))))
        size = leaf * -(-pages // slabs)
        todo += [(rows[i : i + size], at + 1) for i in range(0, len(rows), size)][::-1]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def whole_numbers(parts: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of each part: doubles where these hold all of it, else whole numbers of any length."""
    with np.errstate(over="ignore"):
        out = np.floor(parts * scale)
    if np.isfinite(out).all():
        return out
    return np.array([math.floor(x * scale) if math.isfinite(x * scale) else int(x) * scale for x in parts.ravel().tolist()], object).reshape(parts.shape)


class Tree:
    """Boxes over the rows of one shard, level by level from the leaves up: `low[n][i]` and `high[n][i]` bound node i of level n."""

    def __init__(self, parts: np.ndarray, labels: np.ndarray, ids: np.ndarray, marks: np.ndarray, leaf: int = LEAF_ROWS) -> None:
        """The rows stand in packed order; a leaf is a run of `leaf` of them, a node above a run of `FANOUT` nodes."""
        self.parts, self.labels, self.ids, self.marks, self.leaf = parts, labels, ids, marks, leaf
        starts = np.arange(0, len(parts), leaf)
        self.low, self.high = [np.minimum.reduceat(parts, starts)], [np.maximum.reduceat(parts, starts)]
        self.least, self.most = [np.minimum.reduceat(labels, starts)], [np.maximum.reduceat(labels, starts)]
        while len(self.low[-1]) > 1:
            starts = np.arange(0, len(self.low[-1]), FANOUT)
            for levels, reduce in ((self.low, np.minimum), (self.least, np.minimum), (self.high, np.maximum), (self.most, np.maximum)):
                levels.append(reduce.reduceat(levels[-1], starts))

    def largest(self) -> float:
        """The largest component, without its sign."""
        return np.abs(self.parts).max() if self.parts.size else 0

    def search(self, anchor: np.ndarray, label: int, same: bool, wanted: Callable, take: Callable) -> None:
        """Hand the rows of boxes that may matter to `take`, best box first.

        `wanted(lows, highs)` tells for which intervals of scores a box can still add to the result; it is asked again when a
        box comes up. `same` looks for rows of the anchor's label, else for the others.
        """
        up, down = np.maximum(anchor, 0), np.minimum(anchor, 0)
        top = len(self.low) - 1
        queue: list[tuple] = []

        def push(level: int, nodes: slice) -> None:
            low, high = self.low[level][nodes], self.high[level][nodes]
            lows, highs = low @ up + high @ down, high @ up + low @ down
            least, most = self.least[level][nodes], self.most[level][nodes]
            able = (least <= label) & (label <= most) if same else (least != label) | (most != label)
            for i in np.flatnonzero(able & wanted(lows, highs)).tolist():
                heapq.heappush(queue, (-highs[i], level, nodes.start + i, lows[i]))

        push(top, slice(0, 1))
        while queue:
            high, level, node, low = heapq.heappop(queue)
            if not wanted(np.array([low]), np.array([-high]))[0]:
                continue
            if level:
                push(level - 1, slice(node * FANOUT, min((node + 1) * FANOUT, len(self.low[level - 1]))))
                continue
            rows = slice(node * self.leaf, (node + 1) * self.leaf)
            fit = (self.labels[rows] == label) == same
            scores = self.parts[rows] @ anchor
            take(scores[fit], self.ids[rows][fit], self.marks[rows][fit])


class _Best:
    """The first few of what was added: higher scores first, equal ones by smaller id, then mark."""

    def __init__(self, count: int) -> None:
        self.count, self.held = count, []

    def bound(self) -> float | None:
        """The score below which nothing more gets in."""
        return self.held[0][0] if len(self.held) == self.count else None

    def add(self, scores: np.ndarray, ids: np.ndarray, marks: np.ndarray) -> None:
        if (bound := self.bound()) is not None:
            over = scores >= bound
            scores, ids, marks = scores[over], ids[over], marks[over]
        for score, row, mark in zip(scores.tolist(), ids.tolist(), marks.tolist()):
            item = (score, -row, -mark)
            if len(self.held) < self.count:
                heapq.heappush(self.held, item)
            elif item > self.held[0]:
                heapq.heapreplace(self.held, item)


class _Positives:
    def __init__(self, count: int, scale: int) -> None:
        self.count, self.scale = count, scale

    def __call__(self, tree: Tree, anchor: np.ndarray, ask: dict) -> Iterator[tuple]:
        best = _Best(self.count)

        def wanted(lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
            return np.full(len(highs), True) if best.bound() is None else highs >= best.bound()

        def take(scores: np.ndarray, ids: np.ndarray, marks: np.ndarray) -> None:
            other = ids != ask["vec_id"]
            best.add(scores[other], ids[other], marks[other])

        tree.search(anchor, ask["label"], True, wanted, take)
        for score, row, mark in best.held:
            yield 0, -row, -mark, score


class _Negatives:
    def __init__(self, count: int, low: int, high: int, whole: int, scale: int) -> None:
        self.count, self.low, self.high, self.whole, self.scale = count, low, high, whole, scale

    def __call__(self, tree: Tree, anchor: np.ndarray, ask: dict) -> Iterator[tuple]:
        # low * p <= whole * n <= high * p as bounds of the whole number n.
        windows = [(-(-self.low * p // self.whole), self.high * p // self.whole, _Best(self.count)) for p in ask["scores"]]

        def wanted(lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
            out = np.full(len(highs), False)
            for least, most, best in windows:
                bound = best.bound()
                out |= (highs >= (least if bound is None else bound)) & (lows <= most)
            return out

        def take(scores: np.ndarray, ids: np.ndarray, marks: np.ndarray) -> None:
            for least, most, best in windows:
                fit = (scores >= least) & (scores <= most)
                best.add(scores[fit], ids[fit], marks[fit])

        tree.search(anchor, ask["label"], False, wanted, take)
        for place, (_, _, best) in enumerate(windows, 1):
            for score, row, mark in best.held:
                yield place, -row, -mark, score


_ANSWER = "vec_id long, mark long, place int, found_id long, found_mark long, score long"
_MET = ["width", "shard", "place", "vec_id", "label", "mark", "vector", "scores"]


def _ask(asked: DataFrame, rows: DataFrame, answer: Callable) -> DataFrame:
    """The answers of the trees to `asked` (vec_id, mark, label, width, vector, scores, shards)."""
    asking = asked.withColumn("shard", F.explode("shards")).withColumn("place", F.lit(None).cast("long")).select(*_MET)
    held = rows.withColumn("scores", F.lit(None).cast("array<long>")).select(*_MET)
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.select("width", "shard").distinct().count())
    met = held.union(asking).repartition(parts, "width", "shard")
    return met.sortWithinPartitions("width", "shard", F.asc_nulls_last("place")).mapInArrow(_Answers(answer), _ANSWER)


class _Answers:
    """Rows of a tree come in their places, then those that ask it."""

    def __init__(self, answer: Callable) -> None:
        self.answer = answer

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        names = [f.split()[0] for f in _ANSWER.split(", ")]
        at, held, tree = None, [], None
        for batch in batches:
            width, shard = (batch.column(c).to_numpy() for c in ("width", "shard"))
            asks = batch.column("place").is_null().to_numpy(zero_copy_only=False)
            change = (width[1:] != width[:-1]) | (shard[1:] != shard[:-1]) | (asks[1:] != asks[:-1])
            edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for begin, end in zip(edges[:-1], edges[1:]):
                if begin == end:
                    continue
                run = batch.slice(begin, end - begin)
                if at != (width[begin], shard[begin]):
                    at, held, tree = (width[begin], shard[begin]), [], None
                if not asks[begin]:
                    held.append(run)
                    continue
                if held:
                    tree, held = _Whole(held, int(width[begin]), self.answer.scale), []
                out = tree.answers(run, self.answer) if tree is not None else []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)


class _Whole:
    """The tree of one shard in whole numbers."""

    def __init__(self, runs: list[pa.RecordBatch], width: int, scale: int) -> None:
        self.scale = scale
        table = pa.Table.from_batches(runs)
        self.rows = [table.column(c).to_numpy() for c in ("label", "vec_id", "mark")]
        vectors = table.column("vector").combine_chunks()
        flat = (vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors).flatten().to_numpy()
        self.tree, self.long_tree = Tree(whole_numbers(flat.reshape(table.num_rows, width), scale), *self.rows), None
        self.largest = self.tree.largest()

    def answers(self, asks: pa.RecordBatch, answer: Callable) -> list[tuple]:
        out = []
        for ask in asks.select(["vec_id", "label", "mark", "vector", "scores"]).to_pylist():
            anchor = whole_numbers(np.array(ask["vector"], np.float64), self.scale)
            tree = self.tree
            if self.largest * sum(abs(x) for x in anchor.tolist()) >= _EXACT or object in (anchor.dtype, tree.parts.dtype):
                # Doubles would round such products; whole numbers of any length do not.
                anchor, tree = _long(anchor), self._long_tree()
            for place, found, mark, score in answer(tree, anchor, ask):
                if abs(score) >= 1 << 63:
                    raise ValueError(f"the score of rows {ask['vec_id']} and {found} does not fit a long")
                out.append((ask["vec_id"], ask["mark"], place, found, mark, int(score)))
        return out

    def _long_tree(self) -> Tree:
        if self.long_tree is None:
            self.long_tree = Tree(_long(self.tree.parts), *self.rows)
        return self.long_tree


def _long(numbers: np.ndarray) -> np.ndarray:
    out = np.empty(numbers.size, object)
    out[:] = [int(x) for x in numbers.ravel().tolist()]
    return out.reshape(numbers.shape)
