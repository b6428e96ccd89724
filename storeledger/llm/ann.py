"""Approximate nearest neighbours by cosine, with a navigable small-world graph for each shard."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm.store import staged

SHARD_ROWS = 4096
LINKS = 16  # of a node on the upper levels; twice as many on the lowest
BUILD_WIDTH = 64
SEARCH_WIDTH = 96
QUERY_BLOCK = 512


class Graph(NamedTuple):
    """Neighbours as flat arrays: row i of `base` and of each upper level holds node i's neighbours, -1 where there is none."""

    points: np.ndarray  # unit vectors, float32
    base: np.ndarray
    upper: np.ndarray  # level, node, place
    entry: int

    def search(self, query: np.ndarray, width: int) -> list[int]:
        """About the `width` nearest nodes, nearest first."""
        if not len(self.points):
            return []
        at = self.entry
        near = float(self.points[at] @ query)
        for level in range(len(self.upper) - 1, -1, -1):
            at, near = _descend(self.points, self.upper[level], query, at, near)
        found = _widen(self.points, self.base, query, [(near, at)], width, np.zeros(len(self.points), bool))
        return [node for _, node in found]


def _descend(points: np.ndarray, links: np.ndarray, query: np.ndarray, at: int, near: float) -> tuple[int, float]:
    while True:
        others = links[at]
        others = others[others >= 0]
        if not len(others):
            return at, near
        scores = points[others] @ query
        best = int(np.argmax(scores))
        if scores[best] <= near:
            return at, near
        at, near = int(others[best]), float(scores[best])


def _widen(points, links, query, starts: list[tuple[float, int]], width: int, seen: np.ndarray) -> list[tuple[float, int]]:
    """The best `width` nodes met by following, from the best unfinished node on, all neighbours not yet seen."""
    for _, node in starts:
        seen[node] = True
    todo = [(-score, node) for score, node in starts]
    heapq.heapify(todo)
    best = list(starts)
    heapq.heapify(best)
    while todo:
        score, node = heapq.heappop(todo)
        if len(best) >= width and -score < best[0][0]:
            break
        others = links[node]
        others = others[others >= 0]
        others = others[~seen[others]]
        if not len(others):
            continue
        seen[others] = True
        scores = points[others] @ query
        if len(best) >= width:
            better = scores > best[0][0]
            others, scores = others[better], scores[better]
        for s, other in zip(scores.tolist(), others.tolist()):
            if len(best) < width:
                heapq.heappush(best, (s, other))
            elif s > best[0][0]:
                heapq.heapreplace(best, (s, other))
            else:
                continue
            heapq.heappush(todo, (-s, other))
    return sorted(best, reverse=True)


def _spread(points: np.ndarray, found: list[tuple[float, int]], limit: int) -> list[int]:
    """Up to `limit` of the nodes found, nearest first, leaving out those nearer to a chosen one than to the new node.

    What is left out fills the places that remain.
    """
    nodes = np.array([node for _, node in found])
    near = np.array([score for score, _ in found])
    between = points[nodes] @ points[nodes].T
    chosen: list[int] = []
    for i in range(len(nodes)):
        if len(chosen) == limit:
            break
        if not chosen or between[i, chosen].max() < near[i]:
            chosen.append(i)
    rest = [i for i in range(len(nodes)) if i not in set(chosen)]
    return nodes[(chosen + rest)[:limit]].tolist()


def build(vectors: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH, seed: int = 0) -> Graph:
    """A graph over distinct non-zero vectors, inserted in the order given."""
    wide = vectors.astype(np.float64)
    points = (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)
    count = len(points)
    levels = np.minimum(-np.log(1 - np.random.default_rng(seed).random(count)) / np.log(links), 8).astype(int)
    top = int(levels.max()) if count else 0
    layers = [np.full((count, 2 * links if level == 0 else links), -1, np.int32) for level in range(top + 1)]
    entry, height = 0, int(levels[0]) if count else 0
    for node in range(1, count):
        query, at = points[node], entry
        near = float(points[at] @ query)
        for level in range(height, levels[node], -1):
            at, near = _descend(points, layers[level], query, at, near)
        starts = [(near, at)]
        for level in range(min(height, levels[node]), -1, -1):
            table = layers[level]
            starts = _widen(points, table, query, starts, width, np.zeros(count, bool))
            chosen = _spread(points, starts, links)
            table[node, : len(chosen)] = chosen
            for other in chosen:
                row = table[other]
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = node
                else:
                    around = np.append(row, node)
                    scores = points[around] @ points[other]
                    order = np.argsort(-scores, kind="stable")
                    kept = _spread(points, [(float(scores[i]), int(around[i])) for i in order], table.shape[1])
                    table[other] = -1
                    table[other, : len(kept)] = kept
        if levels[node] > height:
            entry, height = node, int(levels[node])
    upper = np.stack(layers[1:]) if top else np.zeros((0, count, links), np.int32)
    return Graph(points, layers[0] if count else np.zeros((0, 2 * links), np.int32), upper, entry)


_INDEX = (
    "width int, shard long, entry long, members array<array<long>>, vectors binary, points binary, base binary, upper binary"
)


class Index(NamedTuple):
    """Graphs by shard: `table` has a row for each, `shards` tells how many there are for each vector width."""

    table: DataFrame
    shards: DataFrame


def usable(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, vector (doubles), width, va and vb (fingerprint), without null or zero vectors or those with null or non-finite parts.

    A vector is scaled by the power of two that brings its largest part near 1. That changes no cosine, lets no square
    vanish or overflow, and makes vectors equal that differ by such a factor.
    """
    found = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    found = found.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(sound & F.exists("vector", lambda x: x != 0))
    largest = F.array_max(F.transform("vector", F.abs))
    # Two factors, as one could be larger than any double.
    half = F.floor(F.log2(largest) / 2)
    down, rest = F.pow(F.lit(2.0), half), F.pow(F.lit(2.0), F.floor(F.log2(largest)) - half)
    found = found.withColumns({"down": down, "rest": rest})
    found = found.withColumn("vector", F.transform("vector", lambda x: x / F.col("down") / F.col("rest"))).drop("down", "rest")
    return found.withColumns(
        {
            "width": F.size("vector"),
            "va": F.xxhash64("vector"),
            "vb": F.xxhash64(F.lit("vector"), "vector"),
        }
    )


def index(rows: DataFrame, most: int, shard_rows: int = SHARD_ROWS) -> Index:
    """A graph for each shard of about `shard_rows` distinct vectors (see `usable`); every vector is in one of them.

    Equal vectors are one node, which lists its `most` smallest ids: more of them cannot be among the `most` nearest.
    """
    order = Window.partitionBy("width", "va", "vb").orderBy("vec_id")
    ids = rows.select("width", "va", "vb", "vec_id").distinct().withColumn("rank", F.row_number().over(order))
    ids = ids.where(F.col("rank") <= most).groupBy("width", "va", "vb").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    one = rows.groupBy("width", "va", "vb").agg(F.first("vector").alias("vector"))
    nodes = staged(one.join(ids, ["width", "va", "vb"]))
    shards = staged(nodes.groupBy("width").agg(F.ceil(F.count("*") / shard_rows).alias("shards")))
    dealt = nodes.join(F.broadcast(shards), "width").withColumn("shard", F.pmod("va", "shards")).drop("shards")
    return Index(staged(dealt.groupBy("width", "shard").applyInPandas(_graph_row, _INDEX)), shards)


def _graph_row(nodes: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values(["va", "vb"])
    vectors = np.stack(nodes["vector"].to_numpy())
    graph = build(vectors)
    return pd.DataFrame(
        {
            "width": [vectors.shape[1]],
            "shard": [nodes["shard"].iloc[0]],
            "entry": [graph.entry],
            "members": [nodes["ids"].tolist()],
            "vectors": [vectors.tobytes()],
            "points": [graph.points.tobytes()],
            "base": [graph.base.tobytes()],
            "upper": [graph.upper.tobytes()],
        }
    )


def nearest(
    rows: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = SHARD_ROWS, search_width: int = SEARCH_WIDTH
) -> DataFrame:
    """The `k` rows nearest to each query by cosine, of the rows with another id: query_id, rank, vec_id, score.

    `rows` and `queries` have vec_id and embedding; see `usable` for those that take no part. Nearest first, equal scores by
    smaller vec_id. The score is the cosine in double precision. Rows found are nearly always the nearest ones, their scores
    and order are exact. Vectors of different widths are not compared. Equal rows count once; two queries of one id and
    different vectors are searched for both, under that id.

    Queries go in blocks to every shard; a shard answers with its k best, and the best of these are the result.
    """
    found = index(usable(rows), k + 1, shard_rows)
    asked = staged(usable(queries).dropDuplicates(["vec_id", "va", "vb"]))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    packed = (
        asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "va"), F.lit(blocks)))
        .groupBy("width", "block")
        .agg(F.collect_list(F.struct("vec_id", "va", "vector")).alias("queries"))
        .join(F.broadcast(found.shards), "width")
        .select("width", "queries", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))
    )
    met = packed.join(found.table, ["width", "shard"]).select(
        "width", "queries", "entry", "members", "vectors", "points", "base", "upper", "shard"
    )
    answers = met.mapInArrow(_answers(k, search_width), "query_id long, va long, vec_id long, score double")
    order = Window.partitionBy("query_id", "va").orderBy(F.desc("score"), "vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _answers(k: int, search_width: int):
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                yield _shard_answer(row, k, search_width)

    return answer


def _shard_answer(row: dict[str, pa.Scalar], k: int, search_width: int) -> pa.RecordBatch:
    width = row["width"].as_py()
    vectors = np.frombuffer(row["vectors"].as_buffer(), np.float64).reshape(-1, width)
    points = np.frombuffer(row["points"].as_buffer(), np.float32).reshape(-1, width)
    base = np.frombuffer(row["base"].as_buffer(), np.int32).reshape(len(points), -1)
    upper = np.frombuffer(row["upper"].as_buffer(), np.int32).reshape(-1, len(points), LINKS)
    graph = Graph(points, base, upper, row["entry"].as_py())
    members, lengths = row["members"].as_py(), np.sqrt((vectors**2).sum(1))
    out: list[tuple[int, int, int, float]] = []
    for query in row["queries"].as_py():
        own = np.array(query["vector"])
        length = np.sqrt((own**2).sum())
        nodes = graph.search((own / length).astype(np.float32), search_width)
        scores = (vectors[nodes] * own).sum(1) / (lengths[nodes] * length)
        # Of equal scores the smaller id comes first, whatever the nodes' numbers: none that ties with the last is left out.
        least = np.partition(scores, -(k + 1))[-(k + 1)] if len(scores) > k else -np.inf
        near = [(score, node) for score, node in zip(scores.tolist(), nodes) if score >= least]
        others = ((-score, vec_id) for score, node in near for vec_id in members[node] if vec_id != query["vec_id"])
        best = heapq.nsmallest(k, others)
        out += [(query["vec_id"], query["va"], vec_id, -score) for score, vec_id in best]
    columns = list(zip(*out)) if out else [[], [], [], []]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["query_id", "va", "vec_id", "score"])
