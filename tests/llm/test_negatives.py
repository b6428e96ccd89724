"""Hard negatives against brute force in whole numbers."""

import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from storeledger.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, is_anchor, count=5, scale=256):
    whole = {}
    for vec, label, parts in rows:
        if vec is None or label is None or parts is None or any(x is None or not math.isfinite(x) for x in parts):
            continue
        whole[vec, label, tuple(parts)] = [math.floor(Fraction(x) * scale) for x in parts]
    out = []
    for (vec, label, parts), own in whole.items():
        if not is_anchor(vec):
            continue
        scored = defaultdict(list)
        for (other, theirs, _), found in whole.items():
            if len(found) == len(own) and other != vec:
                scored[theirs == label].append((-sum(a * b for a, b in zip(own, found)), other))
        for score, positive in sorted(scored[True])[:count]:
            fit = sorted(x for x in scored[False] if 80 * -score <= 100 * -x[0] <= 100 * -score)[:count]
            out += [(vec, positive, rank, other, -score, -s) for rank, (s, other) in enumerate(fit, 1)]
    return sorted(out)


def rows():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8)) * 0.3
    found = []
    for vec in range(420):
        label = int(rng.integers(0, 6)) if vec % 3 else 1  # a third of all rows has one label
        parts = (centres[label if vec % 2 else 0] + rng.normal(size=8) * 0.1).tolist()
        found.append((vec, label, parts))
    found += [(500 + i, i % 4, [0.5] * 8) for i in range(60)]  # ties
    found += [found[0], found[100], (None, 1, [0.1] * 8), (601, None, [0.1] * 8), (600, 1, None)]
    found += [(602, 1, [0.1, None] + [0.1] * 6), (700, 1, [math.nan] * 8), (800, 2, [math.inf] + [0.0] * 7)]
    found += [(900, 1, []), (901, 1, []), (902, 2, []), (1000, 3, [0.0] * 8), (1001, 3, [0.1] * 3), (1100, 2, [0.2] * 3), (1102, 2, [0.2] * 3)]
    found += [(1200, 1, [1e6, 2.0]), (1201, 1, [1e6, 2.1]), (1202, 2, [9e5, 2.3]), (1203, 2, [1.0, 2e-9])]  # beyond doubles
    return found


@pytest.mark.parametrize("shard_rows", [60, negatives.SHARD_ROWS])
def test_against_brute_force(spark, shard_rows, monkeypatch):
    monkeypatch.setattr(negatives, "LEAF_ROWS", 8)
    given = rows()
    frame = spark.createDataFrame(given, SCHEMA).withColumns({c: F.lit("x") for c in ("shard", "place", "score", "mark")}).repartition(5)
    found = negatives.hard_negatives(frame, frame.where("vec_id % 20 = 0"), shard_rows=shard_rows)
    assert sorted(map(tuple, found.collect())) == brute(given, lambda v: v % 20 == 0)


def test_empty_and_alone(spark):
    frame = spark.createDataFrame([], SCHEMA)
    found = negatives.hard_negatives(frame, frame)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert found.collect() == []
    one = spark.createDataFrame([(0, 1, [1.0])], SCHEMA)
    assert negatives.hard_negatives(one, one).collect() == []


def test_whole_numbers_of_any_length():
    found = negatives.whole_numbers(np.array([[1e308, -0.001], [-1e308, 5e-324]]), 256)
    assert found.tolist() == [[int(1e308) * 256, -1], [int(-1e308) * 256, 0]]


@pytest.mark.parametrize("rows", [1, 5, 64, 1000])
def test_tree_bounds_and_order(rows):
    rng = np.random.default_rng(rows)
    parts, labels = rng.integers(-50, 50, (rows, 5)).astype(float), rng.integers(0, 3, rows)
    order = negatives.packed_order(parts, labels, 4)
    assert sorted(order.tolist()) == list(range(rows))
    parts, labels = parts[order], labels[order]
    tree = negatives.Tree(parts, labels, np.arange(rows), np.zeros(rows, np.int64), leaf=4)
    anchor = rng.integers(-50, 50, 5).astype(float)
    for level, (low, high) in enumerate(zip(tree.low, tree.high)):
        size = 4 * negatives.FANOUT**level
        for i in range(len(low)):
            own = parts[i * size : (i + 1) * size]
            assert (own >= low[i]).all() and (own <= high[i]).all()
    best = negatives._Best(3)
    looked = []

    def take(scores, ids, marks):
        looked.extend(ids.tolist())
        best.add(scores, ids, marks)

    tree.search(anchor, 1, True, lambda lows, highs: np.full(len(highs), True) if best.bound() is None else highs >= best.bound(), take)
    want = sorted((-float(parts[i] @ anchor), i) for i in range(rows) if labels[i] == 1)[:3]
    assert sorted((-s, -i) for s, i, _ in best.held) == want
    if rows == 1000:
        assert len(looked) < (labels == 1).sum()  # boxes below the third best are not opened
