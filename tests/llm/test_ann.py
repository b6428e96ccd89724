import numpy as np
import pytest
from pyspark.sql import functions as F

from storeledger.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, queries, k):
    """Exact answers: {query: [(vec_id, score)]} over sound vectors of the query's width."""
    def sound(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    held = {(i, tuple(np.float32(v).astype(float))) for i, v in rows if sound(v) and i is not None}
    out = {}
    for q, v in {(i, tuple(np.float32(v).astype(float))) for i, v in queries if sound(v) and i is not None}:
        scored = []
        for i, w in held:
            if i != q and len(w) == len(v):
                a, b = np.array(v), np.array(w)
                scored.append((-(a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())), i))
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("width", [16, 64])
def test_recall_of_a_graph(width):
    rng = np.random.default_rng(width)
    vectors = rng.normal(size=(2000, width)) + 2 * rng.normal(size=(8, width))[rng.integers(0, 8, 2000)]
    graph = ann.build(vectors)
    assert graph.base.shape == (2000, 2 * ann.LINKS) and graph.base.dtype == np.int32
    hit = 0
    for i in range(0, 2000, 40):
        found = graph.search(graph.points[i], ann.SEARCH_WIDTH)[:10]
        hit += len(set(found) & set(np.argsort(-(graph.points @ graph.points[i]))[:10].tolist()))
    assert hit / 500 > 0.95


def test_matches_brute_force(spark):
    rng = np.random.default_rng(17)
    vectors = rng.normal(size=(600, 12)).tolist()
    rows = [(i, v) for i, v in enumerate(vectors)]
    rows += [(600 + i, vectors[0]) for i in range(150)] + [(750, [2 * x for x in vectors[50]]), (751, [0.0] * 12), (752, None), (753, [])]
    rows += [(754, [None, *vectors[1][1:]]), (755, [float("nan"), *vectors[1][1:]]), (756, [float("inf"), *vectors[1][1:]]), (None, vectors[3])]
    rows += [(757, [1.0, 2.0]), (800, [2.0, 1.0]), (850, [1.0, 1.0, 1.0]), (100, vectors[100])]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(5)
    got = {}
    for r in ann.nearest(table, table.where("vec_id % 50 = 0"), shard_rows=200).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    wanted = {q: a for q, a in brute(rows, [r for r in rows if r[0] is not None and r[0] % 50 == 0], 5).items() if a}
    assert set(got) == set(wanted)
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hit >= 0.97 * sum(map(len, wanted.values()))
    for q in (0, 50, 800):  # equal vectors and ties
        assert [i for i, _ in got[q]] == [i for i, _ in wanted[q]]
    for q in wanted:
        scores = dict(wanted[q])
        assert all(abs(s - scores[i]) < 1e-12 for i, s in got[q] if i in scores)


def test_empty_tables(spark):
    table = spark.createDataFrame([(1, [1.0, 0.0], 0)], SCHEMA)
    assert ann.nearest(table, table).collect() == []
    assert ann.nearest(table.limit(0), table).collect() == []
    assert ann.nearest(table, table.limit(0)).collect() == []


def test_every_vector_is_indexed(spark):
    rng = np.random.default_rng(18)
    table = spark.createDataFrame([(i, v, 0) for i, v in enumerate(rng.normal(size=(300, 8)).tolist())], SCHEMA)
    rows = ann.index(ann.usable(table), 6, 100).table.select(F.explode(F.flatten("members")).alias("id")).collect()
    assert sorted(r.id for r in rows) == list(range(300))


def test_ties_go_to_the_smaller_id_and_tiny_or_huge_vectors_have_scores(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=6)
    rows = [(i, (base * 2.0 ** (i % 31 - 15)).tolist()) for i in range(30)]
    rows += [(100 + i, (rng.normal(size=6) * scale).tolist()) for i, scale in enumerate([1e-200, 1e200, 1e-300, 1e150, 1.0] * 4)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann.nearest(frame, frame.where("vec_id in (0, 7, 100, 101, 102)")).collect()
    first = {q: [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 7)}
    assert first == {0: [1, 2, 3, 4, 5], 7: [0, 1, 2, 3, 4]}
    unit = {v: np.array(x) / np.abs(x).max() for v, x in rows}
    for r in found:
        a, b = unit[r.query_id], unit[r.vec_id]
        assert abs(r.score - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12
    for query in (100, 101, 102):
        scores = {v: unit[query] @ x / np.sqrt((unit[query] @ unit[query]) * (x @ x)) for v, x in unit.items() if v != query}
        assert min(r.score for r in found if r.query_id == query) >= sorted(scores.values())[-5] - 1e-9
