"""Deletes across references against a plain restatement."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeledger.operators import removal
from storeledger.sources.schema import Reference, TableSpec
from storeledger.sources.tables import tables_from_rows
from test_jobs import SHOP


def _spec(name, *references):
    columns = ["id", *(r.column for r in references)]
    return TableSpec(name, T.StructType([T.StructField(c, T.LongType()) for c in columns]), references=references)


# A diamond, a chain with a restriction at its end, and a table beside them.
SPECS = [
    _spec("root"),
    _spec("left", Reference("root_id", "root", "cascade")),
    _spec("right", Reference("root_id", "root", "cascade")),
    _spec("both", Reference("left_id", "left", "cascade"), Reference("right_id", "right", "cascade")),
    _spec("guard", Reference("both_id", "both", "restrict"), Reference("left_id", "left", "cascade")),
    _spec("leaf", Reference("guard_id", "guard", "cascade"), Reference("root_id", "root", "restrict")),
]


def _plain(rows, table, keys):
    """Try each key alone; what may go goes."""
    ids = {name: {r[0] for r in found} for name, found in rows.items()}
    gone, blockers = {s.name: set() for s in SPECS}, []
    for key in sorted(set(keys) & ids[table]):
        taken, lines = {s.name: set() for s in SPECS} | {table: {key}}, {}
        for spec in SPECS:
            for at, r in enumerate(spec.references, 1):
                if r.on_delete == "cascade":
                    lines |= {(spec.name, i): row for i, row in enumerate(rows[spec.name]) if row[at] in taken[r.parent]}
                    taken[spec.name] |= {row[0] for row in rows[spec.name] if row[at] in taken[r.parent]}
        found = [
            (key, spec.name, r.column, parent, sum(row[at] == parent for row in rows[spec.name]))
            for spec in SPECS
            for at, r in enumerate(spec.references, 1)
            if r.on_delete == "restrict"
            for parent in taken[r.parent]
        ]
        found = [b for b in found if b[-1]]
        blockers += found
        if not found:
            for name in taken:
                gone[name] |= taken[name]
    remaining = {}
    for spec in SPECS:
        remaining[spec.name] = sorted(
            (
                row
                for row in rows[spec.name]
                if not (spec.name == table and row[0] in gone[table])
                and not any(r.on_delete == "cascade" and row[at] in gone[r.parent] for at, r in enumerate(spec.references, 1))
            ),
            key=repr,
        )
    return remaining, sorted(blockers)


@pytest.mark.parametrize("seed", [1, 2])
def test_graph_against_restatement(spark, seed):
    rng = random.Random(seed)

    def some(n):
        return rng.choice([None, *range(n), *range(n)])

    rows = {
        "root": [(i,) for i in range(12)],
        "left": [(i, some(12)) for i in range(20)],
        "right": [(i, some(12)) for i in range(20)],
        "both": [(i, some(20), some(20)) for i in range(25)],
        "guard": [(i, some(60), some(40)) for i in range(8)],
        "leaf": [(i, some(8), some(80)) for i in range(12)],
    }
    frames = {s.name: spark.createDataFrame(rows[s.name], s.schema) for s in SPECS}
    for table, keys in (("root", [0, 1, 2, 3, 4, 5, 6, 7, 99, None]), ("left", list(range(0, 20, 2)))):
        found = removal.delete_rows(frames, table, spark.createDataFrame([(k,) for k in keys], "id long"), SPECS)
        remaining, blockers = _plain(rows, table, [k for k in keys if k is not None])
        assert {n: sorted(map(tuple, df.collect()), key=repr) for n, df in found.remaining.items()} == remaining
        assert sorted(map(tuple, found.blockers.collect())) == blockers
        for spec in SPECS:
            for r in spec.references:  # no orphan that was none before
                lost = frames[r.parent].join(found.remaining[r.parent], "id", "left_anti").select(F.col("id").alias(r.column))
                assert found.remaining[spec.name].join(lost, r.column, "left_semi").count() == 0


def test_shop(spark):
    shop = tables_from_rows(spark, SHOP)

    def ids(df):
        return sorted(r[0] for r in df.select("id").collect())

    gone = removal.delete_rows(shop, "orders", spark.createDataFrame([(11,), (13,), (11,)], "id long"))
    assert ids(gone.remaining["orders"]) == [10, 12, 14, 15]
    assert ids(gone.remaining["order_lines"]) == [100, 102, 103, 107]
    assert ids(gone.remaining["customers"]) == [1, 2, 3, 4] and gone.blockers.count() == 0
    kept = removal.delete_rows(shop, "customers", spark.createDataFrame([(1,), (4,)], "id long"))
    assert ids(kept.remaining["customers"]) == [1, 2, 3]
    assert [tuple(r) for r in kept.blockers.collect()] == [(1, "orders", "customer_id", 1, 3)]
    assert kept.remaining["orders"].columns == shop.orders.columns
