"""Registered queries against their SQL in another engine, on the given tables and on edge cases."""

import os
from pathlib import Path

import duckdb
import pytest

import corpus
from storeledger.llm.queries import build_queries
from storeledger.llm.sql import build_oracle

ROOT = Path(os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01"))


@pytest.fixture(scope="module")
def edges(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("edges")
    texts = [None, "", "a", "menu\nown 1", "menu\nown 2", "menu\n\nmenu", "menu\nü", "x\n" * 50, "a", "menu"]
    corpus.frame(spark, texts, [*range(8), None, 3], sources=["s"] * 7 + [None, None, "t"]).write.parquet(f"{root}/documents.parquet")
    turns = [(c, t or None, "user", f"turn {min(c, t)}" if t < 3 else None) for c in [0, 1, 2, 4, 7, 9, 15] for t in range(c % 6)]
    turns += [(None, 0, "user", "lost"), (12, 0, None, "")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{root}/conversations.parquet")
    vectors = [(i, i % 3 if i % 11 else None, [((i * 7) % 13 - 4) / 9, (i % 5) / 3] if i % 13 else None) for i in range(330)]
    vectors += [(1, 1, [float("nan"), 1.0]), (2, 2, [None, 0.0]), vectors[100], (500, 1, [0.5])]
    spark.createDataFrame(vectors, "vec_id long, label int, embedding array<float>").write.parquet(f"{root}/embeddings.parquet")
    return root


@pytest.mark.parametrize("name", sorted(build_oracle()))
@pytest.mark.parametrize("where", ["given", "edges"])
def test_matches_sql(spark, edges, name, where):
    root = edges if where == "edges" else ROOT
    if not root.exists():
        pytest.skip("driver tables not present")
    found = build_queries()[name](spark, str(root))
    connection = duckdb.connect()
    for path in (root / f"{t}.parquet" for t in ("documents", "conversations", "embeddings")):
        if path.exists():
            connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    columns = sorted(found.columns)
    theirs = connection.execute(f"SELECT {', '.join(columns)} FROM ({build_oracle()[name]})").fetchall()
    ours = [tuple(r) for r in found.select(*columns).collect()]
    assert sorted(ours, key=repr) == sorted(theirs, key=repr)
