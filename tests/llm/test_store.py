from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from storeledger.llm import store
from storeledger.llm.text import mixed


@pytest.mark.parametrize("bits", [16, 20, 24])
def test_filter_has_all_keys_and_few_others(spark, bits):
    keys = mixed(np.arange(1, 401, dtype=np.uint64))
    table = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)] + [(None,)], "key long")
    held = store.key_filter(table, "key", bits)
    assert len(held) == (1 << bits) // 63 + 1
    assert store.maybe_in(held, keys, bits).all()
    others = mixed(np.arange(10_000, 40_000, dtype=np.uint64))
    assert store.maybe_in(held, others, bits).mean() < 0.01
    empty = store.key_filter(table.limit(0), "key", bits)
    assert not store.maybe_in(empty, keys, bits).any()


def test_filters_are_bounded():
    assert store.filter_bits(0) == 16 and store.filter_bits(10**12) == 26
    assert 2 ** store.filter_bits(28_000) >= 100 * 28_000


def test_only_small_tables_are_marked_for_broadcast(spark):
    df = spark.range(100)
    assert "ResolvedHint" in store.small(df, F.lit(8), limit=800)._jdf.queryExecution().logical().toString() or "hint" in store.small(
        df, F.lit(8), limit=800
    )._jdf.queryExecution().logical().toString().lower()
    assert "hint" not in store.small(df, F.lit(8), limit=799)._jdf.queryExecution().logical().toString().lower()


def test_helper_names_are_free():
    assert store.free_names(["a", "_part"], "part") == ["__part"]
    assert store.free_names([], "part") == ["_part"]


def test_folders_are_shared_ones(spark):
    assert store.scratch(spark).startswith(spark.conf.get("spark.checkpoint.dir") + "/")
    assert store.scratch(spark) != store.scratch(spark)
    unset = {"spark.sql.warehouse.dir": "file:/shared/warehouse"}
    other = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: unset.get(key, default)))
    assert store.scratch(other).startswith("file:/shared/warehouse/work/")
