import random
import zlib

import pytest

import corpus
from storeledger.llm import sharding

ORDER = ["doc_id", "size", "text_crc32"]


def brute(rows, shards):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    total, before, out, slots = sum(r[1] for r in rows), 0, [], {}
    for doc_id, size, crc in rows:
        shard = min(shards - 1, (2 * before + size) * shards // max(1, 2 * total))
        slots[shard] = slots.get(shard, -1) + 1
        out.append((doc_id, size, crc, shard, slots[shard]))
        before += size
    return sorted(out, key=repr)


@pytest.mark.parametrize("shards", [1, 4, 16])
def test_matches_prefix_sums(spark, shards):
    rng = random.Random(3)
    texts = [corpus.prose(rng, rng.choice([0, 3, 40, 400])) for _ in range(200)] + [None, "", "é" * 30] + ["copy of one"] * 90
    ids = [*range(203), *[7] * 60, *[None] * 30]
    docs = corpus.frame(spark, texts, ids, parts=6)
    sized = sharding.document_sizes(docs)
    data = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts)]
    got = [tuple(r) for r in sharding.shard_by_bytes(sized, ORDER, shards=shards).collect()]
    assert sorted(got, key=repr) == brute(data, shards)


def test_empty_and_clashing_columns(spark):
    none = sharding.document_sizes(corpus.frame(spark, []))
    assert sharding.shard_by_bytes(none, ORDER).collect() == []
    rows = spark.createDataFrame([(1, 5, "a", 9), (2, None, "b", 9), (3, 7, "c", 9)], "doc_id long, size long, _place string, shard int")
    got = sharding.shard_by_bytes(rows, ["doc_id"], shards=2)
    assert got.columns == ["doc_id", "size", "_place", "shard", "slot"]
    assert {(r.doc_id, r.shard, r.slot) for r in got.collect()} == {(1, 0, 0), (2, 0, 1), (3, 1, 0)}
