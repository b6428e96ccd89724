import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus
from storeledger.llm import graph, minhash


def linked(texts, at_least=0.8):
    sets = [corpus.shingle_set(t) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if texts[i] == texts[j] or corpus.jaccard(sets[i], sets[j]) >= at_least]
    return pairs, sets


def classes(rows):
    out = {}
    for r in rows:
        out.setdefault(r.label, set()).add(r.doc_id)
    return {frozenset(x) for x in out.values()}


@pytest.fixture(scope="module")
def family():
    """Originals with copies of few and many changes, exact copies, short texts, and texts that share half."""
    rng = random.Random(11)
    texts = []
    for base in range(25):
        original = corpus.prose(rng, rng.choice([8, 30, 60, 120, 400]))
        texts.append(original)
        for _ in range(rng.choice([0, 1, 2, 12])):
            texts.append(corpus.edited(rng, original, rng.choice([0, 1, 1, 2, 3, 6])))
    passage = corpus.prose(rng, 60)
    texts += [passage + " " + corpus.prose(rng, 50) for _ in range(30)]
    return texts + ["", None, "one two", "one two", "one", None, "same " * 50, "same " * 80]


def test_classes_match_all_pairs(spark, tmp_path, family):
    docs = corpus.stored(spark, corpus.frame(spark, family, parts=4), tmp_path)
    found = minhash.near_duplicates(docs)
    rows = found.documents.collect()
    assert len(rows) == len(family)
    pairs, sets = linked(family)
    together = {}
    for r in rows:
        together[r.doc_id] = r.label
        assert r.class_id == min(x.doc_id for x in rows if x.label == r.label)
        assert r.class_size == sum(x.label == r.label for x in rows)
    assert all(together[i] == together[j] for i, j in pairs)
    # What is linked beyond that has a plain similarity near the threshold, since weights lie between 1 and 1.5.
    close, _ = linked(family, 0.7)
    assert all(any(g <= h for h in corpus.groups(len(family), close)) for g in classes(rows))
    for link in found.links.collect():
        plain = corpus.jaccard(sets[link.a], sets[link.b])
        assert abs(plain - link.plain) < 1e-9 and max(link.plain, link.weighted) >= 0.8


def test_partners_in_full_buckets_are_found(spark, tmp_path):
    """Most of each text is one passage, so that all buckets are large; each text has one partner a little nearer than the rest."""
    rng = random.Random(31)
    passage, texts = corpus.prose(rng, 204), []
    for _ in range(100):
        shared = corpus.prose(rng, 7)
        texts += [f"{passage} {shared} {corpus.prose(rng, 21)}" for _ in range(2)]
    pairs, sets = linked(texts)
    assert len(pairs) == 100 and all(i == j + 1 for i, j in pairs)
    docs = corpus.stored(spark, corpus.frame(spark, texts, parts=4), tmp_path)
    rows = minhash.near_duplicates(docs).documents.collect()
    assert classes(rows) == {frozenset(pair) for pair in pairs}


def test_classes_do_not_hang_on_the_first_pairs(spark, tmp_path, monkeypatch, family):
    """Without the partners chosen in buckets of three texts and more, the exact join finds every class by itself."""
    docs = corpus.stored(spark, corpus.frame(spark, family, parts=4), tmp_path)
    wanted = classes(minhash.near_duplicates(docs).documents.collect())
    first = minhash._Buckets.first_pairs

    def of_two(self):
        self.members = self.members.where("false")
        return first(self)

    def none(self, labels):
        return spark.createDataFrame([], "a long, b long")

    members = []
    made = minhash._Buckets.__init__
    monkeypatch.setattr(minhash._Buckets, "__init__", lambda self, texts: (made(self, texts), members.append(self.members))[0])
    monkeypatch.setattr(minhash._Buckets, "first_pairs", of_two)
    monkeypatch.setattr(minhash._Buckets, "further_pairs", none)
    divided = minhash._Buckets.divided

    def whole(self, labels):
        self.members = members[0]
        return divided(self, labels)

    monkeypatch.setattr(minhash._Buckets, "divided", whole)
    assert classes(minhash.near_duplicates(docs).documents.collect()) == wanted


def test_one_document_of_each_class_stays(spark, tmp_path, family):
    docs = corpus.stored(spark, corpus.frame(spark, family, [*range(len(family) - 3), 3, None, None]).withColumnRenamed("source", "_place"), tmp_path)
    rows = minhash.near_duplicates(docs).documents.collect()
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r.label for r in rows})
    wanted = sorted((min((x.doc_id for x in rows if x.label == label and x.doc_id is not None), default=None) for label in {r.label for r in rows}), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == wanted


def test_repeated_rows_and_empty_tables(spark, tmp_path):
    docs = corpus.stored(spark, corpus.frame(spark, ["a b c d e f"] * 40 + ["z"], [1] * 40 + [2]), tmp_path / "a")
    assert sorted(r.doc_id for r in minhash.keep_one(docs).collect()) == [1, 2]
    empty = corpus.stored(spark, corpus.frame(spark, []), tmp_path / "b")
    assert minhash.near_duplicates(empty).documents.collect() == []
    assert minhash.keep_one(empty).collect() == []


def test_samples_agree_as_often_as_weights_overlap():
    rng = np.random.default_rng(12)
    count = 40
    hashes = rng.integers(1, 1 << 63, count, dtype=np.int64).astype(np.uint64)
    a, b = rng.uniform(0.5, 3, count), rng.uniform(0.5, 3, count)
    a[:5], b[-5:] = 0, 0
    wanted = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    draws = 4000
    minhash_salts, minhash._SALTS = minhash._SALTS, minhash.mixed(np.arange(1, 2 * draws + 1, dtype=np.uint64))
    try:
        same = 0
        for sample in range(draws):
            drawn = []
            for weights in (a, b):
                some = weights > 0
                key, value = minhash._draw(hashes[some], np.log(weights[some]), sample)
                drawn.append(value[np.argmin(key)])
            same += drawn[0] == drawn[1]
    finally:
        minhash._SALTS = minhash_salts
    assert abs(same / draws - wanted) < 0.03


def test_frequent_shingles_are_counted_exactly(spark, monkeypatch):
    rng = random.Random(13)
    passage, rare = corpus.prose(rng, 12), corpus.prose(rng, 12)
    texts = [corpus.prose(rng, 40) + (" " + passage) * (i % 4 == 0) + (" " + rare) * (i % 100 == 0) for i in range(400)]
    monkeypatch.setattr(minhash, "UNIT", 500)
    idf = minhash.document_frequencies(corpus.frame(spark, texts, parts=7))
    counts = {}
    for t in texts:
        for s in corpus.shingle_set(t):
            counts[s] = counts.get(s, 0) + 1
    frequent = sorted(c for c in counts.values() if c >= 400 / 64)
    assert len(idf.hashes) == len(frequent)
    expected = [1 + 0.5 * min(1, np.log(400 / c) / np.log(64)) for c in frequent]
    assert np.allclose(sorted(idf.weights), sorted(expected))


def test_components(spark):
    rng = random.Random(14)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(30)] + [(200, 300 + i) for i in range(50)]
    links = spark.createDataFrame(pairs, "a long, b long").select(F.col("a"), F.col("b"))
    got = {}
    for r in graph.components(links).collect():
        got.setdefault(r.label, set()).add(r.node)
    nodes = sorted({n for p in pairs for n in p})
    expected = corpus.groups(len(nodes), [(nodes.index(a), nodes.index(b)) for a, b in pairs])
    assert {frozenset(nodes.index(n) for n in g) for g in got.values()} == expected
    assert all(label == min(g) for label, g in got.items())
    assert graph.components(links.limit(0)).collect() == []


def test_rows_are_found_again_however_files_are_cut(spark, tmp_path):
    """The tasks that read a table may change between two steps; the rows kept do not."""
    rng = random.Random(21)
    texts = [corpus.prose(rng, 60) for _ in range(60)]
    rows = [(i, texts[i % 60] + (f" tail {i}" if i % 7 == 0 else ""), f"s{i % 3}") for i in range(300)] + [(7, texts[7], "z"), (None, "alone here", "y")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(12).write.parquet(str(tmp_path / "docs"))
    results, cut = [], spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for first, second in (("128m", "4k"), ("4k", "128m")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", first)
            kept = minhash.keep_one(spark.read.parquet(str(tmp_path / "docs")))
            spark.conf.set("spark.sql.files.maxPartitionBytes", second)
            results.append(sorted(kept.collect(), key=str))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", cut)
    assert results[0] == results[1]
    assert len(results[0]) == len({r.doc_id for r in results[0]}) == 61
    assert all(r.doc_id is None or r.doc_id < 60 for r in results[0])
