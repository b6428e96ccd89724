import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus
from storeledger.llm import quality


def junk(rng, words):
    kind = rng.randrange(3)
    if kind == 0:
        return " ".join(corpus.word(rng).upper() + "!!" for _ in range(words))
    if kind == 1:
        return " | ".join(corpus.word(rng) for _ in range(words))
    return " ".join(corpus.word(rng) + rng.choice(["$$$", "***", "###"]) for _ in range(words))


def labelled(spark, count=400):
    rng = random.Random(7)
    good = [rng.random() < 0.7 for _ in range(count)]
    texts = []
    for ok in good:
        body = "\n".join(corpus.prose(rng, rng.randint(4, 30)) if ok else junk(rng, rng.randint(4, 30)) for _ in range(rng.randint(1, 6)))
        texts.append(body if ok or rng.random() < 0.6 else corpus.prose(rng, 5) + "\n" + body)
    labels = spark.createDataFrame([(i, int(ok), 0) for i, ok in enumerate(good)], "doc_id long, quality int, toxic int")
    return texts, good, corpus.frame(spark, texts), labels


def test_marginals_match_all_labellings():
    rng = np.random.default_rng(0)
    emit, links = rng.normal(size=9), rng.normal(size=(2, 2))
    first = np.array([0, 1, 5, 9])
    good, pairs = quality.marginals(emit, links, first)
    expected, counted = np.zeros(9), np.zeros((2, 2))
    for a, b in zip(first[:-1], first[1:]):
        total, held, seen = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=int(b - a)):
            weight = np.exp(sum(emit[a + i] for i, y in enumerate(path) if y) + sum(links[x, y] for x, y in itertools.pairwise(path)))
            total += weight
            held += weight * np.array(path)
            for x, y in itertools.pairwise(path):
                seen[x, y] += weight
        expected[a:b] = held / total
        counted += seen / total
    assert np.allclose(good, expected) and np.allclose(pairs, counted)


def test_lines_and_their_lengths():
    texts = ["a b\n\nc.\n", "", None, "\n", "ÉÉ!!\nx"]
    lines = quality.line_features(pa.array(texts))
    assert np.diff(lines.first).tolist() == [4, 1, 1, 2, 2]
    assert lines.weight.tolist() == [len(x.encode()) + 1 for t in texts for x in (t or "").split("\n")]
    alone = np.concatenate([quality.line_features(pa.array([t], pa.string())).features for t in texts])
    assert np.allclose(lines.features, alone)


def test_held_out_accuracy(spark):
    texts, good, docs, labels = labelled(spark)
    model = quality.train(docs.where(~quality.held_out()), labels)
    rows = quality.score(docs, model).withColumn("held_out", quality.held_out()).collect()
    assert {r.doc_id for r in rows if r.held_out} == {i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(0 <= r.score <= 1 for r in rows)
    right = [(r.score >= 0.7) == good[r.doc_id] for r in rows if r.held_out]
    assert np.mean(right) > 0.95


def test_score_depends_on_the_text_alone(spark):
    texts, _, docs, labels = labelled(spark)
    model = quality.train(docs, labels)
    odd = [None, "", "\n\n", "one", "long " * 40_000, texts[0], texts[0]]
    rows = quality.score(corpus.frame(spark, odd, [None, *range(6)]).withColumn("score", F.lit("x")), model)
    assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
    got = {}
    for r in rows.collect():
        assert got.setdefault(r.text or "", r.score) == r.score
    again = quality.score(docs, model).where("doc_id = 0").first()
    assert np.isclose(again.score, got[texts[0]])
    assert quality.score(docs.limit(0), model).collect() == []


def test_labels_may_repeat_or_be_null(spark):
    _, good, docs, labels = labelled(spark)
    messy = labels.union(labels).union(labels.withColumn("quality", F.lit(None).cast("int")))
    a, b = quality.train(docs, labels), quality.train(docs, messy)
    assert np.allclose(a.weights, b.weights)
    kept = {r.doc_id for r in quality.keep_good(docs, labels).collect()}
    assert np.mean([(i in kept) == ok for i, ok in enumerate(good)]) > 0.95


def test_nothing_to_learn_from(spark):
    docs, labels = corpus.frame(spark, []), spark.createDataFrame([], "doc_id long, quality int")
    assert quality.train(docs, labels) is None
    assert quality.keep_good(docs, labels).collect() == []
    some = corpus.frame(spark, ["a text", None])
    assert [r.score for r in quality.score(some, quality.train(some, labels)).collect()] == [0.5, 0.5]
    assert quality.keep_good(some, labels).count() == 2


def test_ids_of_any_type_and_a_bound_on_the_text_drawn(spark):
    rng = corpus.random.Random(1)
    texts = [corpus.prose(rng, 60) if i % 2 else "x1 ## 99 !! ..\n" * 20 for i in range(60)]
    docs = corpus.frame(spark, texts)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    text_ids, text_labels = (df.withColumn("doc_id", F.concat(F.lit("id"), "doc_id")) for df in (docs, labels))
    model = quality.train(text_ids, text_labels)
    found = quality.score(text_ids, model).collect()
    assert all((r.score > 0.5) == bool(int(r.doc_id[2:]) % 2) for r in found)
    assert quality.train(docs, labels, sample_bytes=10) is None
    assert quality.train(docs, labels, sample_bytes=2000) is not None
