"""The stages over a made-up corpus, each against what it should keep."""

import random
import zlib

import pytest

import corpus

pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def corpus_root(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    rng = random.Random(23)
    item = corpus.prose(rng, 40)
    texts, kinds = [], []
    for i in range(240):
        kind = rng.choice(["good"] * 12 + ["junk", "junk", "copy", "near", "leak"])
        if kind in ("copy", "near") and "good" in kinds:
            at = rng.choice([j for j, k in enumerate(kinds) if k == "good"])
            text = texts[at] if kind == "copy" else corpus.word(rng) + " " + texts[at]
            kind = f"{kind} {at}"
        elif kind == "junk":
            text = "\n".join(" ".join(corpus.word(rng).upper() + "!!" for _ in range(20)) for _ in range(4))
        else:
            text = "\n".join(corpus.prose(rng, 30) for _ in range(4)) + ("\n" + item if kind == "leak" else "")
            kind = kind if kind == "leak" else "good"
        texts.append(text + ("\nall rights reserved here" if i % 2 and " " not in kind else ""))
        kinds.append(kind)
    docs = corpus.frame(spark, texts, sources=["s"] * len(texts))
    docs.write.parquet(f"{root}/documents.parquet")
    labels = [(i, int(k != "junk"), 0) for i, k in enumerate(kinds) if i % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root), texts, kinds


def test_stages_in_order(spark, corpus_root):
    root, texts, kinds = corpus_root
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    results = {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, root).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        results[name] = docs.collect()
        assert name == "packing" or docs.columns == columns

    ids = {name: {r.doc_id for r in rows} for name, rows in results.items()}
    assert ids["quality"] == {i for i, k in enumerate(kinds) if k != "junk"}
    assert ids["line_dedup"] == ids["quality"]
    assert not any("all rights" in r.text for r in results["line_dedup"])
    groups = corpus.groups(len(kinds), [(i, int(k.split()[1])) for i, k in enumerate(kinds) if " " in k])
    assert ids["near_dedup"] == {min(g) for g in groups if min(g) in ids["quality"]}
    assert ids["decontamination"] == {i for i in ids["near_dedup"] if kinds[i] != "leak"}
    assert ids["packing"] == ids["decontamination"]
    tokens = {}
    for r in results["packing"]:
        tokens.setdefault(r.doc_id, [0, r.doc_tokens])[0] += r.length
    assert all(got == whole for got, whole in tokens.values())


def test_run_gives_the_last_stage(spark, corpus_root):
    root, _, kinds = corpus_root
    rows = pipeline.run(spark, root).collect()
    assert rows and {r.doc_id for r in rows} <= {i for i, k in enumerate(kinds) if k not in ("junk", "leak")}
    assert all(zlib.crc32(b"") <= r.ids_crc32 < 1 << 32 for r in rows)


def test_one_of_two_partners_in_full_buckets_stays(spark, tmp_path):
    """Most of each text is one passage, so that all buckets are large; each text has one partner a little nearer than the rest."""
    rng = random.Random(32)
    passage, texts = corpus.prose(rng, 204), []
    for _ in range(100):
        shared = corpus.prose(rng, 7)
        texts += [f"{passage} {shared} {corpus.prose(rng, 21)}" for _ in range(2)]
    docs = corpus.stored(spark, corpus.frame(spark, texts, parts=4), tmp_path)
    kept = pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == list(range(0, 200, 2))
