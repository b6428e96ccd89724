import random

import numpy as np
import pyarrow as pa
import pytest

import corpus
from storeledger.llm import text

TEXTS = ["", None, "One two", "one TWO three four five six", "ünïcode Größe 12 ab12", "  .. !", "a\nb\tc", "x" * 10_000, "tail.", "tail"]


def found_words(texts):
    found = text.words(pa.array(texts, pa.string()))
    return [[(found.hashes[i]) for i in np.flatnonzero(found.doc == d)] for d in range(len(texts))]


def test_words_are_runs_of_letters_and_digits():
    for hashes, given in zip(found_words(TEXTS), TEXTS):
        assert len(hashes) == len(corpus.words(given))


def test_equal_words_have_equal_hashes_and_others_do_not():
    rng = random.Random(1)
    texts = [corpus.prose(rng, 300) for _ in range(20)]
    seen = {}
    for hashes, given in zip(found_words(texts), texts):
        for value, word in zip(hashes, corpus.words(given)):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("size", [3, 5])
def test_shingles_match_word_tuples(size):
    rng = random.Random(2)
    texts = [corpus.prose(rng, n) for n in (0, 1, 2, 4, 5, 6, 40)] + ["same same same same same same same", None]
    hashes, doc = text.shingles(text.words(pa.array(texts, pa.string())), size)
    assert (np.diff(doc) >= 0).all()
    for d, given in enumerate(texts):
        assert len(set(hashes[doc == d].tolist())) == len(corpus.shingle_set(given, size))


def test_slices_cover_all_rows_in_order():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a" * n for n in (0, 5, 100, 3, 3, 50)] + [None], pa.string())})
    parts = list(text.slices(batch, limit=10))
    assert pa.Table.from_batches(parts).column("text").to_pylist() == batch.column("text").to_pylist()
    assert max(sum(len(x or "") for x in p.column("text").to_pylist()) for p in parts if p.num_rows > 1) <= 10


def test_words_of_a_slice_of_a_batch():
    whole = pa.array(["skip me", "keep these words", "and these"])
    assert found_words(whole.slice(1).to_pylist()) == [
        [text.words(whole.slice(1)).hashes[i] for i in np.flatnonzero(text.words(whole.slice(1)).doc == d)] for d in range(2)
    ]
