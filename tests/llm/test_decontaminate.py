import itertools
import random

import numpy as np
import pytest

import corpus
from storeledger.llm import decontaminate

ITEM_SCHEMA = "item_id long, text string"


def changed(rng, text, every):
    parts = text.split(" ")
    for at in range(every // 2, len(parts), every):
        parts[at] = corpus.word(rng) + "zz"
    return " ".join(parts)


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(6)
    items = [corpus.prose(rng, n) for n in (15, 20, 30, 40, 60)] + ["too short", "", None]
    texts = [corpus.prose(rng, rng.randint(20, 300)) for _ in range(80)]
    planted = {}
    for d, (i, every) in {3: (0, 99), 10: (1, 99), 11: (2, 12), 12: (3, 9), 13: (4, 8), 14: (4, 99), 15: (2, 99)}.items():
        cut = texts[d].split(" ")
        texts[d] = " ".join([*cut[:10], changed(rng, items[i], every).upper(), *cut[10:]])
        planted[d] = i
    texts += [texts[14], None, "", items[3]]
    planted |= {80: 4, 83: 3}
    docs = corpus.frame(spark, texts)
    tests = spark.createDataFrame(list(enumerate(items)), ITEM_SCHEMA)
    return texts, items, docs, tests, planted


def brute(texts, items):
    """Every alignment of every pair, without seeds."""
    out = set()
    for d, text in enumerate(texts):
        doc = np.array([hash(w) for w in corpus.words(text)])
        for i, item in enumerate(items):
            test = np.array([hash(w) for w in corpus.words(item)])
            for shift in range(-len(test) + 1, len(doc)):
                best = decontaminate.best_stretch(doc, test, shift)
                if best and best[2] >= min(13, len(test)) and best[4] >= 0.8 and len(test) >= 9:
                    out.add((d, i, best[0], best[2], best[3]))
    return out


def test_finds_what_all_alignments_find(case):
    texts, items, docs, tests, planted = case
    got = decontaminate.find_overlaps(docs, tests).collect()
    found = {(r.doc_id, r.item_id, r.doc_start, r.n_words, r.n_same) for r in got}
    assert found == brute(texts, items)
    assert {(d, i) for d, i, *_ in found} == set(planted.items())


def test_drops_contaminated_rows_only(case):
    texts, _, docs, tests, planted = case
    kept = decontaminate.drop_contaminated(docs.withColumnRenamed("source", "_text_a"), tests)
    assert kept.columns == ["doc_id", "text", "lang", "_text_a", "n_chars"]
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - set(planted)


def test_empty_sides(spark, case):
    _, _, docs, tests, _ = case
    assert decontaminate.find_overlaps(docs, tests.limit(0)).collect() == []
    assert decontaminate.find_overlaps(docs.limit(0), tests).collect() == []
    assert decontaminate.drop_contaminated(docs, tests.limit(0)).count() == docs.count()


def test_masks_tolerate_a_change_at_ignored_places():
    for mask in decontaminate.MASKS:
        assert mask[0] == 0 and len(mask) == 7 and len(set(range(mask[-1] + 1)) - set(mask)) >= 2


def all_longest(doc, item):
    """Places, length and equal words of each longest stretch, by trying every start and end of every alignment."""
    out = set()
    for shift in range(-len(item) + 1, len(doc)):
        same = [0 <= j + shift < len(doc) and doc[j + shift] == item[j] for j in range(len(item))]
        held = [
            (a, b)
            for a in range(len(item))
            for b in range(a + min(13, len(item)), len(item) + 1)
            if same[a] and same[b - 1] and sum(same[a:b]) * 5 >= (b - a) * 4
        ]
        for a, b in held:
            if not any(c <= a and b <= d and (a, b) != (c, d) for c, d in held):
                out.add((a + shift, a, b - a, sum(same[a:b])))
    return out


def test_finds_every_stretch_that_meets_the_rule(spark):
    """Adjacent and spread changes, two passages on one alignment, items of every small length."""
    rng = random.Random(31)
    fresh = iter(range(10**6))
    items, texts, origin = [], [], []

    def plant(length, gone):
        item = [f"w{next(fresh)}" for _ in range(length)]
        copy = [f"x{next(fresh)}" if i in gone else w for i, w in enumerate(item)]
        around = [[f"y{next(fresh)}" for _ in range(rng.randint(0, 6))] for _ in range(2)]
        origin.append((around[0] + copy + around[1], item))
        texts.append(" ".join(origin[-1][0]))
        items.append(" ".join(item))

    for length, gone in ((15, (6, 7)), (21, (9, 10, 11)), (28, (12, 13, 14, 15)), (15, (3, 7, 11)), (60, tuple(range(20, 40)))):
        plant(length, gone)
    for length in range(1, 13):
        plant(length, ())
        plant(length, rng.sample(range(1, length - 1), length // 5) if length > 4 else ())
        plant(length, rng.sample(range(1, length - 1), length // 5 + 1) if length > 4 else (0,))
    for length in range(13, 31):
        for _ in range(6):
            plant(length, rng.sample(range(length), length // 5))
    found = decontaminate.find_overlaps(corpus.frame(spark, texts), spark.createDataFrame(list(enumerate(items)), ITEM_SCHEMA)).collect()
    got = {(r.doc_id, r.item_id, r.doc_start, r.item_start, r.n_words, r.n_same) for r in found}
    wanted = {(i, i, *stretch) for i, (doc, item) in enumerate(origin) for stretch in all_longest(doc, item)}
    assert got == wanted and len(found) == len(got)
    assert {0, 1, 2, 3} <= {d for d, *_ in got} and sum(d == 4 for d, *_ in got) == 2


def test_masks_hit_every_stretch_of_thirteen_words_with_a_fifth_changed():
    for length in range(13, 20):
        for gone in itertools.combinations(range(length), length // 5):
            assert any(
                all(at + p not in gone for p in mask) for mask in decontaminate.MASKS for at in range(length - mask[-1])
            ), gone
