import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

import corpus
from storeledger.llm import passages
from storeledger.llm.text import words as words_of


@pytest.fixture(scope="module")
def case():
    rng = random.Random(19)
    texts = [corpus.prose(rng, rng.randint(30, 400)) for _ in range(60)]
    shared = [corpus.prose(rng, n) for n in (55, 60, 120, 200)]
    planted = {}
    for i, passage in enumerate(shared):
        for copy in range(rng.randint(2, 6)):
            d = rng.randrange(0, 60)
            if any(d in held for held in planted.values()):
                continue
            cut = texts[d].split(" ")
            at = rng.randrange(len(cut))
            text = passage if copy < 2 else corpus.edited(rng, passage, 2)
            texts[d] = " ".join([*cut[:at], text, *cut[at:]])
            planted.setdefault(i, []).append(d)
    short = corpus.prose(rng, 30)
    texts[58] += " " + short
    texts[59] += " " + short
    texts += [texts[0], "", None, "again " * 200, corpus.prose(rng, 60) * 2]
    return texts, planted


def stretch(same, similarity=0.8):
    """Words of the longest stretch that begins and ends true and has `similarity` true, by trying all."""
    true = np.flatnonzero(same)
    if len(true) < 40:
        return 0
    count = np.arange(1, len(true) + 1)[None, :] - np.arange(len(true))[:, None]
    length = true[None, :] - true[:, None] + 1
    return int(np.where((count > 0) & (count >= similarity * length - 1e-9), length, 0).max())


def brute_documents(texts, min_words=50):
    """Documents that have a passage on one diagonal with some other, over all pairs."""
    ids = {}
    held = [np.array([ids.setdefault(w, len(ids)) for w in corpus.words(t)], np.int64) for t in texts]
    out = set()
    for d, mine in enumerate(held):
        for other, theirs in enumerate(held[:d]):
            for shift in range(min_words - len(theirs), len(mine) - min_words + 1):
                a, b = mine[max(shift, 0) :], theirs[max(-shift, 0) :]
                count = min(len(a), len(b))
                if {d, other} <= out or count < min_words:
                    continue
                if stretch(a[:count] == b[:count]) >= min_words:
                    out |= {d, other}
    return out


def changed(rng, text, places):
    parts = text.split(" ")
    for at in places:
        parts[at] = f"new{rng.randrange(10**6)}"
    return " ".join(parts)


@pytest.mark.parametrize(
    ("similarity", "spread", "size"), [*((s, k, 100) for s in (0.8, 0.85, 0.9) for k in ("even", "random")), (0.8, "random", 60)]
)
def test_recall_of_changed_passages(spark, tmp_path, similarity, spread, size):
    """100 pairs of passages with substituted words, each in texts of its own."""
    rng = random.Random(f"{similarity}{spread}")
    texts = []
    for _ in range(100):
        passage = " ".join(f"{corpus.word(rng)}{rng.randrange(99)}" for _ in range(size))
        wrong = round(size * (1 - similarity))
        places = [int((i + 0.5) * size / wrong) for i in range(wrong)] if spread == "even" else rng.sample(range(1, size - 1), wrong)
        for text in (passage, changed(rng, passage, places)):
            texts.append(f"{corpus.prose(rng, rng.randint(0, 60))} {text} {corpus.prose(rng, rng.randint(0, 60))}")
    docs = corpus.stored(spark, corpus.frame(spark, texts), tmp_path)
    rows = passages.repeated_passages(docs).collect()
    pairs = {r.doc_id // 2 for r in rows if r.doc_id // 2 == r.other_id // 2}
    assert len(pairs) >= 90, len(pairs)
    assert all(r.doc_id // 2 == r.other_id // 2 for r in rows)


def test_first_holders_of_pieces_hide_no_passage(spark, tmp_path):
    """Whatever the order, documents that hold pieces of a passage do not stand between those that hold all of it."""
    rng = random.Random(24)
    texts, whole = [], set()
    for _ in range(12):
        passage = corpus.prose(rng, 60).split()
        pieces = [passage[:35], passage[25:]] + [passage[at : at + 30] for at in range(0, 31, 6)]
        for part in [*pieces, passage, passage]:
            if part is passage:
                whole.add(len(texts))
            texts.append(" ".join([corpus.prose(rng, 20), *part, corpus.prose(rng, 20)]))
    docs = corpus.stored(spark, corpus.frame(spark, texts), tmp_path)
    assert {r.doc_id for r in passages.repeated_passages(docs).collect()} == whole == brute_documents(texts)


def test_one_word_over_and_over_is_no_passage(spark, tmp_path):
    rng = random.Random(25)
    texts = [" ".join([corpus.prose(rng, 30), *["de"] * n, corpus.prose(rng, 30)]) for n in (60, 90, 400)]
    shared = " ".join(word for word in corpus.prose(rng, 60).split() for _ in range(2))
    texts += [f"{corpus.prose(rng, 20)} {shared}", f"{shared} {corpus.prose(rng, 20)}"]
    docs = corpus.stored(spark, corpus.frame(spark, texts), tmp_path)
    assert {r.doc_id for r in passages.repeated_passages(docs).collect()} == {3, 4}


def test_file_splits_do_not_matter(spark, tmp_path, case):
    docs = corpus.stored(spark, corpus.frame(spark, case[0], parts=2), tmp_path / "a")
    wanted = sorted(map(str, passages.repeated_passages(docs).collect()))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert sorted(map(str, passages.repeated_passages(docs).collect())) == wanted
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_planted_passages_are_found_and_nothing_else(spark, tmp_path, case):
    texts, planted = case
    docs = corpus.stored(spark, corpus.frame(spark, texts, parts=4), tmp_path)
    rows = passages.repeated_passages(docs).collect()
    wanted = {d for held in planted.values() if len(held) > 1 for d in held}
    if len(corpus.words(texts[0])) >= 50:
        wanted |= {0, 60}
    assert {r.doc_id for r in rows} == wanted
    for r in rows:
        mine, theirs = corpus.words(texts[r.doc_id])[r.start : r.end], corpus.words(texts[r.other_id])[r.other_start : r.other_end]
        assert min(len(mine), len(theirs)) >= 50 and r.doc_id != r.other_id
        assert r.n_same >= 0.8 * r.n_words and r.n_same <= len(mine)
        assert corpus.jaccard(set(mine), set(theirs)) > 0.6
    assert wanted == brute_documents(texts)
    for held in planted.values():
        for d in held if len(held) > 1 else []:
            assert max(r.end - r.start for r in rows if r.doc_id == d) >= 50


def test_words_meet_once_for_each_pair(spark, tmp_path, monkeypatch):
    """However often a document holds a passage, a pair of documents is one row of the joins; no place of it is lost."""
    rng = random.Random(26)
    passage = corpus.prose(rng, 120)
    texts = [" ".join([corpus.prose(rng, 30), passage] * times) for times in (1, 1, 5, 5, 8)]
    ids = [None, 3, 4, 5, 6]
    docs = corpus.stored(spark, corpus.frame(spark, texts, ids), tmp_path)
    made, chained = [], passages._chains
    monkeypatch.setattr(passages, "_chains", lambda *args: made.append(chained(*args)) or made[-1])
    rows = passages.repeated_passages(docs).collect()
    assert {r.doc_id for r in rows} == set(ids)
    for chains in made:
        assert chains.count() == chains.select("doc", "other").distinct().count()
    assert sum(len(r.runs) for r in made[0].collect()) > made[0].count()
    held = {i: corpus.words(text) for i, text in zip(ids, texts)}
    for r in rows:
        mine, theirs = held[r.doc_id][r.start : r.end], held[r.other_id][r.other_start : r.other_end]
        assert min(len(mine), len(theirs)) >= 50 and corpus.jaccard(set(mine), set(theirs)) > 0.6
    times = {i: len(held[i]) // len(held[3]) for i in ids}
    first = max(ids, key=lambda i: sum(r.other_id == i for r in rows))
    assert all(len({r.start for r in rows if r.doc_id == i and r.other_id == first}) >= times[i] for i in ids if i != first and times[i] > 1)


def test_words_said_over_and_over_are_not_held_at_every_place(spark, tmp_path, monkeypatch):
    """A pair of words that many documents end in: few of its places are held, and all of them are found."""
    rng = random.Random(27)
    times = 400
    pairs = (f"{corpus.word(rng)}a {corpus.word(rng)}b" for _ in range(1000))
    # One whose seeds are of one hash, so that it stands alone.
    pair = next(p for p in pairs if len(set(passages.seeds(words_of(pa.array([f"{p} " * times])))[0].tolist())) == 1)
    shared = corpus.prose(rng, 12)
    endings = [f"{pair} " * times] * 20 + [f"{shared} " * 40] * 3
    texts = [f"{corpus.prose(rng, 30)} {ending}" for ending in endings] + [corpus.prose(rng, 80)]
    docs = corpus.stored(spark, corpus.frame(spark, texts), tmp_path)
    made, staged = [], passages.staged
    monkeypatch.setattr(passages, "staged", lambda df, *args: made.append(staged(df, *args)) or made[-1])
    rows = passages.repeated_passages(docs).collect()
    near, loose = [df for df in made if "after" in df.columns]
    most = 2 * passages.REACH + 4 * times // passages.CONTEXT
    for held in (near, loose):
        assert held.groupBy("doc", "hash").count().agg({"count": "max"}).first()[0] <= most < times
    assert {r.doc_id for r in rows} == set(range(len(endings)))
    assert len(rows) <= 2 * len(endings) * 3 * times // passages.MIN_WORDS
    for i in range(20):
        mine = corpus.words(texts[i])
        covered = {at for r in rows if r.doc_id == i for at in range(r.start, r.end)}
        assert covered >= set(range(30, len(mine)))


@pytest.mark.parametrize("seed", range(30))
def test_fewest_spans_cover_what_all_cover(seed):
    rng = np.random.default_rng(seed)
    start = rng.integers(0, 60, int(rng.integers(1, 9))).tolist()
    end = [s + int(n) for s, n in zip(start, rng.integers(1, 20, len(start)))]
    places = [set(range(s, e)) for s, e in zip(start, end)]
    covers = [c for n in range(len(start) + 1) for c in itertools.combinations(places, n) if set().union(*c) == set().union(*places)]
    got = passages.fewest(start, end)
    assert set().union(*(places[i] for i in got)) == set().union(*places)
    assert len(got) == len(covers[0])
    assert passages.fewest([], []) == set()


@pytest.mark.parametrize("period", [1, 2, 3, 7, 12, 24, 25, 40])
def test_places_left_out_are_within_a_run(period):
    """Any place left out has the words around it of the kept ones of its hash before and after, less than 48 words apart."""
    rng = np.random.default_rng(period)
    size = passages.CONTEXT
    marks = np.concatenate([rng.integers(1, 256, 60), np.tile(rng.integers(1, 256, period), 400 // period), rng.integers(1, 256, 60)])
    place = np.arange(size, len(marks) - size)
    sides = [marks[place[:, None] + step * np.arange(1, size + 1)] for step in (1, -1)]
    hashes, row = marks[place].astype(np.uint64), place * 0
    order = rng.permutation(len(place))
    kept = passages.told_apart(row[order], hashes[order], place[order], [side[order] for side in sides])
    assert (np.diff(kept) > 0).all()
    kept = set(order[kept].tolist())
    assert (len(kept) < len(place)) == (period < size / 2)
    around = np.hstack([hashes[:, None], *sides])
    for i in set(range(len(place))) - kept:
        alike = [j for j in kept if (around[j] == around[i]).all()]
        before, after = max(j for j in alike if j < i), min(j for j in alike if j > i)
        assert after - before < 2 * size


def test_empty_and_single_tables(spark, tmp_path):
    empty = corpus.stored(spark, corpus.frame(spark, []), tmp_path / "a")
    assert passages.repeated_passages(empty).collect() == []
    rng = random.Random(20)
    one = corpus.stored(spark, corpus.frame(spark, [corpus.prose(rng, 100)] * 3, [5, 5, None]), tmp_path / "b")
    rows = passages.repeated_passages(one).collect()
    assert {(r.start, r.end) for r in rows} == {(0, 100)} and {r.doc_id for r in rows} == {5, None}


def naive_best(x, y, seed, gap):
    score = [0.0] * len(x)
    for j in sorted(range(len(x)), key=lambda j: (x[j], y[j])):
        before = [score[i] - gap * (x[j] - x[i] + y[j] - y[i]) for i in range(len(x)) if x[i] < x[j] and y[i] < y[j]]
        score[j] = seed + max([0.0, *before])
    return max(score)


@pytest.mark.parametrize("seed", range(30))
def test_best_chain_is_the_best_of_all(seed):
    rng = np.random.default_rng(seed)
    count = int(rng.integers(2, 40))
    x, y = rng.integers(0, 80, count), rng.integers(0, 80, count)
    found = passages.chains(x, y, 8, 0.1)
    for xs, ys in found:
        assert all(np.diff(xs) > 0) and all(np.diff(ys) > 0)
    worth = [8 * len(xs) - 0.1 * (xs[-1] - xs[0] + ys[-1] - ys[0]) for xs, ys in found]
    best = naive_best(x.tolist(), y.tolist(), 8, 0.1)
    assert best <= 8 or abs(max(worth) - best) < 1e-9


def test_alignment_spans_changes_and_gaps():
    rng = random.Random(22)
    a = np.array([rng.randrange(10**6) for _ in range(100)])
    b = np.concatenate([a[:30], [-1, -2], a[30:60], a[63:]])
    b[10] = -3
    got = passages.align(a, b, np.array([12, 20, 40, 70]), np.array([12, 20, 42, 69]))
    assert got[:4] == (0, 100, 0, 99)
    assert got[5] == 96


@pytest.mark.parametrize("seed", range(20))
def test_longest_stretch_is_the_longest(seed):
    same = np.random.default_rng(seed).random(120) < 0.7 + seed / 100
    low, high = passages.longest(same, 0.8)
    assert same[low] and same[high] and same[low : high + 1].mean() >= 0.8 - 1e-9
    assert high - low + 1 == stretch(same)
