"""Source mixing: shares, schedule and pieces against brute force."""

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import corpus
import pytest
from pyspark.sql import functions as F
from storeledger.llm import mixing


def targets(sizes, weights=(3, 1, 2), share=Fraction(3, 2), passes=2):
    """Shares by the rule in its own words: give by weight, stop at the bound, reshare, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = {}, share * sum(sizes.values())
    while True:
        left = [s for s in names if s not in full]
        if not left:
            return full
        level = (total - sum(full.values())) / sum(weight[s] for s in left)
        above = [s for s in left if level * weight[s] > passes * sizes[s]]
        if not above:
            return full | {s: level * weight[s] for s in left}
        full |= {s: Fraction(passes * sizes[s]) for s in above}


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def docs(spark):
    rng = corpus.random.Random(5)
    texts = [corpus.prose(rng, rng.choice([1, 3, 20, 90, 400])) for _ in range(150)]
    texts += [None, "", " \t\n", "a\x85b c d\x0be", "x " * 5000, "same text"] + ["same text"] * 3
    sources = [rng.choice(["big"] * 6 + ["Zed", "é", "tiny2", None]) for _ in texts]
    sources[3] = "one"
    texts[3] = "a few words"
    ids = [*range(len(texts) - 4), None, 7, 7, 7]
    return corpus.frame(spark, texts, ids, sources)


@pytest.mark.parametrize("block", [7, 64, 1024])
def test_mix_against_brute_force(spark, docs, block):
    rows = docs.collect()
    sizes = defaultdict(int)
    for row in rows:
        sizes[row.source] += len(words_of(row.text))
    want = targets(sizes)
    mixed = mixing.mix(docs, block=block)

    sources = {r.source: r for r in mixed.sources.collect()}
    assert {s: r.source_size for s, r in sources.items()} == dict(sizes)
    for name, row in sources.items():
        assert row.target == pytest.approx(float(want[name]), rel=1e-12)

    # Every row is there, and what the mix takes of a source is its target, whole blocks in an order drawn from the text.
    found = mixing.words_taken(mixed).collect()
    assert sorted((str(r.key), r.size) for r in found) == sorted((str(r.doc_id), len(words_of(r.text))) for r in rows)
    assert all(0 <= r.taken <= 2 * r.size for r in found)
    pieces = mixed.pieces.collect()
    by_source = defaultdict(list)
    for piece in pieces:
        by_source[piece.source_no].append(piece)
    for row in sources.values():
        own = by_source[row.source_no]
        assert sum(p.length for p in own) == row.words
        blocks = Counter()
        for piece in own:
            blocks[piece.block] += piece.length
        full, rest = divmod(row.words, block)
        assert blocks == Counter({b: block for b in range(full)} | ({full: rest} if rest else {}))
        slots = dict((p.slot, p.block) for p in own)
        assert [slots[s] for s in sorted(slots)] == list(range(len(slots)))
    drawn = defaultdict(int)
    for name, row in sources.items():
        at, mine = 0, [r for r in rows if r.source == name and words_of(r.text)]
        for turn in "01":
            marks = []
            for r in mine:
                mark = f"{'' if r.doc_id is None else r.doc_id}|{hashlib.md5(r.text.encode()).hexdigest()}"
                inner = hashlib.md5(mark.encode()).hexdigest()
                marks.append((hashlib.md5(f"{turn}:{inner}".encode()).hexdigest(), len(words_of(r.text)), str(r.doc_id)))
            for _, size, key in sorted(marks):
                drawn[key, size] += max(0, min(at + size, row.words) - at)
                at += size
    taken = defaultdict(int)
    for r in found:
        taken[str(r.key), r.size] += r.taken
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in drawn.items() if v}


def test_schedule_is_even(spark):
    counts = {0: 700, 1: 1, 2: 0, 3: 299, 4: 24}
    rows, first = [], 0
    for n, blocks in counts.items():
        rows.append((n, blocks, first))
        first += blocks
    sources = spark.createDataFrame(rows, "source_no int, blocks long, first long")
    made = mixing.schedule(sources).orderBy("slot").collect()
    assert Counter(r.source_no for r in made) == Counter({k: v for k, v in counts.items() if v})
    seen, at = Counter(), 0
    for i, row in enumerate(made, 1):
        assert row.block == seen[row.source_no] and row.slot > at - 1
        seen[row.source_no] += 1
        at = row.slot
        for n, blocks in counts.items():
            assert abs(seen[n] - i * blocks / first) <= 6  # the discrepancy of the sequence, log2 of its length at most


def test_rerun_over_other_partitions_agrees(spark, docs):
    a = mixing.words_taken(mixing.mix(docs.repartition(7)))
    b = mixing.words_taken(mixing.mix(docs.coalesce(1).orderBy(F.desc("text"))))
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_one_source_with_a_third_and_equal_rows(spark):
    texts = ["w " * 10] * 300 + [f"word{i} " * (i % 9) for i in range(600)]
    docs = corpus.frame(spark, texts, [1] * 300 + list(range(600)), ["hot"] * 300 + [f"s{i % 40}" for i in range(600)])
    mixed = mixing.mix(docs)
    sums = mixed.pieces.groupBy("source_no").agg(F.sum("length").alias("got"))
    assert mixed.sources.join(sums, "source_no", "left").where("coalesce(got, 0) <> words").count() == 0
    assert mixing.words_taken(mixed).count() == 900


def test_edge_tables(spark):
    empty = mixing.words_taken(mixing.mix(corpus.frame(spark, [])))
    assert empty.columns == ["key", "size", "source_size", "target", "taken"] and empty.collect() == []
    blank = mixing.words_taken(mixing.mix(corpus.frame(spark, [None, "", " "]))).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 3
    clash = corpus.frame(spark, ["a b", "c"]).withColumns({c: F.lit(1) for c in ("place", "size", "target", "slot", "mark", "key")})
    assert {r.size for r in mixing.words_taken(mixing.mix(clash)).collect()} == {1, 2}


def test_only_dataframe_operations(spark, docs, capsys):
    mixing.words_taken(mixing.mix(docs)).explain()
    plan = capsys.readouterr().out
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
