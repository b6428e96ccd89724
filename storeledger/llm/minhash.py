"""Near-duplicate documents by improved consistent weighted sampling of TF-IDF shingles, banded and verified."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm.graph import components
from storeledger.llm.store import filter_bits, free_names, key_filter, maybe_in, small, staged
from storeledger.llm.text import lists, mixed, shingles, slices, words

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 4
FREQUENT = 1 / 64  # documents' share from which on a shingle weighs less
RARE_WEIGHT = 1.5  # of a shingle below that share; one that all documents have weighs 1
LIGHT = 96.0  # weight up to which a text's samples are drawn from all of its shingles
UNIT = 1_000_000  # shingles that are counted together in a task
_FILTER_BITS = 20


class Idf(NamedTuple):
    """Inverse document frequency: 1.5 up to a share of 1/64 of the documents, falling with the share's logarithm to 1."""

    hashes: np.ndarray  # of the frequent shingles, ascending
    weights: np.ndarray
    bitmap: np.ndarray

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), RARE_WEIGHT)
        at = np.flatnonzero(maybe_in(self.bitmap, hashes, _FILTER_BITS))
        place = np.minimum(np.searchsorted(self.hashes, hashes[at]), max(len(self.hashes) - 1, 0))
        if len(self.hashes):
            hit = self.hashes[place] == hashes[at]
            out[at[hit]] = self.weights[place[hit]]
        return out


class Bag(NamedTuple):
    """The distinct shingles of a slice's texts, by text and hash, and how often each occurs in its text."""

    hashes: np.ndarray
    doc: np.ndarray
    times: np.ndarray

    @staticmethod
    def of(texts: pa.Array, size: int) -> Bag:
        hashes, doc = shingles(words(texts), size)
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        first = np.ones(len(hashes), bool)
        first[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(first)
        return Bag(hashes[at], doc[at], np.diff(np.append(at, len(hashes))))

    def weights(self, idf: Idf) -> np.ndarray:
        return idf(self.hashes) * (1 + np.log(self.times))


def document_frequencies(docs: DataFrame, size: int = SHINGLE_WORDS, share: float = FREQUENT) -> Idf:
    """Weights of the shingles that at least `share` of all documents have, from exact counts over all of them.

    There are at most (mean shingles of a document) / share of these, so they fit the driver whatever the corpus. First
    each task reports, for each unit of documents, the shingles that reach the share there. A shingle that is frequent in
    all must be so in some unit, and what a silent unit may add is known, so the sums leave few candidates. Then these are
    counted in all documents.
    """
    texts = docs.select("text")
    reported = staged(texts.mapInArrow(_Counts(size, share, None), "hash long, excess long, docs long, slack long"))
    totals = reported.where(F.col("hash").isNull()).agg(F.sum("docs").alias("docs"), F.sum("slack").alias("slack")).first()
    total = totals["docs"] or 0
    need = share * total
    candidates = (
        reported.where(F.col("hash").isNotNull())
        .groupBy("hash")
        .agg(F.sum("excess").alias("excess"))
        .where(F.col("excess") >= need - (totals["slack"] or 0))
    )
    bitmap = key_filter(staged(candidates), "hash", _FILTER_BITS)
    counted = texts.mapInArrow(_Counts(size, 0.0, bitmap), "hash long, excess long, docs long, slack long")
    frequent = (
        counted.where(F.col("hash").isNotNull()).groupBy("hash").agg(F.sum("excess").alias("count")).where(F.col("count") >= need)
    ).toPandas()
    hashes = frequent["hash"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    counts = frequent["count"].to_numpy(np.float64)[order]
    rarity = np.log(max(total, 1) / np.maximum(counts, 1)) / np.log(1 / share)
    weights = 1 + (RARE_WEIGHT - 1) * np.clip(rarity, 0, 1)
    kept = docs.sparkSession.createDataFrame(frequent[["hash"]].astype("int64"), "hash long")
    return Idf(hashes[order], weights, key_filter(kept, "hash", _FILTER_BITS))


class _Counts:
    """For each unit the documents that hold a shingle, less the count up to which the unit is silent about it."""

    def __init__(self, size: int, share: float, bitmap: np.ndarray | None) -> None:
        self.size, self.share, self.bitmap = size, share, bitmap

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, docs = [], 0, 0
        for batch in batches:
            for part in slices(batch):
                found = Bag.of(part.column("text"), self.size).hashes
                if self.bitmap is not None:
                    found = found[maybe_in(self.bitmap, found, _FILTER_BITS)]
                held.append(found)
                count, docs = count + len(found), docs + part.num_rows
                if count >= UNIT:
                    yield self._report(held, docs)
                    held, count, docs = [], 0, 0
        if docs:
            yield self._report(held, docs)

    def _report(self, held: list[np.ndarray], docs: int) -> pa.RecordBatch:
        hashes, counts = np.unique(np.concatenate(held), return_counts=True)
        slack = max(0, int(np.ceil(self.share * docs)) - 1)
        loud = counts > slack
        hash_column = pa.array(np.append(hashes[loud].view(np.int64), 0), mask=np.append(np.zeros(loud.sum(), bool), True))
        nothing = np.zeros(int(loud.sum()), np.int64)
        columns = [hash_column, np.append(counts[loud] - slack, 0), np.append(nothing, docs), np.append(nothing, slack)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["hash", "excess", "docs", "slack"])


_SALTS = mixed(np.arange(1, 2 * BANDS * ROWS + 64, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _draw(hashes: np.ndarray, log_weight: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Improved consistent weighted sampling: the key whose smallest value is drawn, and what a draw of each shingle is.

    From a shingle's hash come r and c, both Gamma(2, 1), and beta, uniform. With t = floor(ln w / r + beta) the shingle's
    key is c / (y e^r) for ln y = r (t - beta); two texts draw the same (shingle, t) with the probability of their weighted
    Jaccard similarity.
    """
    x, z = mixed(hashes ^ _SALTS[2 * sample]), mixed(hashes ^ _SALTS[2 * sample + 1])
    low, top = np.uint64(0xFFFFFF), np.uint64(40)
    tiny = 2.0**-24

    def unit(bits: np.ndarray) -> np.ndarray:
        return (bits.astype(np.float64) + 0.5) * tiny

    r = -np.log(unit(x >> top) * unit(x & low))
    beta = (((x >> np.uint64(24)) & np.uint64(0xFFFF)) << np.uint64(16) | ((z >> np.uint64(24)) & np.uint64(0xFFFF))).astype(np.float64)
    beta *= 2.0**-32
    t = np.floor(log_weight / r + beta)
    key = np.log(-np.log(unit(z >> top) * unit(z & low))) - r * (t - beta + 1)
    return key, mixed(hashes + t.astype(np.int64).view(np.uint64) * _ODD)


def light_samples(bag: Bag, log_weight: np.ndarray, count: int) -> np.ndarray:
    """ROWS x BANDS samples of each of `count` texts, each drawn from all shingles of the text."""
    out = np.zeros((count, ROWS, BANDS), np.uint64)
    if not len(bag.hashes):
        return out
    first = np.flatnonzero(np.append(True, bag.doc[1:] != bag.doc[:-1]))
    rows, runs = bag.doc[first], np.diff(np.append(first, len(bag.doc)))
    for sample in range(ROWS * BANDS):
        key, drawn = _draw(bag.hashes, log_weight, sample)
        least = np.flatnonzero(key == np.repeat(np.minimum.reduceat(key, first), runs))
        out[bag.doc[least], sample // BANDS, sample % BANDS] = drawn[least]
    return out


def heavy_samples(bag: Bag, log_weight: np.ndarray, count: int) -> np.ndarray:
    """ROWS x BANDS samples of each text: in each of ROWS rounds the shingles are dealt to BANDS bins, and each bin draws one.

    An empty bin takes the draw of another bin of its round, in an order that is the same for all texts.
    """
    out = np.zeros((count, ROWS, BANDS), np.uint64)
    for row in range(ROWS):
        key, drawn = _draw(bag.hashes, log_weight, row)
        cell = bag.doc * BANDS + (mixed(bag.hashes + _SALTS[-1 - row]) % np.uint64(BANDS)).astype(np.int64)
        least = np.full(count * BANDS, np.inf)
        np.minimum.at(least, cell, key)
        hit = key == least[cell]
        value = np.zeros(count * BANDS, np.uint64)
        value[cell[hit]] = drawn[hit]
        full = np.isfinite(least).reshape(count, BANDS)
        value = value.reshape(count, BANDS)
        orders = np.random.default_rng(row).permuted(np.tile(np.arange(BANDS), (BANDS, 1)), axis=1)
        empty = ~full & full.any(1)[:, None]
        text, band = np.nonzero(empty)
        for step in range(BANDS):
            if not len(text):
                break
            source = orders[band, step]
            found = full[text, source]
            value[text[found], band[found]] = value[text[found], source[found]]
            text, band = text[~found], band[~found]
        out[:, row] = value
    return out


def _band_keys(samples: np.ndarray, scheme: int) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(2) + np.uint64(scheme)
    keys = np.repeat(mixed(keys + _ODD), len(samples), 0)
    return reduce(lambda acc, row: mixed(acc ^ samples[:, row]) * _ODD + acc, range(ROWS), keys)


class _Signatures:
    """The band keys of each text.

    Texts that weigh at most LIGHT have keys of one kind, texts that weigh at least 0.7 LIGHT keys of the other. Of two
    texts alike enough the lighter weighs more than 0.7 of the heavier, so they have a kind in common.
    """

    def __init__(self, size: int, idf: Idf) -> None:
        self.size, self.idf = size, idf

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield self._signed(part)

    def _signed(self, part: pa.RecordBatch) -> pa.RecordBatch:
        count = part.num_rows
        bag = Bag.of(part.column("text"), self.size)
        weights = bag.weights(self.idf)
        total = np.bincount(bag.doc, weights, count)
        keys, owner = [], []
        kinds = ((total > 0) & (total <= LIGHT), light_samples), (total >= 0.7 * LIGHT, heavy_samples)
        for scheme, (chosen, draw) in enumerate(kinds):
            rows = np.flatnonzero(chosen)
            inside = chosen[bag.doc]
            part_bag = Bag(bag.hashes[inside], np.searchsorted(rows, bag.doc[inside]), bag.times[inside])
            samples = draw(part_bag, np.log(weights[inside]), len(rows))
            keys.append(_band_keys(samples, scheme).ravel())
            owner.append(np.repeat(rows, BANDS))
        keys, owner = np.concatenate(keys), np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        bands = lists(keys[order].view(np.int64), owner[order], count)
        kept = part.select(["doc_id", "text_a", "text_b"])
        return pa.RecordBatch.from_arrays([*kept.columns, bands], [*kept.schema.names, "bands"])


class _Bags:
    """Shingles and weights of the texts whose fingerprint may be in the bitmap, as sorted arrays in two byte strings."""

    def __init__(self, size: int, idf: Idf, bitmap: np.ndarray, bits: int) -> None:
        self.size, self.idf, self.bitmap, self.bits = size, idf, bitmap, bits

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["text_a", "text_b", "shingles", "weights"]
        for batch in batches:
            wanted = maybe_in(self.bitmap, batch.column("text_a").to_numpy(zero_copy_only=False).view(np.uint64), self.bits)
            for part in slices(batch.filter(pa.array(wanted))):
                bag = Bag.of(part.column("text"), self.size)
                short = (bag.hashes >> np.uint64(32)).astype(np.uint32)
                weights = bag.weights(self.idf).astype(np.float32)
                at = np.searchsorted(bag.doc, np.arange(part.num_rows + 1))
                cut = list(zip(at[:-1], at[1:]))
                made = [pa.array([x[a:b].tobytes() for a, b in cut], pa.binary()) for x in (short, weights)]
                yield pa.RecordBatch.from_arrays([*part.select(["text_a", "text_b"]).columns, *made], names)


def jaccard(a: np.ndarray, a_weights: np.ndarray, b: np.ndarray, b_weights: np.ndarray) -> tuple[float, float]:
    """Weighted and plain Jaccard similarity of two sorted arrays of shingles."""
    place = np.minimum(np.searchsorted(b, a), max(len(b) - 1, 0))
    hit = b[place] == a if len(b) else np.zeros(len(a), bool)
    shared = float(np.minimum(a_weights[hit], b_weights[place[hit]]).sum())
    both = float(a_weights.sum(dtype=np.float64) + b_weights.sum(dtype=np.float64)) - shared
    plain = len(a) + len(b) - int(hit.sum())
    return (shared / both if both else 0.0), (int(hit.sum()) / plain if plain else 0.0)


def _verified(similarity: float):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [
                [np.frombuffer(x.as_buffer(), kind) for x in batch.column(name)]
                for name, kind in (("a_shingles", np.uint32), ("a_weights", np.float32), ("b_shingles", np.uint32), ("b_weights", np.float32))
            ]
            found = np.array([jaccard(*pair) for pair in zip(*sides)]).reshape(-1, 2)
            kept = pa.array(found.max(1) >= similarity)
            columns = [batch.column("a"), batch.column("b"), pa.array(found[:, 0]), pa.array(found[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "weighted", "plain"]).filter(kept)

    return check


class Classes(NamedTuple):
    documents: DataFrame  # doc_id, text_a, text_b (fingerprint), label, class_id, class_size: one row for each document
    links: DataFrame  # a, b (doc_id of one document of either text), weighted, plain


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, similarity: float = SIMILARITY) -> Classes:
    """Classes of documents (doc_id, text) that links of similar texts connect.

    Two texts are linked if the weighted Jaccard similarity of their shingles of `size` words reaches `similarity`, with
    weights idf * (1 + ln tf). A candidate pair is also linked if its plain Jaccard similarity reaches it, but candidates are
    drawn by weight: texts that differ much in how often they repeat their shingles, as a text and the same text written
    twice, need not meet. Equal texts are one class, whatever they hold; texts
    without words, null texts among them, are linked to none but equal ones (null texts to each other).

    One row for each document row: class_id is the smallest doc_id of the class (null if it has none but null), class_size
    its document rows, label a number of the class. text_a and text_b are `xxhash64(text)` and `xxhash64("text", text)`, by
    which rows are found again however a table is cut into tasks.

    Candidates are the texts that share a band key. Equal texts are merged before. A bucket of two is one candidate; in a
    larger one every text is held against four others: the text that shares most keys with all, which in a group of copies
    is the original, the first, the last and one drawn. So a bucket gives candidates in proportion to its size. Then,
    as long as a round finds links, texts of different classes in a bucket are held against each other in a new random
    choice. These only bring together most of what belongs together. All texts whose buckets still hold several classes
    are then joined exactly: every pair of different classes that may be similar enough (`_alike_pairs`) is verified. So
    classes miss a link only if its two ends meet no common bucket (below 1 in 10,000 at the threshold). Within a class
    `links` holds the pairs that were looked at, which connect it, and not every pair.
    """
    idf = document_frequencies(docs, size)
    given = docs.select("doc_id", "text").withColumns(
        {
            "text_a": F.xxhash64("text"),
            "text_b": F.xxhash64(F.lit("text"), "text"),
        }
    )
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    keys = f"doc_id {doc_type}, text_a long, text_b long"
    signed = staged(given.mapInArrow(_Signatures(size, idf), f"{keys}, bands array<long>"))
    texts = staged(
        signed.groupBy("text_a", "text_b")
        .agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    buckets = _Buckets(texts)
    tested = staged(buckets.first_pairs())
    links = staged(_links(given, texts, tested, size, idf, similarity))
    labels = components(links)
    while True:
        pairs = staged(buckets.further_pairs(labels).join(tested, ["a", "b"], "left_anti"))
        if not pairs.head(1):
            break
        found = staged(_links(given, texts, pairs, size, idf, similarity))
        if not found.head(1):
            break
        tested, links = tested.union(pairs), links.union(found)
        labels = components(links)
    left = staged(buckets.divided(labels).join(texts.select("node", "text_a", "text_b"), "node"))
    if left.head(1):
        pairs = staged(_alike_pairs(given, left, size, idf, similarity).join(tested, ["a", "b"], "left_anti"))
        found = staged(_links(given, texts, pairs, size, idf, similarity))
        if found.head(1):
            links = links.union(found)
            labels = components(links)

    named = texts.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = staged(named.select("text_a", "text_b", "node", "label", "doc_id", "copies"))
    classes = named.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"))
    of_text = named.select("text_a", "text_b", "label").join(classes, "label")
    copies = signed.select(F.col("doc_id").alias("given_id"), "text_a", "text_b")
    documents = copies.join(of_text, ["text_a", "text_b"]).select(
        F.col("given_id").alias("doc_id"), "text_a", "text_b", "label", "class_id", "class_size"
    )
    ends = named.select("node", "doc_id")
    shown = (
        links.join(ends.toDF("a", "doc_a"), "a").join(ends.toDF("b", "doc_b"), "b").select(
            F.col("doc_a").alias("a"), F.col("doc_b").alias("b"), "weighted", "plain"
        )
    )
    return Classes(documents, shown)


class _Buckets:
    """Texts by band key, without the keys that one text alone has."""

    def __init__(self, texts: DataFrame) -> None:
        keyed = texts.select(F.explode("bands").alias("band"), "node")
        shared = keyed.groupBy("band").agg(
            F.count("*").alias("texts"), F.min("node").alias("low"), F.max("node").alias("high")
        )
        self.shared = staged(shared.where(F.col("texts") > 1))
        larger = small(self.shared.where(F.col("texts") > 2).select("band", "texts", "low", "high"), F.lit(32))
        self.members = staged(keyed.join(larger, "band"))
        self.round = 0

    def first_pairs(self) -> DataFrame:
        alike = self.members.groupBy("node").agg(F.sum("texts").alias("alike"))
        rank = F.least("alike", F.lit((1 << 30) - 1)) * (1 << 33) + F.pmod(F.xxhash64("node"), F.lit(1 << 33))
        ranked = staged(self.members.join(alike.select("node", rank.alias("rank")), "node"))
        best = ranked.groupBy("band").agg(F.max("rank").alias("rank"))
        leaders = ranked.join(best, ["band", "rank"]).groupBy("band").agg(F.min("node").alias("leader"))
        # Four orders for all buckets: the buckets of one large group draw the same few texts.
        mask = "(xxhash64(pmod(band, 4)) & 9223372036854775807)"
        picked = self.members.groupBy("band").agg(F.min(F.expr(f"node ^ {mask}")).alias("least"))
        chosen = small(leaders.join(picked, "band"), F.lit(24))
        drawn = F.expr(f"least ^ {mask}")
        others = F.explode(F.array("leader", "low", "high", drawn)).alias("other")
        pairs = self.members.join(chosen, "band").select("node", others)
        return _pairs(self.shared.where("texts = 2").select(F.col("low").alias("node"), F.col("high").alias("other")).union(pairs))

    def further_pairs(self, labels: DataFrame) -> DataFrame:
        """In each bucket one text of each class against a text of one class, both picked anew."""
        self.round += 1
        mask = f"(xxhash64({self.round}, pmod(band, 8)) & 9223372036854775807)"
        named = self.members.select("band", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        each = named.groupBy("band", "label").agg(F.min(F.expr(f"node ^ {mask}")).alias("pick"))
        each = staged(each.withColumn("pick", F.expr(f"pick ^ {mask}")))
        turned = f"(xxhash64({-self.round}, pmod(band, 8)) & 9223372036854775807)"
        heads = each.groupBy("band").agg(F.min(F.expr(f"pick ^ {turned}")).alias("head"), F.count("*").alias("classes"))
        heads = heads.where("classes > 1").withColumn("head", F.expr(f"head ^ {turned}"))
        return _pairs(each.join(heads, "band").select(F.col("pick").alias("node"), F.col("head").alias("other")))

    def divided(self, labels: DataFrame) -> DataFrame:
        """node, label of the texts in buckets that hold more than one class."""
        named = self.members.select("band", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        several = named.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        return named.join(several.select("band"), "band", "left_semi").select("node", "label").distinct()


def _alike_pairs(given: DataFrame, left: DataFrame, size: int, idf: Idf, similarity: float) -> DataFrame:
    """All pairs of texts of different classes in `left` (node, label, text_a, text_b) that may be similar enough.

    This is an exact join by prefixes. The shingles of each text are put in one order for all, rare ones first. Two texts
    whose similarity reaches s share at least s of the weight (or, by plain similarity, of the number) of either, so they
    have a shingle in common among the first ones of each, up to which no more than 1 - s stands before. What many texts
    share comes last and joins nothing, and a shingle is looked at only where different classes have it, so that a group
    of copies meets the texts outside it and not itself.
    """
    bits = filter_bits(left.count())
    made = given.select("text_a", "text_b", "text").mapInArrow(
        _Tokens(size, idf, key_filter(left, "text_a", bits), bits), "text_a long, text_b long, whole double, count int, hashes array<long>, weights array<double>"
    )
    values = ("whole", "count", "hashes", "weights")
    one = made.groupBy("text_a", "text_b").agg(*(F.first(c).alias(c) for c in values))
    held = staged(one.join(left, ["text_a", "text_b"]).select("node", "label", *values))
    tokens = held.select("node", "label", "whole", "count", F.inline(F.arrays_zip("hashes", "weights")).alias("hash", "weight"))
    seen = staged(
        tokens.groupBy("hash")
        .agg(F.count("*").alias("texts"), F.min("label").alias("low"), F.max("label").alias("high"))
        .where("texts > 1")
        .select("hash", "texts", (F.col("low") != F.col("high")).alias("several"))
    )
    order = Window.partitionBy("node").orderBy(F.coalesce("texts", F.lit(1)), "hash")
    placed = tokens.join(seen, "hash", "left").withColumns(
        {
            "upto": F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "place": F.row_number().over(order),
        }
    )
    rest = 1 - similarity + 1e-6  # for rounding
    first = (F.col("upto") - F.col("weight") <= rest * F.col("whole")) | (F.col("place") - 1 <= rest * F.col("count"))
    onward = {"whole_on": F.col("whole") - F.col("upto") + F.col("weight"), "count_on": F.col("count") - F.col("place") + 1}
    prefix = placed.where(first & F.col("several")).withColumns(onward)
    prefix = staged(prefix.select("hash", "label", "node", "whole", "whole_on", "count", "count_on"))
    # At the first shingle two texts share, what either has from there on must hold all that they need to share. Of two
    # classes the most that a text of either has to spare, and the least that one needs, tell whether any pair may do.
    share = similarity / (1 + similarity) - 1e-6
    bounds = {f"{x}_{side}": how for x in ("whole", "count") for side, how in (("spare", f"max({x}_on - {share} * {x})"), ("need", f"{share} * min({x})"))}
    classes = prefix.groupBy("hash", "label").agg(*(F.expr(how).alias(c) for c, how in bounds.items()))
    several = classes.groupBy("hash").agg(F.count("*").alias("classes")).where("classes > 1").select("hash")
    classes = staged(classes.join(several, "hash", "left_semi"))
    others = classes.toDF("hash", "other_label", *(f"other_{c}" for c in bounds))
    # Slightly lower for the rounding of these sums.
    may = " or ".join(f"({x}_spare >= other_{x}_need - 1e-6 and other_{x}_spare >= {x}_need - 1e-6)" for x in ("whole", "count"))
    met = classes.join(others, "hash").where(f"label < other_label and ({may})").select("hash", "label", "other_label")
    mine = prefix.join(met, ["hash", "label"]).drop("label")
    theirs = prefix.toDF("hash", "other_label", "other", *(f"other_{c}" for c in ("whole", "whole_on", "count", "count_on")))
    near = " or ".join(f"least({x}_on, other_{x}_on) >= {share} * ({x} + other_{x})" for x in ("whole", "count"))
    return _pairs(mine.join(theirs, ["hash", "other_label"]).where(near).select("node", "other"))


class _Tokens:
    """Shingles and weights of the texts whose fingerprint may be in the bitmap, as lists."""

    def __init__(self, size: int, idf: Idf, bitmap: np.ndarray, bits: int) -> None:
        self.size, self.idf, self.bitmap, self.bits = size, idf, bitmap, bits

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = maybe_in(self.bitmap, batch.column("text_a").to_numpy(zero_copy_only=False).view(np.uint64), self.bits)
            for part in slices(batch.filter(pa.array(wanted))):
                bag = Bag.of(part.column("text"), self.size)
                weights = bag.weights(self.idf)
                whole = np.bincount(bag.doc, weights, part.num_rows)
                count = np.bincount(bag.doc, minlength=part.num_rows).astype(np.int32)
                made = [lists(x, bag.doc, part.num_rows) for x in (bag.hashes.view(np.int64), weights)]
                columns = [*part.select(["text_a", "text_b"]).columns, pa.array(whole), pa.array(count), *made]
                yield pa.RecordBatch.from_arrays(columns, ["text_a", "text_b", "whole", "count", "hashes", "weights"])


def _pairs(pairs: DataFrame) -> DataFrame:
    return pairs.where("node <> other").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _links(given: DataFrame, texts: DataFrame, pairs: DataFrame, size: int, idf: Idf, similarity: float) -> DataFrame:
    """The pairs of texts that are similar enough. Only the shingles of texts in a pair travel, once for each end."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = staged(texts.select("node", "text_a", "text_b").join(ends, "node"))
    bits = filter_bits(wanted.count())
    bags = given.select("text_a", "text_b", "text").mapInArrow(
        _Bags(size, idf, key_filter(wanted, "text_a", bits), bits),
        "text_a long, text_b long, shingles binary, weights binary",
    )
    # Equal texts have equal bags: one of them is kept before the join, and in each task before that.
    one = bags.groupBy("text_a", "text_b").agg(F.first("shingles").alias("shingles"), F.first("weights").alias("weights"))
    held = staged(one.join(wanted, ["text_a", "text_b"]).select("node", "shingles", "weights"))
    both = pairs.join(held.toDF("a", "a_shingles", "a_weights"), "a").join(held.toDF("b", "b_shingles", "b_weights"), "b")
    return both.mapInArrow(_verified(similarity), "a long, b long, weighted double, plain double")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """`docs` with one row of each class of near duplicates: that of the smallest doc_id, null only where all are.

    Among equal ids the text of the smaller fingerprint stays, and of rows equal in id and text the one whose other columns
    hash lowest. Rows are known by id and fingerprint, so nothing depends on the order or the tasks in which they are read.
    """
    names = free_names(docs.columns, "id", "a", "b", "times", "label")
    found = near_duplicates(docs, **options).documents
    each = found.groupBy("label", "doc_id", "text_a", "text_b").agg(F.count("*").alias("times"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_a", "text_b", "times")).alias("first")
    kept = each.groupBy("label").agg(first).select("first.doc_id", "first.text_a", "first.text_b", "first.times", "label").toDF(*names)
    kept = staged(kept)
    one, a, b, times, label = names
    own = docs.withColumns({a: F.xxhash64("text"), b: F.xxhash64(F.lit("text"), "text")})
    same = F.col("doc_id").eqNullSafe(F.col(one)) & (own[a] == kept[a]) & (own[b] == kept[b])
    if not kept.where(F.col(times) > 1).head(1):
        return own.join(kept, same, "left_semi").select(*docs.columns)
    rows = own.join(kept, same).drop(own[a], own[b])
    hashed = [f"`{f.name}`" for f in docs.schema if not re.search("map<|variant", f.dataType.simpleString())]
    alone, repeated = rows.where(F.col(times) == 1), rows.where(F.col(times) > 1)
    least = F.min_by(F.struct(*[f"`{c}`" for c in docs.columns]), F.xxhash64(*hashed)).alias("row")
    return alone.select(*docs.columns).unionByName(repeated.groupBy(label).agg(least).select("row.*"))
