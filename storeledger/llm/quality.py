"""Quality of documents from a linear-chain conditional random field over their lines."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm.text import mixed, slices, utf8

SAMPLE_DOCS = 4000
SAMPLE_BYTES = 64 << 20  # of their texts
THRESHOLD = 0.7
STEPS = 250
_LINE_FEED, _SPACE = 10, 32


def _bytes(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


_CLASSES = {
    "upper": _bytes((65, 90)),
    "lower": _bytes((97, 122)),
    "beyond_ascii": _bytes((128, 255)),
    "digit": _bytes((48, 57)),
    "blank": _bytes((9, 9), (32, 32)),
    "stop": _bytes((46, 46)),
    "pause": _bytes((44, 44), (58, 59)),
    "cry": _bytes((33, 33), (63, 63)),
    "quote": _bytes((34, 34), (39, 41), (45, 45)),
    "symbol": _bytes((35, 38), (42, 43), (47, 47), (60, 62), (64, 64), (91, 96), (123, 126)),
}
_INK = ~_bytes((0, 32))
_PLAIN = _CLASSES["upper"] | _CLASSES["lower"] | _CLASSES["beyond_ascii"] | _CLASSES["digit"]
_HASH = np.cumprod(np.full(256, 0x9E3779B97F4A7C15, np.uint64))


class Lines(NamedTuple):
    features: np.ndarray  # a row for each line, of the line itself
    weight: np.ndarray  # bytes of the line plus 1
    first: np.ndarray  # index of each text's first line, and the number of lines


def line_features(texts: pa.Array) -> Lines:
    """Lines of each text and what they look like. A null or empty text has one empty line."""
    data, offsets = utf8(texts)
    feeds = np.flatnonzero(data == _LINE_FEED)
    count = len(offsets) - 1
    # A line begins where a text begins and after each line feed.
    begin = np.concatenate([offsets[:-1], feeds + 1])
    owner = np.concatenate([np.arange(count), np.searchsorted(offsets, feeds, "right") - 1])
    order = np.lexsort((begin, owner))
    begin, owner = begin[order], owner[order]
    first = np.searchsorted(owner, np.arange(count + 1))
    last = np.ones(len(begin), bool)
    last[:-1] = owner[1:] != owner[:-1]
    end = np.where(last, offsets[owner + 1], np.concatenate([begin[1:] - 1, [0]]))
    size = end - begin

    def within(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (total[end] - total[begin]).astype(np.float64)

    ink = _INK[data]
    shown = within(ink)
    share = np.maximum(shown, 1)
    columns = [within(table[data]) / share for table in _CLASSES.values()]
    same = np.zeros(len(data), bool)
    same[1:] = (data[1:] == data[:-1]) & ink[1:]
    columns.append(within(same) / share)
    columns.append(within(same & ~_PLAIN[data]) / share)

    # Tokens: runs of ink. Their hashes tell repeats; their ends tell marks stuck to words.
    before, after = np.zeros_like(ink), np.zeros_like(ink)
    before[1:], after[:-1] = ink[:-1], ink[1:]
    starts = offsets[:-1][np.diff(offsets) > 0]
    before[starts] = False
    after[starts[1:] - 1] = False
    left, right = np.flatnonzero(ink & ~before), np.flatnonzero(ink & ~after)
    line = np.searchsorted(begin, left, "right") - 1
    tokens = np.bincount(line, minlength=len(begin)).astype(np.float64)
    per = np.maximum(tokens, 1)
    marked = ~_PLAIN[data[right]] & ((right > left) & ~_PLAIN[data[np.maximum(right - 1, 0)]])
    capital = _CLASSES["upper"][data[left]] if len(left) else np.zeros(0, bool)
    alone = (right == left) & ~_PLAIN[data[left]] if len(left) else np.zeros(0, bool)
    value = _token_hashes(data, ink, left, right)
    twin = np.zeros(len(left), bool)
    twin[1:] = (value[1:] == value[:-1]) & (line[1:] == line[:-1])
    by = np.lexsort((value, line))
    fresh = np.ones(len(left), bool)
    fresh[1:] = (value[by][1:] != value[by][:-1]) | (line[by][1:] != line[by][:-1])
    distinct = np.bincount(line[by][fresh], minlength=len(begin)).astype(np.float64)
    for flags in (marked, capital, alone, twin):
        columns.append(np.bincount(line[flags], minlength=len(begin)) / per)
    columns.append((distinct + (tokens == 0)) / per)
    columns += [shown / per / 10, np.log1p(size) / 5, np.log1p(tokens) / 5, (size == 0).astype(np.float64)]
    tail = np.where(size > 0, data[np.maximum(end - 1, 0)], 0) if len(data) else np.zeros(len(begin), np.uint8)
    head = np.where(size > 0, data[np.minimum(begin, max(len(data) - 1, 0))], 0) if len(data) else tail
    columns += [_CLASSES["stop"][tail].astype(np.float64), (_CLASSES["upper"] | _CLASSES["beyond_ascii"])[head].astype(np.float64)]
    return Lines(np.stack(columns, 1), size + 1.0, first)


def _token_hashes(data: np.ndarray, ink: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    if not len(left):
        return np.zeros(0, np.uint64)
    lengths = right - left + 1
    first = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    return mixed(np.add.reduceat((data[ink].astype(np.uint64) + np.uint64(1)) * _HASH[place % 256], first) + lengths.astype(np.uint64))


class Scale(NamedTuple):
    mean: np.ndarray
    spread: np.ndarray

    def inputs(self, lines: Lines) -> np.ndarray:
        """Standardised features of each line, their squares, and the features of the lines before and after it."""
        own = np.clip((lines.features - self.mean) / self.spread, -4, 4)
        opens, closes = np.zeros(len(own)), np.zeros(len(own))
        opens[lines.first[:-1]] = closes[lines.first[1:] - 1] = 1
        before, after = np.zeros_like(own), np.zeros_like(own)
        before[1:], after[:-1] = own[:-1], own[1:]
        before[opens > 0], after[closes > 0] = 0, 0
        return np.hstack([own, own**2 / 4, before, after, opens[:, None], closes[:, None], np.ones((len(own), 1))])


class Model(NamedTuple):
    """A chain of labels bad (0) and good (1): weights of a line's inputs towards good, and of neighbouring labels."""

    scale: Scale
    weights: np.ndarray
    links: np.ndarray
    slope: float
    bias: float

    def document_scores(self, lines: Lines) -> np.ndarray:
        """Mean marginal of "good" over a text's lines, weighted by length, brought to a probability of quality 1."""
        good = marginals(self.scale.inputs(lines) @ self.weights, self.links, lines.first)[0]
        return _squash(self.slope * _logit(_mean(good, lines)) + self.bias)


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _mean(values: np.ndarray, lines: Lines) -> np.ndarray:
    return np.add.reduceat(values * lines.weight, lines.first[:-1]) / np.add.reduceat(lines.weight, lines.first[:-1])


def marginals(emit: np.ndarray, links: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of each line, and the expected number of each pair of neighbouring labels, by forward-backward.

    All texts advance together, line by line; the texts with most lines come first, so that those still running are a
    prefix of them.
    """
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    starts, counts = first[:-1][order], counts[order]
    steps = int(counts[0]) if len(counts) else 0
    running = np.searchsorted(-counts, -np.arange(steps), "left")
    score = np.stack([np.zeros(len(emit)), emit], 1)
    ahead, behind = np.zeros((len(emit), 2)), np.zeros((len(emit), 2))
    for t in range(steps):
        at = starts[: running[t]] + t
        if t:
            ahead[at] = np.logaddexp(ahead[at - 1, :1] + links[0], ahead[at - 1, 1:] + links[1])
        ahead[at] += score[at]
    for t in range(steps - 2, -1, -1):
        at = starts[: running[t + 1]] + t
        onward = behind[at + 1] + score[at + 1]
        behind[at] = np.logaddexp(onward[:, :1] + links[:, 0], onward[:, 1:] + links[:, 1])
    both = ahead + behind
    whole = np.logaddexp(both[:, 0], both[:, 1])
    good = np.exp(both[:, 1] - whole)
    inner = np.ones(len(emit), bool)
    inner[first[:-1]] = False
    at = np.flatnonzero(inner)
    pair = ahead[at - 1][:, :, None] + links[None] + (score[at] + behind[at])[:, None, :]
    return good, np.exp(pair - whole[at][:, None, None]).sum(0)


def fit(lines: Lines, quality: np.ndarray, steps: int = STEPS) -> Model:
    """A model from documents with a label each.

    Lines have no labels of their own: those of a good document count as good. Those of a bad one count as bad, except
    the lines that a classifier without context takes for good all the same, since junk often stands next to sound lines.
    Then the field is fitted to these line labels, and a logistic curve brings the mean marginal to the document's label.
    """
    scale = Scale(lines.features.mean(0), lines.features.std(0) + 1e-3)
    inputs = scale.inputs(lines)
    of = np.repeat(np.arange(len(quality)), np.diff(lines.first))
    labels = quality[of].astype(np.float64)
    share = 1 / np.diff(lines.first)[of] ** 0.5  # a long document does not outweigh many short ones

    def descend(size: int, gradient) -> np.ndarray:
        at, drift, power = np.zeros(size), np.zeros(size), np.zeros(size)
        for t in range(1, steps + 1):
            slope = gradient(at) + 1e-3 * at
            drift, power = 0.9 * drift + 0.1 * slope, 0.99 * power + 0.01 * slope**2
            at = at - 0.1 * (1 - t / (steps + 1)) * (drift / (1 - 0.9**t)) / (np.sqrt(power / (1 - 0.99**t)) + 1e-8)
        return at

    alone = descend(inputs.shape[1], lambda w: inputs.T @ (share * (_squash(inputs @ w) - labels)) / share.sum())
    labels[(labels == 0) & (_squash(inputs @ alone) > 0.8)] = 1
    inner = np.ones(len(labels), bool)
    inner[lines.first[:-1]] = False
    after = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[after - 1].astype(int), labels[after].astype(int)), 1)

    def gradient(theta: np.ndarray) -> np.ndarray:
        good, pairs = marginals(inputs @ theta[4:], theta[:4].reshape(2, 2), lines.first)
        return np.concatenate([(pairs - seen).ravel(), inputs.T @ (good - labels)]) / len(labels)

    theta = descend(inputs.shape[1] + 4, gradient)
    links, weights = theta[:4].reshape(2, 2), theta[4:]
    x = _logit(_mean(marginals(inputs @ weights, links, lines.first)[0], lines)) / 4
    curve = descend(2, lambda c: np.array([x, np.ones_like(x)]) @ (_squash(c[0] * x + c[1]) - quality) / len(x))
    return Model(scale, weights, links, max(float(curve[0]), 0.05) / 4, float(curve[1]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> Model | None:
    """A model from documents (doc_id, text) with a label (doc_id, quality 0 or 1), drawn by a hash of the id.

    At most `sample` ids are drawn, and of these, in order of the hash, as many as have `sample_bytes` of text together. Texts
    stay on the executors; the driver gets the features of the sample's lines, so both bounds hold for it. Null labels are
    left out, of several labels of an id the larger counts, and equal ids in `docs` are all used. Ids may be of any type. Where
    there is no labelled document there is no model.
    """
    given = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    drawn = given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    sizes = texts.groupBy("doc_id").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes"))
    so_far = Window.orderBy(F.xxhash64("doc_id"), "doc_id")  # over the ids drawn, `sample` at most
    fitting = sizes.withColumn("so_far", F.sum("bytes").over(so_far)).where(F.col("so_far") <= sample_bytes).select("doc_id")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = texts.join(F.broadcast(fitting), "doc_id").select("doc_id", "text", "quality")
    rows = texts.mapInArrow(_sample_lines, f"doc_id {id_type}, quality int, weight array<double>, features binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.doc_id, len(r.weight), bytes(r.features)))
    weight = [np.array(r.weight) for r in rows]
    width = len(rows[0].features) // 8 // len(weight[0])
    features = np.concatenate([np.frombuffer(r.features).reshape(-1, width) for r in rows])
    first = np.concatenate([[0], np.cumsum([len(w) for w in weight])])
    return fit(Lines(features, np.concatenate(weight), first), np.array([r.quality for r in rows], np.float64))


def _sample_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            lines = line_features(part.column("text"))
            pieces = list(zip(lines.first[:-1], lines.first[1:]))
            columns = [
                part.column("doc_id"),
                part.column("quality").cast(pa.int32()),
                pa.array([lines.weight[a:b] for a, b in pieces], pa.list_(pa.float64())),
                pa.array([lines.features[a:b].tobytes() for a, b in pieces], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "quality", "weight", "features"])


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """`docs` with `score`, the probability that a document is good. Only `text` is looked at, whole.

    A null text counts as empty; an empty text is one empty line and gets that line's score. A given `score` is replaced.
    Without a model nothing is known, and every score is a half.
    """
    docs = docs.drop("score")
    if model is None:
        return docs.withColumn("score", F.lit(0.5))
    names = docs.columns

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                made = pa.array(model.document_scores(line_features(part.column("text"))))
                yield pa.RecordBatch.from_arrays([*part.columns, made], [*names, "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(scored, f"{fields}, score double")


def held_out(doc_id: str = "doc_id", parts: int = 4, part: int = 2) -> F.Column:
    """Whether the CRC-32 of the id's text leaves that remainder; such rows are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == part, F.lit(False))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` without the rows scored below `threshold`, by a model trained on the labels that are not held out.

    Where there is no such label, all rows stay.
    """
    model = train(docs.where(~held_out()), labels)
    if model is None:
        return docs
    return score(docs, model).where(F.col("score") >= threshold).drop("score")
