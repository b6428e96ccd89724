"""Language of texts by compression with a dictionary for each language."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.llm.text import slices

DICTIONARY_BYTES = 256 << 10
MAX_LANGUAGES = 200
PIECE = 2048  # characters of a text that are drawn together
WIDENED = 4.0  # times the share drawn before, where that fell short
CHUNK_BYTES = 2 << 10
LEVEL = 5
MIN_MARGIN = 0.02
UNKNOWN = "und"

# ASCII marks, digits and blanks become spaces; letters are lowered before.
_LETTERS_ONLY = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def letters(text: str) -> bytes:
    """The text in lower case, each run of ASCII non-letters as one space, with a space on either side."""
    return b" ".join([b"", *text.lower().encode("utf-8", "replace").translate(_LETTERS_ONLY).split(), b""])


class Verdict(NamedTuple):
    language: str
    score: float
    margin: float


class Model(NamedTuple):
    """Languages, those of most distinct text first, and the raw content their dictionaries are made of."""

    contents: dict[str, bytes]
    level: int = LEVEL

    def coders(self) -> Coders:
        return Coders(self)


class Coders:
    """A compressor for each language, ready to use; made anew in each task."""

    def __init__(self, model: Model) -> None:
        self.languages = list(model.contents)
        self.coders = []
        for name in self.languages:
            held = zstandard.ZstdCompressionDict(model.contents[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=model.level)
            options = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
            self.coders.append(zstandard.ZstdCompressor(dict_data=held, level=model.level, **options))

    def verdict(self, text: str | None) -> Verdict:
        """The language whose dictionary makes the text smallest; ties go to the one of more distinct text.

        Long texts are coded in pieces, so that the dictionary counts throughout and not only until the text has filled the
        window with itself. The margin is how much larger the second smallest is, as a share of it.
        """
        if not self.languages or text is None or not any(map(str.isalpha, text)):
            return Verdict(UNKNOWN, 0.0, 0.0)
        data = letters(text)
        sizes = np.zeros(len(self.coders))
        for at in range(0, len(data), CHUNK_BYTES):
            piece = data[at : at + CHUNK_BYTES]
            sizes += [len(coder.compress(piece)) for coder in self.coders]
        best = int(np.argmin(sizes))
        if len(sizes) == 1:
            return Verdict(self.languages[0], 1.0, 1.0)
        second = np.partition(sizes, 1)[1]
        odds = np.exp2(np.maximum((sizes[best] - sizes) * 8 / max(1.0, len(data) ** 0.5), -60))
        return Verdict(self.languages[best], float(1 / odds.sum()), float((second - sizes[best]) / second))


def train(docs: DataFrame, size: int = DICTIONARY_BYTES, max_languages: int = MAX_LANGUAGES) -> Model:
    """A dictionary of about `size` bytes for each language of `docs` (text, lang): the pieces with the smallest hashes.

    The sample is bounded: of each language come to the driver pieces of texts, cut to letters, that together reach `size`,
    or all where there is less. Equal texts of a language count once. A share of each language is set from the bytes of its
    distinct texts first, so no language is gathered in one task, and widened where what was drawn falls short. Null texts
    and languages are left out, and so are languages without a letter. More than `max_languages` languages are refused. Where
    nothing is left, no table to learn from or no letter in it, the model knows no language.
    """
    given = docs.where(F.col("lang").isNotNull() & (F.length("text") > 0)).select("lang", "text", F.xxhash64("text").alias("hash"))
    distinct = given.groupBy("lang", "hash").agg(F.max(F.octet_length("text")).alias("bytes"))
    totals = distinct.groupBy("lang").agg(F.sum("bytes").alias("bytes")).limit(max_languages + 1)
    share = {r.lang: size * 2 / r.bytes for r in sorted(totals.collect(), key=lambda r: (-r.bytes, r.lang))}
    if len(share) > max_languages:
        raise ValueError(f"up to {max_languages} languages can be told apart, not {len(share)}")
    contents, short = {}, list(share)
    while short:
        drawn = _drawn(given, {name: share[name] for name in short})
        for name in short:
            held, total = [], 0
            for _, piece in drawn.get(name, []):
                if total < size:
                    held.append(piece)
                    total += len(piece)
            contents[name] = b"".join(held)
        short = [name for name in short if len(contents[name]) < size and share[name] < 1]
        share |= {name: share[name] * WIDENED for name in short}
    # A dictionary has 8 bytes at least.
    return Model({name: contents[name] * -(-8 // len(contents[name])) for name in share if contents[name]})


def _drawn(given: DataFrame, share: dict[str, float]) -> dict[str, list[tuple[float, bytes]]]:
    """By language, the letters of the pieces of texts whose hash is below the language's share, smallest hashes first."""
    shares = given.sparkSession.createDataFrame(list(share.items()), "lang string, share double")

    def draw(piece: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64("hash", piece), 11) / float(1 << 53)

    places = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PIECE).cast("int"))
    below = given.join(F.broadcast(shares), "lang").select(
        "lang", "hash", "text", F.explode(F.filter(places, lambda k: draw(k) < F.col("share"))).alias("piece")
    )
    pieces = below.select("lang", draw(F.col("piece")).alias("draw"), F.col("text").substr(F.col("piece") * PIECE + 1, F.lit(PIECE)).alias("text"))
    # Pieces of equal texts have equal hashes: one of them is enough.
    pieces = pieces.groupBy("lang", "draw").agg(F.max("text").alias("text"))

    def lettered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([letters(text) for text in batch.column("text").to_pylist()], pa.binary())
            made = pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("draw"), found], ["lang", "draw", "piece"])
            yield made.filter(pc.greater(pc.binary_length(found), 1))

    out: dict[str, list[tuple[float, bytes]]] = {}
    for row in pieces.mapInArrow(lettered, "lang string, draw double, piece binary").collect():
        out.setdefault(row.lang, []).append((row.draw, bytes(row.piece)))
    return {name: sorted(held) for name, held in out.items()}


def identify(docs: DataFrame, model: Model, min_margin: float = MIN_MARGIN) -> DataFrame:
    """`docs` with lang_pred, score (0 to 1) and rejected. Only `text` is looked at, whole.

    lang_pred is the language whose dictionary codes the text smallest, `und` with score 0 where the text is null or has no
    letter (a character of one of Unicode's letter categories), and everywhere if the model knows no language. `rejected` tells a margin to the second language below `min_margin`: a text too short, mixed or foreign to
    trust. The score is the odds that the difference in size gives.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    names = docs.columns

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = model.coders()
        for batch in batches:
            for part in slices(batch):
                found = [coders.verdict(text) for text in part.column("text").to_pylist()]
                made = [
                    pa.array([v.language for v in found], pa.string()),
                    pa.array([v.score for v in found], pa.float64()),
                    pa.array([v.margin < min_margin for v in found], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], [*names, "lang_pred", "score", "rejected"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(identified, f"{fields}, lang_pred string, score double, rejected boolean")
