"""The corpus pipeline: documents in, packed training pieces out.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage before it kept; all but the last return the columns
of `documents`. `docs` is a stored table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from storeledger.llm import decontaminate, lines, minhash, packing, quality
from storeledger.llm.queries import tokenizer_file
from storeledger.llm.store import staged, table

# Sampling, clustering and packing have no SQL; tests/llm hold the stages against brute force instead.
ORACLE_SQL = None


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field, trained on the labels of `docs` that are not held out, scores 0.7 or more."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels", ["doc_id", "quality"]))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that more than a tenth of their source's documents have; all documents stay."""
    return lines.drop_site_boilerplate(docs).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest doc_id."""
    return minhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' token ids in training sequences of 2048."""
    pieces = packing.token_pieces(docs.select("doc_id", "text"), tokenizer_file(), keep_ids=False)
    return packing.pack(pieces.drop("ids"))


STAGES = [
    ("quality", keep_good_documents),
    ("line_dedup", drop_boilerplate_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over `documents`; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
