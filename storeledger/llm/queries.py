"""Registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.llm import ann, decontaminate, html, language, lines, minhash, mixing, negatives, packing, passages, quality, sharding, turntrie
from storeledger.llm.store import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file() -> str:
    """The byte-level BPE with 50,257 ids among the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents", ["doc_id", "text"])
    return packing.pack(packing.token_pieces(docs, tokenizer_file(), keep_ids=False).drop("ids"))


def op2_decontamination(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents", ["doc_id", "text"])
    found = decontaminate.find_overlaps(docs, table(spark, root, "benchmark", ["item_id", "text"]))
    return found.drop("text_a", "text_b")


def op3_quality(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents", ["doc_id", "text"])
    model = quality.train(docs.where(~quality.held_out()), table(spark, root, "labels", ["doc_id", "quality"]))
    return quality.score(docs, model).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_sharding(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents", ["doc_id", "text"])
    placed = sharding.shard_by_bytes(sharding.document_sizes(docs), ["doc_id", "size", "text_crc32"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op5_near_dedup(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents", ["doc_id", "text"])
    return minhash.near_duplicates(docs).documents.select("doc_id", "class_id", "class_size")


def op6_language(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents", ["doc_id", "text", "lang"])
    unseen = quality.held_out(parts=3, part=1)
    model = language.train(docs.where(~unseen))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", unseen.alias("held_out"), "lang_pred", "score", "rejected"
    )


def op7_html(spark: SparkSession, root: str) -> DataFrame:
    pages = table(spark, root, "pages", ["page_id", "url", "html"])
    return html.extract(pages).withColumn("n_chars", F.length("text").cast("long"))


def op8_nearest(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "embeddings", ["vec_id", "embedding"])
    return ann.nearest(rows, rows.where(F.col("vec_id") % 50 == 0))


def op9_passages(spark: SparkSession, root: str) -> DataFrame:
    return passages.repeated_passages(table(spark, root, "documents", ["doc_id", "text"]))


def op10_line_dedup(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents", ["doc_id", "text", "source"])
    return lines.drop_site_boilerplate(docs)


def op11_turn_trie(spark: SparkSession, root: str) -> DataFrame:
    return turntrie.conversation_trie(table(spark, root, "conversations", ["conv_id", "turn", "role", "text"]))


def op12_hard_negatives(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "embeddings", ["vec_id", "embedding", "label"])
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return negatives.hard_negatives(rows, rows.where(F.col("vec_id") % 100 == 0))


def op13_mixing(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents", ["doc_id", "text", "source"])
    return mixing.words_taken(mixing.mix(docs)).withColumnRenamed("key", "doc_id")


def build_queries() -> dict[str, Query]:
    return {
        "op1_packing": op1_packing,
        "op2_decontamination": op2_decontamination,
        "op3_quality": op3_quality,
        "op4_sharding": op4_sharding,
        "op5_near_dedup": op5_near_dedup,
        "op6_language": op6_language,
        "op7_html": op7_html,
        "op8_nearest": op8_nearest,
        "op9_passages": op9_passages,
        "op10_line_dedup": op10_line_dedup,
        "op11_turn_trie": op11_turn_trie,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_mixing": op13_mixing,
    }
