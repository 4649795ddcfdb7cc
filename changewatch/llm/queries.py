"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from changewatch.llm import (
    chat, languages, minhash, packing, pages, pieces, quality, repeats, simhash, tokens, topk, turns, whitening)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.whole_numbers(table(spark, folder, "embeddings"), every_row=True)
    return topk.search(vectors, vectors.where(F.col("id") % 50 == 0))


def op2_preferences(spark: SparkSession, folder: str) -> DataFrame:
    pairs = chat.with_foreign_reply(table(spark, folder, "conversations"))
    return pairs.select("conv_id", "n_turns", "common_turns", "prompt", "chosen", "rejected",
                        chat.spans_text("chosen_spans").alias("chosen_mask"),
                        chat.spans_text("rejected_spans").alias("rejected_mask"))


def op3_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digests(repeats.spans(table(spark, folder, "documents")))


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.with_edits(table(spark, folder, "documents"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", F.col("model").alias("lang"), "n_bytes", "perplexity", "excess", "threshold", "keep")


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.count_tokens(table(spark, folder, "documents"))


def op9_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages"))


def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.round_trip(table(spark, folder, "documents"))


def op11_structure(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return turns.audits(turns.repaired(turns.damaged(conversations)), conversations)


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op13_language(spark: SparkSession, folder: str) -> DataFrame:
    return languages.identified(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": op1_topk,
    "op2_preferences": op2_preferences,
    "op3_repeats": op3_repeats,
    "op4_fingerprints": op4_fingerprints,
    "op5_packing": op5_packing,
    "op6_simhash": op6_simhash,
    "op7_quality": op7_quality,
    "op8_token_counts": op8_token_counts,
    "op9_main_text": op9_main_text,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_structure": op11_structure,
    "op12_whitening": op12_whitening,
    "op13_language": op13_language,
}
SQL: dict[str, str] = {
    "op1_topk": topk.SQL,
    "op2_preferences": chat.SQL,
    "op11_structure": turns.SQL,
}
