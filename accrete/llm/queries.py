"""Registered queries of the subpackage: each operator on its whole table, production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accrete.llm.frames import table
from accrete.llm.decontamination import contamination
from accrete.llm.embedding_dedup import embedding_groups
from accrete.llm.folds import fold, held_out
from accrete.llm.language import identify_languages, learn_languages
from accrete.llm.line_dedup import without_repeated_lines
from accrete.llm.mask_search import rank_documents
from accrete.llm.packing import pack_documents
from accrete.llm.simhash import simhash_groups
from accrete.llm.source_audit import audit_sources
from accrete.llm.span_dedup import without_repeated_spans
from accrete.llm.suffix_tree import learn_suffix_tree
from accrete.llm.token_counts import prefix_token_counts
from accrete.llm.token_files import through_files
from accrete.llm.toxicity import labelled, learn_toxicity, score_toxicity, split_calibration


def vocabulary(name: str) -> str:
    """Place of a vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(table(spark, sf_dir, "embeddings"), 0.9)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), 2048, keep_ids=False)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn_languages(docs.where(~held_out("doc_id", 4, 2)))
    rows = docs.select("doc_id", "text", held_out("doc_id", 4, 2).alias("held_out"))
    return identify_languages(rows, model).drop("text")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), 3, 3).select("doc_id", "fingerprint", "component_id")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = prefix_token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), 1024)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit", "limit_bytes")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through_files(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), 2, keep_ids=False)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10, 5)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curve comes from a bounded sample of fold 4, counts from all else but fold 0, held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = labelled(docs, table(spark, sf_dir, "labels"))
    model = learn_toxicity(*split_calibration(known.where(fold("doc_id", 5) != 0), fold("doc_id", 5) == 4))
    return score_toxicity(docs.withColumn("held_out", held_out("doc_id", 5, 0)), model).drop("text")


def op11_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out("doc_id", 7, 2).alias("held_out"))
    return learn_suffix_tree(docs.where(~F.col("held_out"))).score(docs)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 20)


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(table(spark, sf_dir, "documents"), 30, 50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_language_id": op4_language_id,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_token_files": op7_token_files,
    "op8_decontamination": op8_decontamination,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_suffix_tree": op11_suffix_tree,
    "op12_ranked_search": op12_ranked_search,
    "op13_source_audit": op13_source_audit,
}
