"""The training-data pipeline: language ID, line dedup, SimHash near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a
DataFrame that is written as Parquet and read again as the next stage's `docs`. All but the last
keep the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accrete.llm.decontamination import without_contaminated
from accrete.llm.folds import held_out
from accrete.llm.frames import table
from accrete.llm.language import UNKNOWN, identify_languages, learn_languages
from accrete.llm.line_dedup import without_repeated_lines
from accrete.llm.packing import pack_documents
from accrete.llm.queries import vocabulary
from accrete.llm.simhash import one_of_each_group
from accrete.session import ship_package, staged

# Chunks a worker of the last stage remembers: few, as executors still hold what earlier stages took.
REMEMBERED = 150_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known to the model; those without text or letters are rejected.

    So null and empty texts go. The model learns from rows with text and lang; without any, every row is
    rejected. Repeated rows are judged each, a null id hinders nothing, ties go to the first language by
    name, an empty table stays empty, and other columns are handed on whatever they are called.
    """
    ship_package(spark)
    model = learn_languages(docs.where(~held_out("doc_id", 4, 2)))
    return identify_languages(docs, model).where(F.col("lang_pred") != UNKNOWN).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines taken out of the texts; a document keeps its row, `n_chars` follows its text.

    A null text stays null, a text whose lines all go becomes empty. The earliest line by (doc_id, text)
    stays, null ids first; of rows that repeat id and text one keeps its lines. Long texts and lines are
    handled whole; an empty table stays empty, and other columns are handed on whatever they are called.
    """
    ship_package(spark)
    cleaned = without_repeated_lines(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: 3-word shingles, at most 3 differing bits.

    Texts without words have fingerprint zero and are one group; null texts count as such. The smallest
    doc_id of a group stays, and one of rows that repeat it. An empty table stays empty, and other columns
    are handed on whatever they are called.
    """
    ship_package(spark)
    return one_of_each_group(docs, 3, 3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of 10 benchmark words occurs.

    A null or empty text has no words and stays; so do repeated rows and null ids, each by its own text.
    An empty table stays empty, and other columns are handed on whatever they are called.
    """
    ship_package(spark)
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"), 10, 5)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its token ids, its sequence of at most 2048 tokens and its place there.

    A null or empty text is one piece of the end id alone. Repeated rows and null ids are packed each;
    pieces of one length may take each other's places. An empty table gives no rows; other columns end here.
    """
    ship_package(spark)
    return pack_documents(docs, vocabulary("byte_bpe_50k.json"), 2048, remembered=REMEMBERED)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Fingerprints and token ids are out of reach for SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage returns is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
