"""Small helpers the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def release() -> None:
    """Give memory that a worker no longer uses back to the machine: Spark keeps workers for later
    tasks, and executors hold them within their own limit."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where it has one
    if trim is not None:
        trim(0)


# Bytes of text handled at once by operators that make arrays of many times their size.
FEW_CHARACTERS = 500_000


def slices(batches: Iterator[pa.RecordBatch], text: str, characters: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose `text` column holds about `characters` bytes at most, so that
    what a task holds as Python objects does not grow with the length of texts; at the end of the
    task unused memory is given back."""
    try:
        for batch in batches:
            column = batch.column(text)
            sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0), dtype=np.int64)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // characters)) + 1
            for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
                if high > low:
                    yield batch.slice(low, high - low)
    finally:
        release()


def identified(docs: DataFrame) -> DataFrame:
    """(row, id, key): the whole row, its doc_id, and the hash of its text. Whatever the columns of
    `docs` are called, they clash with nothing; `unwrapped` gives them back."""
    return docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(F.col("text").cast("string")).alias("key"))


def same_row(found: DataFrame) -> Column:
    """Whether an identified row is the one that (doc_id, content) of `found` stands for."""
    return F.col("id").eqNullSafe(found["doc_id"]) & (F.col("key") == found["content"])


def unwrapped(docs: DataFrame, text: Column | None = None) -> list[Column]:
    """The columns of `docs` out of `row`, `text` replaced if given."""
    return [text.alias(c) if c == "text" and text is not None else F.col(f"row.`{c}`").alias(c) for c in docs.columns]


def copy_number(rows: DataFrame) -> Column:
    """1, 2, ... over identified rows that repeat id and text; no window if there are none."""
    again = rows.groupBy("id", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if again.isEmpty():
        return F.lit(1)
    return F.row_number().over(Window.partitionBy("id", "key").orderBy("key"))
