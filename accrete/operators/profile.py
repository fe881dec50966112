"""Column profiling: frequencies, histograms, medians, top items, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrete.functions.text import clip_upper
from accrete.operators.rank import cumulative
from accrete.session import checkpointed


def value_counts(df: DataFrame, column: str, ascending: bool = False) -> DataFrame:
    """(column, count), most frequent first; equal counts in value order."""
    order = F.col("count").asc() if ascending else F.col("count").desc()
    return df.groupBy(column).count().orderBy(order, column)


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Distinct non-null values beside the row count."""
    distinct = F.approx_count_distinct(column) if approximate else F.count_distinct(F.col(column))
    return df.agg(distinct.alias("distinct_values"), F.count(F.lit(1)).alias("rows"))


def int_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, median) of integer columns, halves cut off towards zero; null values are skipped.

    Works on the value histograms of the columns, taken in one scan: rows are pre-aggregated
    before the shuffle and the middle is found by a running count, never by gathering a column.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("value")) for c in columns])
    histogram = checkpointed(
        df.select(F.inline(pairs)).where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    totals = histogram.groupBy("column").agg(F.sum("n").alias("total"))
    # The middle is one position for an odd count, two for an even one.
    covers = (F.col("below") < F.floor(F.col("total") / 2) + 1) & (F.col("upto") >= F.floor((F.col("total") + 1) / 2))
    return (
        cumulative(histogram, "value", "n", groups=("column",))
        .join(totals, "column").where(covers)
        .groupBy("column")
        .agg(((F.min("value") + F.max("value")) / 2).cast("bigint").alias("median"))
    )


def clipped_histogram(df: DataFrame, column: str, cap: int) -> DataFrame:
    """(bin, count) for 0..cap, values above the cap counted in the last bin, empty bins kept."""
    counted = (
        df.where(F.col(column) >= 0)
        .groupBy(clip_upper(F.col(column), cap).cast("int").alias("bin")).count()
    )
    bins = df.sparkSession.range(cap + 1).select(F.col("id").cast("int").alias("bin"))
    return bins.join(counted, "bin", "left").select("bin", F.coalesce("count", F.lit(0)).alias("count")).orderBy("bin")


def equal_width_histogram(df: DataFrame, column: str, bins: int = 20, cap: int | None = None) -> DataFrame:
    """(bin, left, right, count) over equal bins from the least to the greatest value, last bin closed."""
    value = F.col(column) if cap is None else clip_upper(F.col(column), cap)
    kept = df.select(value.alias("value")).where(F.col("value").isNotNull())
    if isinstance(kept.schema["value"].dataType, T.IntegralType):
        # Integers repeat: count them per value once, then find the range and the bins on that.
        values = checkpointed(kept.groupBy("value").agg(F.count(F.lit(1)).alias("n")))
    else:
        values = kept.withColumn("n", F.lit(1))
    values = values.select(F.col("value").cast("double").alias("value"), "n")
    low, high = values.agg(F.min("value"), F.max("value")).first()
    if low is None:
        low, high = 0.0, 1.0
    elif low == high:
        low, high = low - 0.5, high + 0.5
    at = F.least(F.floor((F.col("value") - low) * bins / (high - low)), F.lit(bins - 1)).cast("int")
    counted = values.groupBy(at.alias("bin")).agg(F.sum("n").alias("count"))
    edge = lambda i: F.lit(low) + i * F.lit(high - low) / bins
    return (
        df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
        .join(counted, "bin", "left")
        .select(
            "bin", edge(F.col("bin")).alias("left"), edge(F.col("bin") + 1).alias("right"),
            F.coalesce("count", F.lit(0)).alias("count"),
        )
        .orderBy("bin")
    )


def top_items(df: DataFrame, column: str, k: int = 8) -> DataFrame:
    """(item, count, label) of the k most frequent items of a list column; null lists are skipped."""
    return (
        df.select(F.explode(column).alias("item"))
        .groupBy("item").count()
        .orderBy(F.col("count").desc(), "item").limit(k)
        .withColumn("label", F.format_string("%s (%d)", "item", "count"))
    )


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, filled, rows): how many rows each column covers, in one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)])
    entries: list[Column] = [
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("filled"), F.col("rows"))
        for i, c in enumerate(columns)
    ]
    return counted.select(F.inline(F.array(*entries)))
