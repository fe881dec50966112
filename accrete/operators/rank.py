"""Exact global positions without a one-task window.

`hash_rank` is for seeded hash orders: digests spread evenly, so a prefix of the digest cuts
the order into small consecutive buckets. `sorted_rank` is for any other total order: one
distributed sort, written once, then numbered partition by partition.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accrete.session import checkpointed

# Rows one task ranks at a time, and the longest digest prefix (16^5 offsets per group).
BUCKET_ROWS = 500_000
LONGEST_PREFIX = 5


def prefix_length(rows: int) -> int:
    """Hex digits that keep a bucket of `rows` evenly spread digests near BUCKET_ROWS."""
    needed = math.ceil(math.log(max(rows, 1) / BUCKET_ROWS, 16)) if rows > BUCKET_ROWS else 1
    return min(max(needed, 1), LONGEST_PREFIX)


def _exclusive_sum(value: str, groups: list[str], order: str) -> Column:
    window = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def hash_rank(
    df: DataFrame, key: str, tie: str, groups: tuple[str, ...] = (), rows: int | None = None, name: str = "rank"
) -> DataFrame:
    """Add the 1-based position by (`key`, `tie`) inside each of `groups`; `key` is a hex digest.

    The offset of each bucket is joined on the same keys the window is partitioned by, so the
    wide side is shuffled once.
    """
    groups = list(groups)
    digits = prefix_length(df.count() if rows is None else rows)
    bucketed = df.withColumn("_bucket", F.substring(key, 1, digits))
    keys = [*groups, "_bucket"]
    offsets = (
        bucketed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, _exclusive_sum("_n", groups, "_bucket").alias("_offset"))
    )
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(key, tie))
    return (
        bucketed.withColumn("_inside", inside)
        .join(offsets, keys)
        .withColumn(name, F.col("_inside") + F.col("_offset"))
        .select(*df.columns, name)
    )


def _placed(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """`df` sorted across the cluster and written once, so that every later read sees each row in
    the same sorted partition `_part` at the same place `_at` (from 0)."""
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return checkpointed(df.orderBy(*order)).select("*", F.spark_partition_id().alias("_part"), at.alias("_at"))


def sorted_rank(df: DataFrame, order: list[str | Column], name: str = "rank") -> DataFrame:
    """Add the 1-based position in a total order; rows are sorted and written once.

    Offsets are one row per sorted partition, a number set by spark.sql.shuffle.partitions and
    not by the data, hence the broadcast.
    """
    placed = _placed(df, order)
    offsets = (
        placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", _exclusive_sum("_n", [], "_part").alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_at") + F.col("_offset") + 1)
        .select(*df.columns, name)
    )


def cumulative(
    histogram: DataFrame, value: str, count: str, groups: tuple[str, ...] = (), descending: bool = False
) -> DataFrame:
    """Running count over a histogram in value order, `below` (exclusive) and `upto` (inclusive).

    The histogram (distinct values, however many) is range-partitioned; each task sums its own
    range, and the ranges before it come in as one offset.
    """
    groups = list(groups)
    runs = [*groups, "_part"]
    placed = _placed(histogram, [*groups, F.col(value).desc() if descending else F.col(value).asc()])
    offsets = (
        placed.groupBy(*runs).agg(F.sum(count).alias("_n"))
        .select(*runs, _exclusive_sum("_n", groups, "_part").alias("_offset"))
    )
    return (
        placed.withColumn("_before", _exclusive_sum(count, runs, "_at"))
        .join(offsets, runs)
        .withColumn("below", F.col("_before") + F.col("_offset"))
        .withColumn("upto", F.col("below") + F.col(count))
        .select(*histogram.columns, "below", "upto")
    )
