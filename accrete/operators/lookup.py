"""Key lookups that stay balanced when a few keys hold most rows."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrete.session import BROADCAST_BYTES

# A key holding more than this share of the rows is hot; there are fewer than HOT_PARTS of them.
HOT_PARTS = 1000
# Ranges an id list is put into a filter as.
RANGES = 128
# Ids that are put in order in one partition; longer lists are sorted across the cluster.
SHORT_LIST = 10_000


def balanced_lookup(rows: DataFrame, lookup: DataFrame, key: str, weight: str) -> DataFrame:
    """Left join of `rows` to `lookup` (one row per key, `weight` = its number of rows).

    Hot keys are matched by broadcast: fewer than HOT_PARTS keys can each hold more than
    1/HOT_PARTS of the rows, whatever the data. All other keys meet their row in a shuffled
    join; the hot rows pass through it spread by a salt nothing on the other side carries.
    """
    total = lookup.agg(F.sum(weight)).first()[0] or 0
    values = [c for c in lookup.columns if c not in (key, weight)]
    is_hot = F.col(weight) * HOT_PARTS > F.lit(total)
    hot = lookup.where(is_hot).select(key, F.struct(*values).alias("_hot"))
    # Always 0, but not a literal: the optimizer would drop a literal from the join keys.
    zero = F.pmod(F.xxhash64(key), F.lit(1)).cast("int")
    rest = lookup.where(~is_hot).select(key, zero.alias("_salt"), F.struct(*values).alias("_rest"))
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(HOT_PARTS)).cast("int") + 1
    found: list[Column] = [F.coalesce(f"_hot.{v}", f"_rest.{v}").alias(v) for v in values]
    return (
        rows.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.when(F.col("_hot").isNull(), 0).otherwise(spread))
        .join(rest, [key, "_salt"], "left")
        .select(*rows.columns, *found)
    )


def _ranges(ids: list[int]) -> list[tuple[int, int]]:
    """At most RANGES closed ranges that hold all ids, cut at the widest gaps between them."""
    ordered = sorted(set(ids))
    gaps = sorted(range(1, len(ordered)), key=lambda i: ordered[i - 1] - ordered[i])[: RANGES - 1]
    cuts = [0, *sorted(gaps), len(ordered)]
    return [(ordered[a], ordered[b - 1]) for a, b in zip(cuts, cuts[1:])]


def in_list_order(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of a short list in the order of `_pos`: SHORT_LIST rows are one partition's work."""
    return rows.repartition(1).sortWithinPartitions("_pos").select(*columns)


def take_rows(df: DataFrame, ids: list[int], key: str, columns: list[str]) -> DataFrame:
    """Rows of an id list, in its order and with its repeats; unknown ids are left out.

    Ranges around a short list of ids reach the Parquet scan, so that on a table sorted by `key` only row
    groups near an id are read, and once. A list longer than SHORT_LIST is joined and sorted across the
    cluster; it is shipped to every task only below BROADCAST_BYTES.
    """
    if not ids:
        return df.select(*columns).limit(0)
    wanted = df.sparkSession.createDataFrame(pa.table({"_pos": pa.array(range(len(ids)), pa.int64()), key: pa.array(ids, pa.int64())}))
    small = F.broadcast(wanted) if 16 * len(ids) < BROADCAST_BYTES else wanted
    kept = df.select(*dict.fromkeys([key, *columns]))
    if len(ids) > SHORT_LIST:
        return kept.join(small, key).orderBy("_pos").select(*columns)
    near = reduce(Column.__or__, [F.col(key).between(low, high) for low, high in _ranges(ids)])
    return in_list_order(kept.where(near).join(small, key), columns)
