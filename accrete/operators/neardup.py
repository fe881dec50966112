"""Near-duplicate images by difference hash: equal hashes, and hashes a few bits apart.

A null hash is no hash: it belongs to no group, is near to nothing and repeats nothing.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrete.functions.hashing import hamming
from accrete.operators.lookup import balanced_lookup
from accrete.session import checkpointed

HASH_BITS = 64
# A join key shared by more hashes than this is split on further bits.
CROWDED = 128
# Hashes compared as one block.
BLOCK_HASHES = 1024


def duplicate_groups(df: DataFrame, key: str, hash_column: str = "dhash") -> DataFrame:
    """One row per distinct hash: its number of rows and its representative, the least key."""
    return df.where(F.col(hash_column).isNotNull()).groupBy(hash_column).agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("representative")
    )


def duplicate_members(df: DataFrame, key: str, hash_column: str = "dhash") -> DataFrame:
    """Every row with the size and representative of its group, balanced under hot hashes; both are
    null for a row without a hash. The hashes are computed once."""
    rows = checkpointed(df.select(key, hash_column))
    groups = duplicate_groups(rows, key, hash_column).withColumn("group_rows", F.col("rows"))
    return balanced_lookup(rows, groups, hash_column, weight="rows")


def duplicate_summary(df: DataFrame, hash_column: str = "dhash") -> DataFrame:
    """Distinct hashes over rows, and how many rows repeat an earlier one; rows without a hash are
    counted as rows only."""
    groups = df.groupBy(hash_column).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.count(F.col(hash_column)).alias("distinct_hashes"),
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col(hash_column).isNotNull(), F.col("n") - 1).otherwise(0)).alias("repeated_rows"),
    )


def _bands(ones: list[int], rows: int, parts: int) -> list[int]:
    """Disjoint bit masks (signed 64-bit) that tell the rows of a key apart about equally well.

    `ones` counts the rows with each bit set. A bit nearly all rows agree on tells little, so
    bits are dealt out by their entropy. With fewer than `parts` telling bits every pair is
    near, and one empty mask keeps the key whole.
    """
    telling = []
    for bit, n in enumerate(ones):
        share = n / rows
        if 0 < share < 1:
            telling.append((-(share * math.log2(share) + (1 - share) * math.log2(1 - share)), bit))
    if len(telling) < parts:
        return [0]
    masks, weights = [0] * parts, [0.0] * parts
    for weight, bit in sorted(telling, reverse=True):
        least = weights.index(min(weights))
        masks[least] |= 1 << bit
        weights[least] += weight
    return [m - (1 << HASH_BITS) if m >> (HASH_BITS - 1) else m for m in masks]


def _with_bands(crowd: DataFrame, distance: int) -> DataFrame:
    """Rows (hash, rows, key, differ) with the band masks of their key, found from its bit counts."""
    bands = F.udf(lambda ones, rows: _bands(list(ones), rows, distance + 1), "array<bigint>", useArrow=True)
    ones = [F.sum(F.shiftrightunsigned("hash", b).bitwiseAND(F.lit(1))) for b in range(HASH_BITS)]
    told = crowd.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.array(*ones).alias("ones"))
    masks = told.select("key", "n", bands("ones", "n").alias("masks"))
    return checkpointed(balanced_lookup(crowd, checkpointed(masks), "key", weight="n"))


def _under_bands(rows: DataFrame) -> DataFrame:
    """Rows (hash, rows, key, differ, masks) once per mask, keyed by the bits under it as well.

    Two hashes at most d apart agree on at least one of d+1 bands. A pair is taken at the first
    band it agrees on, so the bands before it are added to `differ`: every pair is found once.
    """
    return rows.select("*", F.posexplode("masks").alias("_i", "_mask")).select(
        "hash", "rows",
        F.concat("key", F.array(F.col("_i").cast("bigint"), F.col("hash").bitwiseAND(F.col("_mask")))).alias("key"),
        F.concat("differ", F.slice("masks", F.lit(1), F.col("_i"))).alias("differ"),
    )


def _pairs(keyed: DataFrame, distance: int) -> DataFrame:
    """Pairs under keys shared by few hashes: an equi-join, filtered as it is made."""
    left = keyed.select("key", "differ", F.col("hash").alias("hash_a"), F.col("rows").alias("rows_a"))
    right = keyed.select("key", F.col("hash").alias("hash_b"), F.col("rows").alias("rows_b"))
    near = hamming(F.col("hash_a"), F.col("hash_b"))
    gap = F.col("hash_a").bitwiseXOR(F.col("hash_b"))
    first = F.forall("differ", lambda mask: gap.bitwiseAND(mask) != 0)
    return left.join(right, "key").where((F.col("hash_a") < F.col("hash_b")) & (near <= distance) & first).select(
        "hash_a", "hash_b", near.alias("distance"), "rows_a", "rows_b"
    )


def _block_pairs(crowd: DataFrame, distance: int) -> DataFrame:
    """Pairs under crowded keys: hashes are packed into even blocks, and every two blocks of a key
    are one row, compared as bit matrices. Blocks spread over all tasks; only true pairs come out."""
    packed = (
        crowd.withColumn("blocks", F.ceil(F.col("sharing") / BLOCK_HASHES))
        .withColumn("block", F.pmod(F.xxhash64("hash"), "blocks"))
        .groupBy("key", "differ", "blocks", "block")
        .agg(F.collect_list("hash").alias("a"), F.collect_list("rows").alias("n_a"))
    )
    left = packed.withColumn("other", F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)))
    right = packed.select("key", F.col("block").alias("other"), F.col("a").alias("b"), F.col("n_a").alias("n_b"))
    met = left.join(right, ["key", "other"]).select(
        "differ", (F.col("block") == F.col("other")).alias("same"), "a", "n_a", "b", "n_b"
    )

    def compare(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                differ, a, n_a, b, n_b = (
                    batch.column(c)[i].values.to_numpy() for c in ("differ", "a", "n_a", "b", "n_b")
                )
                gap = a[:, None] ^ b[None, :]
                near = np.bitwise_count(gap.view(np.uint64)) <= distance
                if batch.column("same")[i].as_py():
                    near = np.triu(near, 1)
                at, to = np.nonzero(near)
                gap = gap[at, to]
                first = ((gap[:, None] & differ[None, :]) != 0).all(axis=1)
                at, to, gap = at[first], to[first], gap[first]
                turned = a[at] > b[to]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.where(turned, b[to], a[at])), pa.array(np.where(turned, a[at], b[to])),
                        pa.array(np.bitwise_count(gap.view(np.uint64)).astype(np.int32)),
                        pa.array(np.where(turned, n_b[to], n_a[at])), pa.array(np.where(turned, n_a[at], n_b[to])),
                    ],
                    names=["hash_a", "hash_b", "distance", "rows_a", "rows_b"],
                )

    return met.mapInArrow(compare, "hash_a bigint, hash_b bigint, distance int, rows_a bigint, rows_b bigint")


def similar_hashes(
    df: DataFrame, hash_column: str = "dhash", distance: int = 3, crowded: int = CROWDED
) -> DataFrame:
    """Pairs of distinct hashes at most `distance` bits apart: (hash_a, hash_b, distance, rows_a, rows_b).

    Rows are first reduced to distinct hashes with their counts, so copies of one image never
    pair up among themselves. Hashes are then joined on exact bits (bands, as in Manku et al.,
    WWW 2007). A key shared by more than `crowded` hashes is not joined: the bits in which its
    hashes do differ are banded again, as long as that at least halves the comparisons. What
    stays crowded is truly close together and is compared block by block.
    """
    none = F.array().cast("array<bigint>")
    crowd = checkpointed(
        df.where(F.col(hash_column).isNotNull()).groupBy(F.col(hash_column).alias("hash"))
        .agg(F.count(F.lit(1)).alias("rows"))
    ).withColumn("key", none).withColumn("differ", none)
    count = crowd.count()
    crowd, cost, found = crowd.withColumn("sharing", F.lit(count)), count * count, []
    while True:
        keyed = _under_bands(_with_bands(crowd.select("hash", "rows", "key", "differ"), distance))
        # `differ` follows from the key; as a grouping column it needs no aggregation buffer.
        keys = keyed.groupBy("key", "differ").agg(
            F.count(F.lit(1)).alias("n"), F.bit_or("hash").bitwiseXOR(F.bit_and("hash")).alias("varying")
        )
        # A key can hold a pair if it has two hashes and none of the bands to differ in is constant.
        varying = F.col("varying")
        alive = (F.col("n") > 1) & F.forall("differ", lambda mask: varying.bitwiseAND(mask) != 0)
        keys = checkpointed(keys.where(alive).select("key", "n"))
        square = F.col("n") * F.col("n")
        most, compared, left_over = keys.agg(
            F.max("n"), F.sum(square), F.sum(F.when(F.col("n") > crowded, square))
        ).first()
        if (compared or 0) * 2 > cost:
            found.append(_block_pairs(crowd, distance))
            break
        if (most or 0) <= crowded:
            found.append(_pairs(keyed, distance))
            break
        sized = balanced_lookup(keyed, keys.withColumn("sharing", F.col("n")), "key", weight="n")
        found.append(_pairs(sized.where(F.col("sharing") <= crowded), distance))
        crowd, cost = checkpointed(sized.where(F.col("sharing") > crowded)), left_over
    return reduce(DataFrame.unionByName, found)
