"""Curated slices: held-out splits, the text-dense share, seeded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accrete.functions.hashing import digest_fraction, order_key
from accrete.functions.text import item_count
from accrete.operators.components import components
from accrete.operators.lookup import balanced_lookup
from accrete.operators.neardup import similar_hashes
from accrete.operators.rank import cumulative, hash_rank
from accrete.session import checkpointed


def holdout_split(df: DataFrame, key: str, held_out: int, seed: int | str = 0, name: str = "split") -> DataFrame:
    """Add 'val' for about `held_out` of 1000 rows, 'train' for the rest.

    Decided by each row's own key: disjoint, the same in every run, unchanged by appends, and a
    projection only.
    """
    place = digest_fraction(order_key(seed, F.col(key)))
    return df.withColumn(name, F.when(place < held_out, "val").otherwise("train"))


def close_groups(df: DataFrame, hash_column: str = "dhash", distance: int = 3) -> DataFrame:
    """(hash, grp, rows): the group of each distinct hash, named by its least hash. Hashes up to `distance` bits
    apart are in one group, and so is all that hangs together by such links. Null hashes are in none."""
    hashes = df.where(F.col(hash_column).isNotNull()).groupBy(F.col(hash_column).alias("hash")).agg(F.count(F.lit(1)).alias("rows"))
    hashes = checkpointed(hashes)
    links = similar_hashes(hashes.select(F.col("hash").alias("dhash")), "dhash", distance)
    found = components(links.select(F.col("hash_a").alias("a"), F.col("hash_b").alias("b")))
    return hashes.join(found.withColumnRenamed("node", "hash"), "hash", "left").select(
        "hash", F.coalesce("component", "hash").alias("grp"), "rows")


def holdout_by_group(
    df: DataFrame, key: str, held_out: int, hash_column: str = "dhash", distance: int = 3, seed: int | str = 0,
    name: str = "split",
) -> DataFrame:
    """Add 'val' or 'train' such that no two rows with hashes up to `distance` bits apart are on different sides.

    A group of close hashes goes to one side as a whole, by the digest of its least hash, so that for about
    `held_out` of 1000 groups all rows are held out. A row without a hash goes by its own key. A group that
    holds a third of all rows moves them together: what leaks is worse than a share that is off.
    """
    groups = checkpointed(close_groups(df, hash_column, distance))
    groups = groups.select(F.col("hash").alias(hash_column), F.col("grp").alias("_close_group"), F.col("rows").alias("_close_rows"))
    found = balanced_lookup(df, groups, hash_column, "_close_rows")
    decided = F.coalesce(F.concat(F.lit("group "), F.col("_close_group").cast("string")), F.col(key).cast("string"))
    place = digest_fraction(order_key(seed, decided))
    return found.withColumn(name, F.when(place < held_out, "val").otherwise("train")).drop("_close_group")


def dense_share(
    df: DataFrame, key: str, items: str, share: float = 0.25, seed: int | str = 0
) -> DataFrame:
    """Exactly floor(share * rows) rows with the longest `items` lists; hash order breaks ties.

    Keys and lengths are written once. They give the threshold length and, among the rows of
    that length, the last digest let in; the slice itself is then a plain filter on the wide
    rows, with no join and no shuffle.
    """
    length = item_count(F.col(items)).cast("bigint")
    sized = checkpointed(df.select(key, length.alias("_n")))
    histogram = sized.groupBy("_n").agg(F.count(F.lit(1)).alias("rows"))
    wanted = int(sized.count() * share)
    edge = (
        cumulative(histogram, "_n", "rows", descending=True)
        .where((F.col("below") < wanted) & (F.col("upto") >= wanted)).first()
    )
    if edge is None:
        return df.limit(0)
    threshold, open_places = edge["_n"], wanted - edge["below"]
    if open_places == edge["rows"]:
        return df.where(length >= threshold)
    digest = order_key(seed, F.col(key))
    tied = sized.where(F.col("_n") == threshold).select(key, digest.alias("_key"))
    last = hash_rank(tied, "_key", key, rows=edge["rows"], name="_rank").where(F.col("_rank") == open_places).first()
    let_in = (digest < last["_key"]) | ((digest == last["_key"]) & (F.col(key) <= last[key]))
    return df.where((length > threshold) | ((length == threshold) & let_in))


def random_batches(
    df: DataFrame, key: str, batches: int = 20, size: int = 8, seed: int | str = 0
) -> DataFrame:
    """(batch, key): `size` random rows per batch without repeats, the least digests of each batch.

    Digests spread evenly, so only rows under a small digest bound are looked at further; the
    bound is widened until every batch is full, which keeps the result exact.
    """
    rows = df.count()
    wanted = min(size, rows)
    numbers = F.sequence(F.lit(0), F.lit(batches - 1))
    drawn = df.select(key, F.explode(numbers).alias("batch")).withColumn("_key", order_key(seed, F.col("batch"), F.col(key)))
    reach = 4 * size + 64
    while True:
        # The first 12 hex digits of a digest, read as a number, are even over 0 .. 2^48.
        bound = (1 << 48) * reach // max(rows, 1)
        whole = bound >= 1 << 48
        near = drawn if whole else checkpointed(drawn.where(F.col("_key") < f"{bound:012x}"))
        if whole or near.groupBy("batch").count().where(F.col("count") >= wanted).count() == batches:
            break
        reach *= 4
    place = F.row_number().over(Window.partitionBy("batch").orderBy("_key", key))
    return near.withColumn("_place", place).where(F.col("_place") <= wanted).select("batch", key)


def first_rows(df: DataFrame, key: str, count: int, columns: list[str | Column]) -> DataFrame:
    """The first `count` rows in key order (`limit` of a table scan, with the order named)."""
    return df.orderBy(key).limit(count).select(*columns)
