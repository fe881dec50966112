"""Where keys are: the least and greatest key of each file, and Bloom bits of each part.

Both are small Parquet folders written once beside the data they describe, which never changes. Ranges
tell which files a list of keys can be in; bits tell which parts cannot hold a key at all, so that an
append need not read the keys of the whole table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Keys of one row of bits, bits per key, and probes per key: about one in 200 absent keys passes.
SHARD_KEYS = 1 << 20
BITS, PROBES = 12, 6


def file_ranges(rows: DataFrame, key: str) -> DataFrame:
    """(file, rows, least, greatest) of the files that `rows` reads; a file without rows is not there."""
    return rows.select(F.col("_metadata.file_name").alias("file"), F.col(key).alias("key")).groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.min("key").alias("least"), F.max("key").alias("greatest"))


def _hashed(key: str) -> list[Column]:
    return [F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b")]


def shard(a, shards: int):
    """The row of bits a key belongs to, by its first hash (a column or an array)."""
    return F.pmod(a, F.lit(shards)).cast("int") if isinstance(a, Column) else a % shards


def _places(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    steps = np.arange(PROBES, dtype=np.uint64)[None, :]
    return (a.view(np.uint64)[:, None] + steps * (b.view(np.uint64)[:, None] | np.uint64(1))) % np.uint64(size)


def key_bits(rows: DataFrame, key: str, count: int) -> DataFrame:
    """(shards, shard, bits): Bloom bits of `count` keys, about SHARD_KEYS in a row."""
    shards = max(1, -(-count // SHARD_KEYS))
    size = max(64, -(-BITS * count // shards // 8) * 8)

    def run(batches):
        now, held = None, np.zeros(size, bool)

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([shards], pa.int32()), pa.array([now], pa.int32()), pa.array([np.packbits(held).tobytes()], pa.binary())],
                names=["shards", "shard", "bits"])

        for batch in batches:
            own, a, b = (batch.column(c).to_numpy() for c in ("shard", "a", "b"))
            cuts = [0, *(np.flatnonzero(np.diff(own)) + 1), len(own)]
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                if own[low] != now:
                    if now is not None:
                        yield row()
                    now, held = int(own[low]), np.zeros(size, bool)
                held[_places(a[low:high], b[low:high], size).ravel()] = True
        if now is not None:
            yield row()

    hashed = rows.where(F.col(key).isNotNull()).select(*_hashed(key)).withColumn("shard", shard(F.col("a"), shards))
    laid = hashed.repartition(min(shards, 10_000), "shard").sortWithinPartitions("shard")
    return laid.select("shard", "a", "b").mapInArrow(run, "shards int, shard int, bits binary")


def hashed_keys(rows: DataFrame, key: str, most: int) -> pa.Table | None:
    """(key, a, b) of at most `most` rows; None if there are more."""
    found = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), *_hashed(key)).limit(most + 1).toArrow()
    return found if found.num_rows <= most else None


def suspects(bits: DataFrame, asked: pa.Table) -> DataFrame:
    """(part, at): for each part in `bits` (part, shards, shard, bits) the rows of `asked` it may hold."""
    a, b = (asked[c].to_numpy() for c in ("a", "b"))
    shipped = bits.sparkSession.sparkContext.broadcast((a, b))

    def run(batches):
        a, b = shipped.value
        for batch in batches:
            for part, shards, own, packed in zip(*(batch.column(c) for c in ("part", "shards", "shard", "bits"))):
                held = np.unpackbits(np.frombuffer(packed.as_buffer(), np.uint8)).astype(bool)
                here = np.flatnonzero(shard(a, shards.as_py()) == own.as_py())
                here = here[held[_places(a[here], b[here], len(held))].all(axis=1)]
                if len(here):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part.as_py()] * len(here)), pa.array(here)], names=["part", "at"])

    return bits.select("part", "shards", "shard", "bits").mapInArrow(run, "part string, at long")


def bucket_numbers(spark: SparkSession, ids: np.ndarray, name: str, kind: str, buckets: int) -> np.ndarray:
    """The bucket that Spark writes each key to."""
    frame = spark.createDataFrame(pa.table({name: pa.array(ids)})).select(F.col(name).cast(kind).alias(name))
    return frame.select(F.pmod(F.hash(name), F.lit(buckets)).cast("long").alias("bucket")).toArrow()["bucket"].to_numpy()


def holding_files(
    files: np.ndarray, least: np.ndarray, greatest: np.ndarray, ids: np.ndarray, file_buckets: np.ndarray | None = None,
    id_buckets: np.ndarray | None = None,
) -> np.ndarray:
    """Of `files`, those whose range holds one of the ascending `ids` (of their bucket, if there are buckets)."""
    if file_buckets is None:
        file_buckets, id_buckets = np.zeros(len(files), np.int64), np.zeros(len(ids), np.int64)
    order = np.argsort(id_buckets, kind="stable")
    ids, id_buckets = ids[order], id_buckets[order]
    low, high = np.searchsorted(id_buckets, file_buckets, "left"), np.searchsorted(id_buckets, file_buckets, "right")
    found = np.zeros(len(files), bool)
    for i in np.flatnonzero(high > low):
        at = low[i] + np.searchsorted(ids[low[i] : high[i]], least[i])
        found[i] = at < high[i] and ids[at] <= greatest[i]
    return files[found]
