"""Feature upkeep for arriving rows, and duplicate filtering on a stream."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from accrete.functions.hashing import hamming
from accrete.operators.feature import FeatureDef
from accrete.operators.neardup import HASH_BITS
from accrete.operators.table import FeatureTable
from accrete.session import BROADCAST_BYTES, checkpointed
from accrete.sources.files import Folder

# Pairs of hashes compared at once inside a task.
COMPARED = 1 << 22
SEEN = "band int, bits bigint, hash bigint, first bigint, batch bigint"


def keep_features(
    spark: SparkSession, table_path: str, landing: str, schema: T.StructType, features: list[FeatureDef],
    checkpoint: str, files_per_batch: int | None = None, bucketed: bool = False,
) -> StreamingQuery:
    """Append every file that lands in `landing` to a table and fill `features` for its rows.

    Runs until all files present are done. A micro-batch is one part of the table, named after
    its number: a batch repeated after a failure finds its part committed and goes on with the
    features still missing, so each row is added once. Rows whose key the table has already, from a
    file that landed twice, are left out.
    """

    def take(batch: DataFrame, number: int) -> None:
        table = FeatureTable.open(batch.sparkSession, table_path)
        table = table.append(batch, bucketed=bucketed, part=f"stream-{number:09d}", on_repeat="skip")
        table.backfill_all(features)

    reader = spark.readStream.schema(schema).format("parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        reader.load(landing).writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def first_of_each_hash(
    stream: DataFrame, hash_column: str = "dhash", event_time: str | None = None, delay: str = "1 day"
) -> DataFrame:
    """Rows whose hash was not seen before.

    Give an event time: hashes are then remembered until the watermark, `delay` behind the latest
    event, has passed them, which bounds the state. Without one, every hash ever seen is kept, for
    streams known to end.
    """
    if event_time is None:
        return stream.dropDuplicates([hash_column])
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([hash_column])


def _banded(hashes: DataFrame, distance: int) -> DataFrame:
    """(band, bits, hash, first): each hash under each of `distance` + 1 bands of its bits. Two hashes up to
    `distance` bits apart agree on at least one of them."""
    edges = [HASH_BITS * i // (distance + 1) for i in range(distance + 2)]
    bands = [
        F.struct(F.lit(i).alias("band"), F.shiftrightunsigned("hash", low).bitwiseAND(F.lit((1 << (high - low)) - 1)).alias("bits"))
        for i, (low, high) in enumerate(zip(edges, edges[1:]))
    ]
    return hashes.select("hash", "first", F.inline(F.array(*bands))).select("band", "bits", "hash", "first")


def _repeating(fresh: DataFrame, among: DataFrame, distance: int, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The hashes of `fresh` with one of `among` within `distance` bits that came before: `first` is its least
    key in the same batch, or null in an earlier one.

    The hashes of a micro-batch are few: they travel to the tasks that read `among`, which say what they hit
    and nothing else, so that no pair is a row. Above `limit_bytes` both sides meet by band in a semi join.
    """
    if fresh.count() * 24 > limit_bytes:
        near = (hamming(F.col("f.hash"), F.col("a.hash")) <= distance) & (F.col("a.first").isNull() | (F.col("a.first") < F.col("f.first")))
        same = (F.col("f.band") == F.col("a.band")) & (F.col("f.bits") == F.col("a.bits"))
        return fresh.alias("f").join(among.alias("a"), same & near, "left_semi").select("hash").distinct()
    rows = fresh.orderBy("band", "bits", "hash").toArrow()
    asked = {c: rows[c].to_numpy().astype(np.int64) for c in ("band", "bits", "hash", "first")}
    shipped = fresh.sparkSession.sparkContext.broadcast(asked)

    def run(batches):
        asked = shipped.value
        starts = np.searchsorted(asked["band"], np.arange(distance + 2))
        hit = np.zeros(len(asked["hash"]), bool)
        for batch in batches:
            band, bits, hashes = (batch.column(c).to_numpy().astype(np.int64) for c in ("band", "bits", "hash"))
            first = batch.column("first").fill_null(np.iinfo(np.int64).min).to_numpy()
            low, high = np.zeros(len(band), np.int64), np.zeros(len(band), np.int64)
            for b in range(distance + 1):
                own, part = band == b, asked["bits"][starts[b] : starts[b + 1]]
                low[own] = starts[b] + np.searchsorted(part, bits[own], "left")
                high[own] = starts[b] + np.searchsorted(part, bits[own], "right")
            sizes, at = high - low, 0
            ends = np.cumsum(sizes)
            while at < len(sizes):
                upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + COMPARED, "right")))
                n = sizes[at:upto]
                line = np.repeat(np.arange(at, upto), n)
                place = np.arange(int(n.sum())) + np.repeat(low[at:upto] - (np.cumsum(n) - n), n)
                gap = np.bitwise_count((hashes[line] ^ asked["hash"][place]).view(np.uint64))
                hit[place[(gap <= distance) & (first[line] < asked["first"][place])]] = True
                at = upto
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(asked["hash"][hit]))], names=["hash"])

    return among.select("band", "bits", "hash", "first").mapInArrow(run, "hash bigint").distinct()


def first_of_near_hashes(
    spark: SparkSession, landing: str, schema: T.StructType, key: str, place: str, checkpoint: str,
    hash_column: str = "dhash", distance: int = 3, files_per_batch: int | None = None,
) -> StreamingQuery:
    """Rows with no earlier row within `distance` bits, written to `place`/kept as files land in `landing`.

    Earlier are all rows of earlier micro-batches and rows of the same one with a smaller `key`, an integer.
    `place`/seen grows by the distinct hashes of each micro-batch, under each band of their bits, sorted by
    them. Both are written to a folder named after the number of the micro-batch, and one that is repeated
    after a failure writes the same again, so each row is kept once. A null hash repeats nothing.
    """
    folder = Folder(spark, place)

    def take(batch: DataFrame, number: int) -> None:
        rows = checkpointed(batch)
        hashes = rows.where(F.col(hash_column).isNotNull()).groupBy(F.col(hash_column).alias("hash")).agg(
            F.min(F.col(key).cast("bigint")).alias("first"))
        own = checkpointed(_banded(hashes, distance))
        earlier = [n for n in folder.files("seen") if n.startswith("batch=") and int(n.removeprefix("batch=")) < number]
        seen = own
        if earlier:
            root = folder.path("seen")
            before = rows.sparkSession.read.schema(SEEN).option("basePath", root).parquet(*[f"{root}/{n}" for n in earlier])
            seen = own.unionByName(before.select("band", "bits", "hash", F.lit(None).cast("bigint").alias("first")))
        repeated = checkpointed(_repeating(own, seen, distance))
        new = own.where("band = 0").select("hash", "first").join(repeated, "hash", "left_anti")
        # One row of a hash at most is its first: no hash gathers rows here.
        told = rows.withColumn("_hash", F.col(hash_column)).withColumn("_key", F.col(key).cast("bigint"))
        first = told.join(new.select(F.col("hash").alias("_hash"), F.col("first").alias("_key")), ["_hash", "_key"], "left_semi")
        kept = first.dropDuplicates(["_key"]).unionByName(told.where(F.col("_hash").isNull())).drop("_hash", "_key")
        kept.write.mode("overwrite").parquet(folder.path("kept", f"batch={number:09d}"))
        own.repartitionByRange("band", "bits").sortWithinPartitions("band", "bits").write.mode("overwrite").parquet(
            folder.path("seen", f"batch={number:09d}"))

    reader = spark.readStream.schema(schema).format("parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        reader.load(landing).writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
