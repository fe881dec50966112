"""Best-fit-decreasing packing of documents into sequences, over counts instead of single bins.

Documents of equal length are alike, and so are sequences with equal room left; both lengths and
rooms are at most the capacity. Best-fit decreasing therefore runs over a histogram of lengths
(at most `capacity` numbers, whatever the corpus) with a segment tree over remaining rooms, which
finds the tightest room that still fits in logarithmic time and moves whole runs of equal bins at
once. Its result is a short list of placements "documents a..b of length L go to sequences
s, s+1, ... at offset o"; ranking the documents of a length and applying the list is done by
Spark, in parallel.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accrete.llm.chunk_ids import column_encoder
from accrete.llm.frames import FEW_CHARACTERS, slices
from accrete.llm.tokenizing import REMEMBERED
from accrete.session import staged

# Rows of the corpus behind each bucket that a length is spread over, and the fewest buckets.
RANK_ROWS = 200_000
LEAST_BUCKETS = 256


class RoomTree:
    """Segment tree over rooms 1..capacity that answers "the smallest room >= need with a bin"."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.bins = [0] * (2 * self.size)

    def add(self, room: int, count: int) -> None:
        at = room + self.size
        while at:
            self.bins[at] += count
            at >>= 1

    def tightest(self, need: int) -> int | None:
        at = need + self.size
        if self.bins[at]:
            return need
        # Up until a right sibling has bins, then down to its leftmost one.
        while at > 1 and (at & 1 or not self.bins[at + 1]):
            at >>= 1
        if at <= 1:
            return None
        at += 1
        while at < self.size:
            at = 2 * at if self.bins[2 * at] else 2 * at + 1
        return at - self.size


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Placements (length, first rank, documents, first sequence, offset) for `counts` documents of
    each length in 1..capacity."""
    tree, open_bins = RoomTree(capacity), defaultdict(deque)
    placed, sequences = [], 0

    def leave(room: int, first: int, count: int) -> None:
        if room:
            open_bins[room].append((first, count))
            tree.add(room, count)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                # A new sequence takes the next documents of this length too, as many as fit: each
                # of them would find it the tightest, nothing else having room for them.
                many = max(left // (capacity // length), 1)
                first, count, room = sequences, many, capacity
                sequences += many
                for k in range(min(capacity // length, left)):
                    placed.append((length, rank, count, first, k * length))
                    rank, left, room = rank + count, left - count, room - length
                    if left < count:
                        break
                leave(room, first, count)
                continue
            first, count = open_bins[room].popleft()
            used = min(count, left)
            tree.add(room, -count)
            if used < count:
                open_bins[room].appendleft((first + used, count - used))
                tree.add(room, count - used)
            placed.append((length, rank, used, first, capacity - room))
            leave(room - length, first, used)
            rank, left = rank + used, left - used
    return placed


def _ranked(items: DataFrame, rows: int) -> DataFrame:
    """Add `_rank`, the place (from 0) among items of equal `length`; hot lengths are spread."""
    buckets = max(LEAST_BUCKETS, rows // RANK_ROWS)
    salted = items.withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.lit(buckets)).cast("int"))
    keys = ["length", "_bucket"]
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(
        *keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy("_row")) - 1
    return salted.withColumn("_inside", inside).join(offsets, keys).withColumn("_rank", F.col("_inside") + F.col("_offset"))


def best_fit_pack(items: DataFrame, capacity: int) -> DataFrame:
    """Add `sequence_id` and `offset` to `items`, which have a `length` in 1..capacity.

    Every item gets a place; items share a sequence without gaps from offset 0. Null or
    out-of-range lengths raise. Ties are alike, so any of them may take a place. Input columns
    stay, except that `_row` names are taken here. The plan travels as at most a few placements
    per length, a size set by `capacity` and not by the number of items.
    """
    spark = items.sparkSession
    kept = staged(items.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    found = kept.groupBy("length").agg(F.count(F.lit(1)).alias("n")).limit(capacity + 1).collect()
    counts = {r["length"]: r["n"] for r in found}
    if any(length is None or not 1 <= length <= capacity for length in counts):
        raise ValueError(f"lengths must be in 1..{capacity}")
    plan = best_fit_decreasing(counts, capacity)
    runs = spark.createDataFrame(
        pa.table({name: pa.array([p[i] for p in plan], pa.int64())
                  for i, name in enumerate(("length", "_first", "_count", "_sequence", "offset"))}))
    by_length = runs.groupBy("length").agg(
        F.sort_array(F.collect_list(F.struct("_first", "_count", "_sequence", "offset"))).alias("_runs"))
    rank = F.col("_rank")
    mine = F.filter("_runs", lambda r: (r["_first"] <= rank) & (rank < r["_first"] + r["_count"]))[0]
    return (
        _ranked(kept, sum(counts.values())).join(F.broadcast(by_length), "length")
        .withColumn("_run", mine)
        .select(*items.columns, (F.col("_run._sequence") + F.col("_rank") - F.col("_run._first")).alias("sequence_id"),
                F.col("_run.offset").alias("offset"))
    )


def cut_documents(
    docs: DataFrame, path: str, capacity: int, end_id: int = 0, keep_ids: bool = True, remembered: int = REMEMBERED,
) -> DataFrame:
    """Pieces of at most `capacity` ids: doc_id, piece, start, length, ids_crc32 and, if asked for,
    `ids` as little-endian unsigned 32-bit integers.

    A document is its ids, then `end_id`, so an empty or null text is one piece of one id. Only
    longer documents are cut, into pieces of `capacity` of which the first may be shorter. Repeated
    rows and null ids are cut row by row; other columns are left out.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = column_encoder(path, True, remembered)
        for batch in slices(batches, "text", FEW_CHARACTERS):
            columns: list[list] = [[], [], [], [], [], []]
            whole, ends = encoder.encode(batch.column("text"))
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), np.split(whole, ends[:-1])):
                ids = np.empty(len(found) + 1, "<u4")
                ids[:-1], ids[-1] = found, end_id
                low, piece = 0, 0
                while low < len(ids):
                    high = low + ((len(ids) - low - 1) % capacity + 1)
                    part = ids[low:high].tobytes()
                    row = (doc_id, piece, low, high - low, zlib.crc32(part), part if keep_ids else None)
                    for column, value in zip(columns, row):
                        column.append(value)
                    low, piece = high, piece + 1
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            width = 5 + keep_ids
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns[:width], types)], names[:width])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(cut, schema)


def pack_documents(
    docs: DataFrame, path: str, capacity: int = 2048, keep_ids: bool = True, remembered: int = REMEMBERED,
) -> DataFrame:
    """Tokenise, cut and pack: one row per piece with its sequence and offset. `remembered` is the number
    of chunks a worker keeps the ids of: fewer take less memory and more time."""
    return best_fit_pack(cut_documents(docs, path, capacity, keep_ids=keep_ids, remembered=remembered), capacity)
