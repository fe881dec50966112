"""Training order and batches: seeded epochs, micro-batches, accumulation steps, collation.

Order is decided on keys alone; wide columns are joined once, after every row knows its batch.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrete.functions.hashing import order_key
from accrete.functions.vectors import check_bytes, check_length, reshape, widen
from accrete.operators.rank import hash_rank, sorted_rank
from accrete.session import checkpointed

# Names of the stored training columns.
TOKEN_FIELDS = ["input_ids", "attention_mask", "labels"]
TOKEN_STRUCT = "sft_tokens"
VISION_COLUMN = "vision_tower_hiddens"
# Epochs a training run goes through at most.
EPOCH_LIMIT = 10


def epoch_order(df: DataFrame, key: str, epochs: int = 1, seed: int | str = 0) -> DataFrame:
    """(epoch, key, rank): a new seeded order of all rows in every epoch, ranks from 1."""
    rows = df.count()
    drawn = df.select(key, F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    keyed = drawn.withColumn("_key", order_key(seed, F.col("epoch"), F.col(key)))
    return hash_rank(keyed, "_key", key, groups=("epoch",), rows=rows).select("epoch", key, "rank")


def stored_order(df: DataFrame, key: str) -> DataFrame:
    """(epoch, key, rank) of one unshuffled pass in key order."""
    return sorted_rank(df.select(key), [key]).select(F.lit(0).alias("epoch"), key, "rank")


def row_index(df: DataFrame, key: str) -> DataFrame:
    """`df` with the 0-based position of each row in key order as `row_index`."""
    return sorted_rank(df, [key], "row_index").withColumn("row_index", F.col("row_index") - 1)


def micro_batches(ordered: DataFrame, batch_size: int) -> DataFrame:
    """Add `batch`: consecutive runs of `batch_size` ranks, the short last one kept."""
    return ordered.withColumn("batch", F.floor((F.col("rank") - 1) / batch_size))


def epochs_needed(rows: int, batch_size: int, accumulate: int, max_steps: int, limit: int = EPOCH_LIMIT) -> int:
    """Epochs a run of `max_steps` steps goes through, `limit` at most."""
    per_epoch = max(1, math.ceil(rows / batch_size))
    return min(limit, math.ceil(max_steps * accumulate / per_epoch))


def accumulation_schedule(
    batched: DataFrame, rows: int, batch_size: int, epochs: int, accumulate: int, max_steps: int | None = None,
) -> DataFrame:
    """(epoch, batch, samples, step): the optimizer step each micro-batch counts towards.

    The count runs on over epoch ends. A trailing group too short for a step has none, and neither
    have batches after `max_steps`, if given.
    """
    per_epoch = math.ceil(rows / batch_size)
    steps = epochs * per_epoch // accumulate
    if max_steps is not None:
        steps = min(max_steps, steps)
    step = F.floor((F.col("epoch") * per_epoch + F.col("batch")) / accumulate) + 1
    return (
        batched.groupBy("epoch", "batch").agg(F.count(F.lit(1)).alias("samples"))
        .withColumn("step", F.when(step <= steps, step))
    )


def progress_steps(schedule: DataFrame, steps: int, every: int = 10) -> DataFrame:
    """(step, samples) of the steps worth reporting: every `every`-th and the last."""
    step = F.col("step")
    return (
        schedule.where(step.isNotNull() & ((step % every == 0) | (step == steps)))
        .groupBy("step").agg(F.sum("samples").alias("samples"))
    )


def token_columns(columns: list[str]) -> list[str]:
    """Stored columns a training read needs: the token struct only when the flat ones are not all there."""
    struct = TOKEN_STRUCT in columns and not set(TOKEN_FIELDS) <= set(columns)
    return [VISION_COLUMN, TOKEN_STRUCT] if struct else [VISION_COLUMN, *TOKEN_FIELDS]


def token_field(columns: list[str], name: str) -> Column:
    """A token list wherever it is stored, widened to 64-bit integers."""
    struct = TOKEN_STRUCT in token_columns(columns)
    return widen(F.col(f"{TOKEN_STRUCT}.{name}" if struct else name))


def collate(
    batched: DataFrame, rows: DataFrame, key: str, fields: dict[str, Column], name: str = "samples"
) -> DataFrame:
    """(epoch, batch, samples): each micro-batch as one list of `fields`, in rank order.

    `batched` holds keys only, `rows` the wide columns; a list has at most one batch of rows.
    """
    wide = rows.select(key, *[c.alias(n) for n, c in fields.items()])
    joined = batched.select("epoch", "batch", "rank", key).join(wide, key)
    sample = F.struct("rank", key, *fields)
    return joined.groupBy("epoch", "batch").agg(F.array_sort(F.collect_list(sample)).alias(name))


def cached_fields(
    columns: list[str], tokens: int, width: int, text_tokens: int, packed: bool = False
) -> dict[str, Column]:
    """Fields of a cached training batch: vision rows [tokens, width] and token lists of one length.

    Packed half-precision vectors stay packed through the shuffle, at a quarter of the bytes of
    `array<double>`; the reader views them as [tokens, width].
    """
    vision = F.col(VISION_COLUMN)
    fields = {"vision": check_bytes(vision, tokens * width * 2) if packed else reshape(vision, tokens, width)}
    for name in TOKEN_FIELDS:
        fields[name] = check_length(token_field(columns, name), text_tokens, name)
    return fields


def cached_batches(
    table, batch_size: int = 2, shuffle: bool = True, seed: int | str = 42, epochs: int = 1,
    tokens: int = 400, width: int = 2048, text_tokens: int = 512,
) -> DataFrame:
    """Training batches of a FeatureTable from its stored columns only; raw columns are not read."""
    needed = token_columns(table.columns)
    rows = table.select(table.key, *needed)
    keys = table.select(table.key)
    ordered = epoch_order(keys, table.key, epochs, seed) if shuffle else stored_order(keys, table.key)
    packed = isinstance(rows.schema[VISION_COLUMN].dataType, T.BinaryType)
    fields = cached_fields(table.columns, tokens, width, text_tokens, packed)
    return collate(micro_batches(ordered, batch_size), rows, table.key, fields)


# ---- orders in two levels ----------------------------------------------------------------------


def windowed_order(keys: DataFrame, key: str, batch_size: int, epochs: int = 1, seed: int | str = 0) -> DataFrame:
    """(epoch, bucket, key, batch, rank) of rows (key, bucket): in each epoch the buckets are put in a new
    seeded order, and the rows of each bucket, too. Batches do not cross buckets: the last one of a bucket may
    be short. Nearly as well mixed as an exact permutation where buckets hold many rows, and no row has to
    leave its bucket."""
    drawn = keys.select(key, "bucket", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    digest = order_key(seed, F.col("epoch"), F.col(key))
    inside = F.row_number().over(Window.partitionBy("epoch", "bucket").orderBy(digest, key)) - 1
    sizes = drawn.groupBy("epoch", "bucket").agg(F.count(F.lit(1)).alias("n"))
    # One row per bucket and epoch, whatever the rows.
    earlier = Window.partitionBy("epoch").orderBy(order_key(seed, F.col("epoch"), F.concat(F.lit("bucket "), F.col("bucket"))), "bucket")
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(
        "epoch", "bucket", F.coalesce(F.sum(F.ceil(F.col("n") / batch_size)).over(before), F.lit(0)).alias("first_batch"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_rank"))
    return drawn.withColumn("_inside", inside).join(firsts, ["epoch", "bucket"]).select(
        "epoch", "bucket", key, (F.col("first_batch") + F.floor(F.col("_inside") / batch_size)).alias("batch"),
        (F.col("first_rank") + F.col("_inside") + 1).alias("rank"))


def _in_runs(rows: DataFrame, name: str) -> DataFrame:
    """(epoch, batch, samples): the rows of each batch as one list. The rows of a batch follow each other in
    one partition, so a batch is a slice of what Arrow brings."""
    sample = T.StructType([f for f in rows.schema.fields if f.name not in ("epoch", "batch")])
    schema = T.StructType([rows.schema["epoch"], rows.schema["batch"], T.StructField(name, T.ArrayType(sample))])

    def pack(piece: pa.RecordBatch) -> pa.RecordBatch:
        epochs, numbers = (piece.column(c).to_numpy() for c in ("epoch", "batch"))
        starts = np.concatenate([[0], np.flatnonzero((np.diff(epochs) != 0) | (np.diff(numbers) != 0)) + 1])
        items = pa.StructArray.from_arrays([piece.column(f.name) for f in sample], names=sample.names)
        lists = pa.ListArray.from_arrays(pa.array([*starts, piece.num_rows], pa.int32()), items)
        return pa.RecordBatch.from_arrays([*(piece.column(c).take(pa.array(starts)) for c in ("epoch", "batch")), lists], ["epoch", "batch", name])

    def run(batches):
        held: list[pa.RecordBatch] = []  # the rows of the batch that may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            epochs, numbers = (batch.column(c).to_numpy() for c in ("epoch", "batch"))
            others = np.flatnonzero((epochs != epochs[-1]) | (numbers != numbers[-1]))
            last = int(others[-1]) + 1 if len(others) else 0
            goes_on = held and last == 0 and (held[-1].column("epoch")[-1], held[-1].column("batch")[-1]) == (
                batch.column("epoch")[0], batch.column("batch")[0])
            if goes_on:
                held.append(batch)
                continue
            done = [*held, *([batch.slice(0, last)] if last else [])]
            if done:
                yield pack(_joined(done))
            held = [batch.slice(last)]
        if held:
            yield pack(_joined(held))

    return rows.mapInArrow(run, schema)


def _joined(pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pieces[0] if len(pieces) == 1 else pa.Table.from_batches(pieces).combine_chunks().to_batches()[0]


def windowed_batches(
    table, batch_size: int = 2, seed: int | str = 42, epochs: int = 1, tokens: int = 400, width: int = 2048,
    text_tokens: int = 512,
) -> DataFrame:
    """Training batches of a FeatureTable in the order of `windowed_order`, without moving the wide columns:
    each task reads one bucket, puts its rows in order and cuts them into batches. Keys alone are shuffled
    to decide on the order; loose increments are shuffled whole."""
    needed = token_columns(table.columns)
    buckets = table.manifest["buckets"]
    pieces = table.bucket_pieces(needed)
    bucket = lambda first: (F.pmod(F.hash(table.key), F.lit(buckets)) + first).alias("bucket")
    keys = reduce(DataFrame.unionByName, [rows.select(table.key, bucket(first)) for first, rows in table.bucket_pieces([])])
    order = checkpointed(windowed_order(keys, table.key, batch_size, epochs, seed))
    found = []
    for first, rows in pieces:
        packed = isinstance(rows.schema[VISION_COLUMN].dataType, T.BinaryType)
        fields = cached_fields(table.columns, tokens, width, text_tokens, packed)
        own = order.where(F.col("bucket").between(first, first + buckets - 1)).select("epoch", "batch", "rank", table.key)
        wide = rows.select(table.key, *[c.alias(n) for n, c in fields.items()])
        # The hint keeps the wide side where it is, bucket by bucket.
        met = wide.join(own.hint("shuffle_hash"), table.key).select("epoch", "batch", "rank", table.key, *fields)
        found.append(_in_runs(met.sortWithinPartitions("epoch", "rank"), "samples"))
    return reduce(DataFrame.unionByName, found)
