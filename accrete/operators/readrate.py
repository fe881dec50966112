"""Read rates of a stored column group: one pass in order, and random batches by id."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrete.operators.batches import collate, epoch_order, micro_batches
from accrete.operators.curate import random_batches
from accrete.operators.lookup import take_rows


def scan_batches(df: DataFrame, columns: list[str], batch_size: int = 8) -> DataFrame:
    """(rows,) per Arrow batch of at most `batch_size` rows: a pruned scan that decodes every value."""
    import pyarrow as pa

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, batch_size):
                yield pa.RecordBatch.from_arrays([pa.array([whole.slice(at, batch_size).num_rows])], names=["rows"])

    return df.select(*columns).mapInArrow(run, "rows bigint")


def sequential_rate(df: DataFrame, columns: list[str], batch_size: int = 8) -> tuple[int, float]:
    """Rows read and rows per second of one pass."""
    start = time.perf_counter()
    rows = scan_batches(df, columns, batch_size).agg(F.sum("rows")).first()[0] or 0
    return rows, rows / (time.perf_counter() - start)


def shuffled_rate(
    df: DataFrame, key: str, columns: list[str], batches: int = 20, batch_size: int = 8, seed: int = 0
) -> tuple[int, float]:
    """Rows read and rows per second of random batches, fetched by their ids.

    At most batches x batch_size ids are held here; all batches are one read, since a cluster
    serves one large lookup far better than many small ones.
    """
    drawn = random_batches(df.select(key), key, batches, batch_size, seed).orderBy("batch", key).collect()
    start = time.perf_counter()
    rows = len(take_rows(df, [row[key] for row in drawn], key, columns).collect())
    return rows, rows / (time.perf_counter() - start)


def epoch_rate(df: DataFrame, key: str, columns: list[str], batch_size: int = 8, seed: int = 0) -> tuple[int, float]:
    """Rows read and rows per second of a whole seeded epoch, grouped into training batches."""
    start = time.perf_counter()
    ordered = micro_batches(epoch_order(df.select(key), key, 1, seed), batch_size)
    made = collate(ordered, df, key, {c: F.col(c) for c in columns})
    rows = made.agg(F.sum(F.size("samples"))).first()[0] or 0
    return rows, rows / (time.perf_counter() - start)
