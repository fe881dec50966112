"""Vector columns: distances, fixed lengths, half precision, reshaping."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def squared_distance(a: Column, b: Column) -> Column:
    def step(x: Column, y: Column) -> Column:
        gap = x.cast("double") - y.cast("double")
        return gap * gap

    return F.aggregate(F.zip_with(a, b, step), F.lit(0.0), lambda acc, x: acc + x)


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))


def _wrong_length(vector: Column, length: int, name: str) -> Column:
    return F.raise_error(F.format_string(f"{name}: expected {length} values, got %s", F.size(vector).cast("string")))


def check_length(vector: Column, length: int, name: str = "vector") -> Column:
    """The vector itself, or an error when it does not hold exactly `length` values."""
    fits = vector.isNull() | (F.size(vector) == length)
    return F.when(fits, vector).otherwise(_wrong_length(vector, length, name))


def check_bytes(packed: Column, size: int, name: str = "vector") -> Column:
    """Packed bytes themselves, or an error when there are not exactly `size` of them."""
    message = F.format_string(f"{name}: expected {size} bytes, got %s", F.octet_length(packed).cast("string"))
    return F.when(packed.isNull() | (F.octet_length(packed) == size), packed).otherwise(F.raise_error(message))


def zeros(length: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), length)


def reshape(flat: Column, rows: int, width: int) -> Column:
    """Row-major view of a flat list as `rows` lists of `width`."""
    cut = F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda i: F.slice(flat, i * width + 1, F.lit(width)))
    return F.when(F.size(flat) == rows * width, cut).when(
        flat.isNotNull(), _wrong_length(flat, rows * width, "reshape")
    )


def widen(items: Column) -> Column:
    return items.cast("array<bigint>")


def list_matrix(column: pa.ListArray, dtype=np.float64) -> np.ndarray:
    """Arrow lists of one common length as a 2-d array."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    if len(column) == 0:
        return flat.reshape(0, 0)
    if column.null_count or len(flat) % len(column):
        raise ValueError("vectors must be non-null and of one length")
    return flat.reshape(len(column), -1)


def unpack_half(df: DataFrame, column: str) -> DataFrame:
    """Packed half-precision bytes back to `array<float>`, Arrow batch by Arrow batch."""
    fields = [
        T.StructField(f.name, T.ArrayType(T.FloatType())) if f.name == column else f for f in df.schema.fields
    ]
    at = df.columns.index(column)

    def run(batches):
        for batch in batches:
            packed = batch.column(at).to_pylist()
            sizes = [0 if v is None else len(v) // 2 for v in packed]
            flat = np.frombuffer(b"".join(v for v in packed if v is not None), np.float16)
            offsets = pa.array(
                [None if v is None else o for v, o in zip(packed, np.cumsum([0, *sizes]))] + [sum(sizes)], pa.int32()
            )
            values = pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.float32)))
            arrays = list(batch.columns)
            arrays[at] = values
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return df.mapInArrow(run, T.StructType(fields))
