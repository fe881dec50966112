"""Image columns: files through Spark's `image` source, or encoded bytes in a table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from accrete.functions.images import hash_gray, image_hash, luma


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded image files: origin, height, width, nChannels, data (BGR bytes)."""
    return (
        spark.read.format("image").option("dropInvalid", "false").load(path)
        .select("image.origin", "image.height", "image.width", "image.nChannels", "image.data")
    )


def hash_decoded(images: DataFrame, name: str = "dhash") -> DataFrame:
    """Difference hash of images from `read_images`; an undecodable file gives 0."""

    def hash_row(height: int, width: int, channels: int, data: bytes) -> int:
        if not data or height <= 0:
            return 0
        pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)
        if channels == 1:
            return hash_gray(pixels[..., 0])
        return hash_gray(luma(pixels[..., 2], pixels[..., 1], pixels[..., 0]))

    def run(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("height", "width", "nChannels", "data")]
            hashes = pa.array([hash_row(*row) for row in zip(*columns)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("origin"), hashes], names=["origin", name])

    return images.mapInArrow(run, f"origin string, {name} bigint")


def hash_encoded(df: DataFrame, key: str, image: str, name: str = "dhash") -> DataFrame:
    """(key, hash) of a column of encoded images, one decode per row."""
    kept = df.select(key, image)

    def run(batches):
        for batch in batches:
            hashes = pa.array([image_hash(data) for data in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), hashes], names=[key, name])

    return kept.mapInArrow(run, f"{key} {kept.schema[key].dataType.simpleString()}, {name} bigint")
