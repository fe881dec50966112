"""Near-duplicate vectors: iterative quantisation, multi-index Hamming tables, exact reranking.

A rotation learned on a bounded sample turns vectors into balanced binary codes, one bit per
direction. The codes are cut into substrings, one hash table each; a vector looks up, in every
table, its own substring and those within a radius, which finds all codes within
tables * (radius + 1) - 1 bits and many beyond. A pair met in several tables counts in the first.
What is found is reranked: the cosine of the original vectors, in double precision, decides.

Equal vectors are one row before any of this and come back as its multiplicity. The number of
tables follows from the number of different vectors, so that a table has about as many places as
there are vectors, and the radius from that.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrete.llm.components import components
from accrete.operators.lookup import balanced_lookup
from accrete.session import staged

# Vectors the rotation is learned on, at most: those of smallest content hash.
SAMPLE = 20_000
ROUNDS = 50
# Bits apart that the tables must cover in full: about what a cosine of 0.9 moves of 64 bits.
COVERED = 9
# Bits apart beyond which a candidate is not reranked; at a cosine of 0.9 the mean is 9.2, the
# standard deviation 2.8.
FARTHEST = 20


def learn_rotation(sample: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and directions (columns, at most 64) whose signs are the code: principal directions,
    then rotated so that signs lose least (alternating minimisation)."""
    bits = min(64, sample.shape[1])
    mean = sample.mean(axis=0)
    # Eigenvectors of the covariance, largest first: no matrix of rows by rows is made.
    axes = np.linalg.eigh((sample - mean).T @ (sample - mean))[1].T[::-1]
    projected = (sample - mean) @ axes[:bits].T
    rotation = np.linalg.qr(np.random.default_rng(0).standard_normal((bits, bits)))[0]
    for _ in range(ROUNDS):
        signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ projected)
        rotation = (left @ right).T
    return mean, axes[:bits].T @ rotation


def table_layout(vectors: int, bits: int) -> tuple[list[tuple[int, int]], int]:
    """(first bit, width) of each table's substring, and the radius of a look-up."""
    tables = max(1, min(round(bits / max(math.log2(max(vectors, 2) / 6), 4)), bits))
    edges = [round(i * bits / tables) for i in range(tables + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])], max(0, math.ceil((COVERED + 1) / tables) - 1)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _masked(code: Column, low: int, width: int) -> Column:
    return code.bitwiseAND(F.lit(_signed(((1 << width) - 1) << low)).cast("long"))


def candidates(codes: DataFrame, layout: list[tuple[int, int]], radius: int) -> DataFrame:
    """Pairs (a < b) of ids whose codes agree within the radius in a substring, each pair once.

    `codes` has id and code. Both sides are dealt by (table, substring); ids with a crowded substring
    are split by Spark's skew handling, both sides being plain exchanges.
    """
    own = [F.struct(F.lit(t).alias("t"), _masked(F.col("code"), low, width).alias("sub")) for t, (low, width) in enumerate(layout)]
    index = codes.select(F.col("id").alias("b"), F.col("code").alias("code_b"), F.explode(F.array(*own)).alias("_k")).select(
        "b", "code_b", "_k.t", "_k.sub")
    probes = None
    for t, (low, width) in enumerate(layout):
        flips = [sum(1 << (low + i) for i in chosen) for r in range(radius + 1) for chosen in itertools.combinations(range(width), r)]
        spread = F.explode(F.array(*(F.lit(_signed(f)).cast("long") for f in flips)))
        some = codes.select(F.col("id").alias("a"), F.col("code").alias("code_a"), F.lit(t).alias("t"), spread.alias("_f"))
        some = some.select("a", "code_a", "t", _masked(F.col("code_a"), low, width).bitwiseXOR(F.col("_f")).alias("sub"))
        probes = some if probes is None else probes.unionByName(some)
    differ = F.col("code_a").bitwiseXOR(F.col("code_b"))
    earlier = F.lit(True)
    for t, (low, width) in enumerate(layout):
        met = F.bit_count(_masked(differ, low, width)) <= radius
        earlier = earlier & ((F.col("t") <= t) | ~met)
    return probes.join(index, ["t", "sub"]).where((F.col("a") < F.col("b")) & (F.bit_count(differ) <= FARTHEST) & earlier).select("a", "b")


def _encode(vectors: DataFrame, mean: np.ndarray, directions: np.ndarray) -> DataFrame:
    """(id, code) of unit vectors (id, unit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = np.asarray(batch.column("unit").flatten()).reshape(batch.num_rows, len(mean))
            signs = (unit - mean) @ directions >= 0
            padded = np.zeros((len(signs), 64), bool)
            padded[:, : signs.shape[1]] = signs
            code = np.packbits(padded, axis=1, bitorder="little").view("<i8").reshape(-1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(code)], ["id", "code"])

    return vectors.select("id", "unit").mapInArrow(run, "id long, code long")


def unit_vectors(rows: DataFrame, embedding: str = "embedding") -> DataFrame:
    """(embedding, n, least, unit): the different valid vectors, how many rows hold each, the smallest
    vec_id among them, and the vector at length one, in double precision. Left out are vectors that
    are null or zero, or hold null or non-finite components."""
    vector = F.col(embedding).cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = rows.where(F.col(embedding).isNotNull() & (F.size(embedding) > 0)).where(fine & F.exists(vector, lambda x: x != 0))
    # Zeros of either sign are one value.
    same = kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(vector, lambda x: x + F.lit(0.0)).alias("embedding"))
    grouped = same.groupBy("embedding").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    largest = F.array_max(F.transform("embedding", lambda x: F.abs(x)))
    grouped = grouped.withColumn("_scaled", F.transform("embedding", lambda x: x / largest))
    norm = F.sqrt(F.aggregate("_scaled", F.lit(0.0), lambda a, x: a + x * x))
    return grouped.select("embedding", "n", "least", F.transform("_scaled", lambda x: x / norm).alias("unit"))


def vector_links(classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of ids of different vectors (id, unit) with cosine >= threshold, each once."""
    count = classes.count()
    sample = classes.orderBy(F.xxhash64("unit"), "id").limit(SAMPLE).select("unit").toPandas()["unit"]
    if count < 2:
        return classes.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    mean, directions = learn_rotation(np.stack(sample.to_numpy()).astype(float))
    codes = staged(_encode(classes, mean, directions), "codes")
    pairs = staged(candidates(codes, *table_layout(count, directions.shape[1])), "candidates")
    left, right = (classes.select(F.col("id").alias(i), F.col("unit").alias(f"_{i}")) for i in ("a", "b"))
    cosine = F.aggregate(F.zip_with("_a", "_b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return pairs.join(left, "a").join(right, "b").where(cosine >= threshold).select("a", "b")


def embedding_groups(rows: DataFrame, threshold: float = 0.9) -> DataFrame:
    """One row per row of `rows` (vec_id, embedding): vec_id, n_links (other vectors linked directly),
    component_id (smallest vec_id reachable, itself included) and kept (vec_id = component_id).

    Vectors link at a cosine of `threshold` or more, whatever their other columns. Null, zero and
    non-finite vectors link with nothing and keep themselves. Vectors of different lengths never
    link; each length is searched by itself. Equal vectors link with each other. Rows repeating a
    vec_id count as vectors of their own; a null vec_id names no component unless alone, and is kept
    only if it stands for itself. Every row is indexed, none is capped.
    """
    classes = staged(unit_vectors(rows).withColumn("id", F.monotonically_increasing_id()), "vectors")
    lengths = sorted(r[0] for r in classes.select(F.size("unit")).distinct().collect())
    links = None
    for length in lengths:
        found = vector_links(classes.where(F.size("unit") == length).select("id", "unit"), threshold)
        links = found if links is None else links.unionByName(found)
    vector = F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0))
    vec = rows.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("_e"))
    if links is None:
        return vec.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    links = staged(links, "links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = classes.select(F.col("id").alias("b"), "n")
    linked = both.join(sizes, "b").groupBy("a").agg(F.sum("n").alias("_links"))
    roots = staged(components(links), "roots")
    named = classes.select("id", "n", "least", "embedding").join(roots, F.col("id") == F.col("node"), "left").join(linked, F.col("id") == F.col("a"), "left")
    named = named.select("embedding", "n", "least", (F.coalesce("_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("root"))
    named = staged(named, "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    members = staged(named.join(least, "root").select(F.col("embedding").alias("_e"), "n", "n_links", "component_id"), "members")
    by_class = balanced_lookup(vec, members, "_e", "n")
    component = F.coalesce("component_id", "vec_id")
    return by_class.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))
