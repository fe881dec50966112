"""Near duplicates by SimHash, found with a pivot distance table.

Every fingerprint has a row in a table of its Hamming distances to many reference fingerprints
(pivots). By the triangle inequality two fingerprints within d bits differ by at most d in every
coordinate of that table, so a pair whose largest coordinate difference is above d is discarded
unseen; survivors are verified bit by bit.

Fingerprints meet where they may be close at all: 64 bits are cut into d + 3 blocks, so two
fingerprints within d bits agree on some three of them, and each is sent to one place per three
blocks. There they are sorted by their first coordinate and compared along it, so that a pair is
looked at only while that coordinate differs by at most d. Equal fingerprints are one row before
any of this; a crowded place is split into blocks of rows that meet pairwise in tasks of their own.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accrete.llm.components import components, joined_to_trees
from accrete.llm.frames import FEW_CHARACTERS, identified, release, same_row, slices, unwrapped
from accrete.llm.tokenizing import forget_chunks
from accrete.operators.lookup import balanced_lookup
from accrete.session import BROADCAST_BYTES, staged

# References of the distance table.
PIVOTS = 32
# Rows of one place compared in one task.
PLACE_ROWS = 4096
BITS = 64


def fingerprint(text: str, words: int) -> int:
    """SimHash of a text as a signed 64-bit integer; no words: zero."""
    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    count = max(len(tokens) - words + 1, 1)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    starts = np.concatenate([[0], ends[: count - 1]]).tolist()
    stops = (ends[-count:] - 1).tolist()
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(joined[s:e], 42) for s, e in zip(starts, stops)]), np.uint8)
    ones = np.unpackbits(hashes.reshape(count, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count).view(">i8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, content (hash of the text, to find the row again) and fp of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_chunks()
        for batch in slices(batches, "text", FEW_CHARACTERS):
            found = [fingerprint(t or "", words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("content"), pa.array(found, pa.int64())], ["doc_id", "content", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.withColumn("content", F.xxhash64("text")).mapInArrow(run, "doc_id long, content long, fp long")


def _cuts(parts: int) -> list[tuple[int, int]]:
    """First bit and width of each of `parts` blocks of the 64 bits."""
    edges = [round(i * BITS / parts) for i in range(parts + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


def _places(classes: DataFrame, blocks: list[tuple[int, int]], chosen: list[tuple[int, ...]]) -> DataFrame:
    """One row per fingerprint and place: (choice of blocks, their bits)."""
    keys = []
    for number, choice in enumerate(chosen):
        mask = sum(((1 << width) - 1) << low for low, width in (blocks[i] for i in choice))
        signed = mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask
        keys.append(F.struct(F.lit(number).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed).cast("long")).alias("bits")))
    return classes.select("fp", F.explode(F.array(*keys)).alias("_place")).select("fp", "_place.choice", "_place.bits")


def pivots() -> np.ndarray:
    """The references: fixed pseudo-random fingerprints."""
    return np.frombuffer(np.random.default_rng(0).bytes(8 * PIVOTS), "<u8")


def _whole_places(batches: Iterator[pa.RecordBatch], rows: int = 200_000) -> Iterator[list[np.ndarray]]:
    """Columns of sorted rows, cut between places only."""
    held: list[list[np.ndarray]] = []

    def joined() -> list[np.ndarray]:
        return [np.concatenate(c) for c in zip(*held)]

    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        if sum(len(h[0]) for h in held) >= rows:
            columns = joined()
            last = np.flatnonzero(np.any([np.diff(c) != 0 for c in columns[:4]], axis=0))
            if len(last):
                yield [c[: last[-1] + 1] for c in columns]
                columns = [c[last[-1] + 1 :] for c in columns]
            held = [columns]
    if held:
        yield joined()


def close_pairs(classes: DataFrame, distance: int = 3, trees: bool = False) -> DataFrame:
    """All pairs (a < b) of distinct fingerprints `fp` within `distance` bits, each once; with `trees` the
    task that finds them joins them to trees, so what comes out has the same components only."""
    blocks = _cuts(distance + 3)
    chosen = list(itertools.combinations(range(len(blocks)), 3))
    places = _places(classes, blocks, chosen)
    crowded = staged(
        places.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PLACE_ROWS), "crowded")
    if crowded.count() * 32 <= BROADCAST_BYTES:
        crowded = F.broadcast(crowded)
    parts = F.coalesce(F.ceil(F.col("n") / PLACE_ROWS), F.lit(1)).cast("int")
    split = (
        places.join(crowded, ["choice", "bits"], "left").withColumn("_parts", parts)
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("_parts")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .select("choice", "bits", F.least("own", "_other").alias("low"), F.greatest("own", "_other").alias("high"), "own", "fp")
    )
    masks = np.array([((1 << width) - 1) << low for low, width in blocks], np.uint64)
    number = {c: i for i, c in enumerate(chosen)}
    # For each set of agreeing blocks, the first choice of three among them: only there is a pair reported.
    first = np.full(1 << len(blocks), -1)
    for agreeing in range(1 << len(blocks)):
        same = [i for i in range(len(blocks)) if agreeing >> i & 1]
        if len(same) >= 3:
            first[agreeing] = number[tuple(same[:3])]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_chunks()
        references = pivots()
        for choice, bits, low, high, own, fp in _whole_places(batches):
            fp = fp.view(np.uint64)
            place = np.concatenate([[0], np.cumsum(np.any([np.diff(c) != 0 for c in (choice, bits, low, high)], axis=0))])
            table = np.empty((len(fp), PIVOTS), np.int8)
            for pivot, reference in enumerate(references):
                table[:, pivot] = np.bitwise_count(fp ^ reference)
            order = np.lexsort((table[:, 0], place))
            choice, low, high, own, fp, place, table = (c[order] for c in (choice, low, high, own, fp, place, table))
            at, step = np.arange(len(fp)), 1
            while True:
                at = at[at + step < len(fp)]
                at = at[(place[at] == place[at + step]) & (table[at + step, 0] - table[at, 0] <= distance)]
                if not len(at):
                    break
                near = at[np.abs(table[at] - table[at + step]).max(axis=1) <= distance]
                differ = fp[near] ^ fp[near + step]
                agreeing = ((differ[:, None] & masks == 0) << np.arange(len(masks))).sum(axis=1)
                ok = (np.bitwise_count(differ) <= distance) & (first[agreeing] == choice[near])
                ok &= (low[near] == high[near]) | (own[near] != own[near + step])
                near = near[ok]
                if len(near):
                    ends = fp[near].view(np.int64), fp[near + step].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(*ends)), pa.array(np.maximum(*ends))], ["a", "b"])
                step += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from joined_to_trees(compare(batches)) if trees else compare(batches)
        finally:
            release()

    keys = ["choice", "bits", "low", "high"]
    return split.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def simhash_groups(docs: DataFrame, words: int = 3, distance: int = 3) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, content, fp, fingerprint (16 hex digits) and
    component_id, the smallest doc_id reachable over fingerprints within `distance` bits.

    Words are runs of characters other than ASCII white space, A-Z lower-cased; shingles are `words`
    of them, repeats included; a text of fewer is one shingle, and one of none (null too) has the
    fingerprint zero and is linked like any other. Repeated rows and ids are answered row by row; a
    null id never names a component unless all its ids are null. Other columns are left out. Texts
    are read whole, once.
    """
    marked = staged(fingerprints(docs, words), "fingerprints")
    classes = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "classes")
    linked = staged(components(close_pairs(classes, distance, trees=True), contracted=True), "linked")
    rooted = classes.join(linked, classes["fp"] == linked["node"], "left").select(
        "fp", "least", "n", F.coalesce("component", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    members = staged(rooted.join(named, "root").select("fp", "n", "component_id"), "members")
    return balanced_lookup(marked, members, "fp", "n").select(
        "doc_id", "content", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, words: int = 3, distance: int = 3) -> DataFrame:
    """`docs` with one row of each SimHash group, the one of smallest doc_id; all columns stay.

    Rows that repeat the whole id and text count as one. Among different texts under one smallest id
    the one with the smallest fingerprint, then text hash, stays; ids that are all null likewise.
    """
    keep = (
        simhash_groups(docs, words, distance).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("component_id", "fp").agg(F.min("content").alias("content"), F.count(F.lit(1)).alias("n"))
    )
    # Groups without an id are told apart by what links them, which their fingerprints stand for.
    one = keep.where("component_id is not null").groupBy("component_id").agg(
        F.min(F.struct("fp", "content")).alias("row"), F.sum("n").alias("n")).select("component_id", "row.content", "n")
    nameless = keep.where("component_id is null").select("component_id", "content", "n")
    keep = staged(one.unionByName(nameless).withColumnRenamed("component_id", "doc_id"), "keep")
    found = identified(docs).join(keep, same_row(keep)).select("row", "id", "key", "n")
    single = found.where("n = 1").select(*unwrapped(docs))
    if keep.where("n > 1").isEmpty():
        return single
    # An id of several rows: one of those that are alike stays.
    alike = found.where("n > 1").withColumn("_copy", F.row_number().over(Window.partitionBy("id", "key").orderBy("n")))
    return single.unionByName(alike.where("_copy = 1").select(*unwrapped(docs)))
