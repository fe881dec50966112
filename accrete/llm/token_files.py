"""Token ids on disk: frequency-ranked, byte-aligned, control bytes apart from data bytes.

An id is stored as its frequency rank (0 = most frequent), in 1 to 4 bytes, least significant
first. The byte counts of four values make one control byte (two bits each, first value lowest),
kept in a column of its own, so that a decoder turns control bytes into a mask by table lookup and
copies all data bytes at once. A file is a Parquet file of blocks in ascending document order:

    part, block      which file of the sequence, and which block in it
    first            ids of the file before this block
    n_docs, n_ids    documents and ids of the block
    doc_ids          n_docs signed 64-bit integers, little-endian, and a null mask (1 byte each)
    lengths          n_docs unsigned 32-bit integers, little-endian: ids of each document
    control, data    the ids

The ranks are a second small table (rank, id). Parquet is only the container: Spark's committer
makes a lost executor harmless, on any file system.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from accrete.llm.chunk_ids import column_encoder
from accrete.llm.frames import FEW_CHARACTERS, slices
from accrete.llm.tokenizing import chunk_encoder, tokenizer
from accrete.session import new_dir, staged

# Ids after which a block is closed; blocks hold whole documents.
BLOCK_IDS = 1 << 16
# Files that one task reads back: they are a few MB each, and its rows narrow.
FILES_A_TASK = 4

_BLOCKS = ("part int, block int, first long, n_docs int, n_ids long, doc_ids binary, lengths binary, "
           "control binary, data binary")


def _mask_table() -> np.ndarray:
    """For each control byte, which of the 4 x 4 bytes of its four values are stored."""
    sizes = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3
    return (np.arange(4) <= sizes[:, :, None]).reshape(256, 16)


_MASKS = _mask_table()


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    padded = np.zeros(-(-len(ranks) // 4) * 4, "<u4")
    padded[: len(ranks)] = ranks
    sizes = (padded > 0xFF).view(np.uint8) + (padded > 0xFFFF).view(np.uint8) + (padded > 0xFFFFFF).view(np.uint8)
    control = (sizes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    stored = _MASKS[control].reshape(-1, 4)
    stored[len(ranks) :] = False
    return control.tobytes(), padded.view(np.uint8).reshape(-1, 4)[stored].tobytes()


def decode_ranks(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The values back, by table lookup."""
    stored = _MASKS[np.frombuffer(control, np.uint8)].reshape(-1, 4)
    stored[count:] = False
    values = np.zeros((len(stored), 4), np.uint8)
    values[stored] = np.frombuffer(data, np.uint8)
    return values.reshape(-1).view("<u4")[:count]


def token_table(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit) of each document, `end_id` last."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = column_encoder(path, False)
        for batch in slices(batches, "text", FEW_CHARACTERS):
            ids, ends = encoder.encode(batch.column("text"))
            ids = np.insert(ids, ends, end_id)
            edges = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]) * ids.itemsize
            found = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(ends), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(ids.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found.cast(pa.binary())], ["doc_id", "ids"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(
        encode, "doc_id long, ids binary")


def id_ranks(tokens: DataFrame, vocabulary: int, dtype: str) -> np.ndarray:
    """Rank of each id, most frequent first, equal counts by id; counted over all rows.

    Each task sends one count per id it saw; the sums are at most one row per vocabulary entry.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, np.int64)
        for batch in batches:
            _, places, data = batch.column(0).buffers()
            edges = np.frombuffer(places, np.int32)[batch.column(0).offset :][: batch.num_rows + 1]
            ids = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]].view(dtype) if batch.num_rows else np.zeros(0, dtype)
            counts += np.bincount(ids, minlength=vocabulary)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["id", "n"])

    found = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    totals = np.zeros(vocabulary, np.int64)
    totals[found["id"]] = found["n"]
    order = np.lexsort((np.arange(vocabulary), -totals))
    ranks = np.empty(vocabulary, "<u4")
    ranks[order] = np.arange(vocabulary)
    return ranks


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int = 2) -> None:
    """Tokenise `docs` (doc_id, text), append `end_id` to each, and write the files in ascending
    doc_id order (null ids first; equal ids by content) under `folder`.

    A null text counts as empty: its only id is `end_id`. Texts are encoded once; sorting moves
    ids, not texts. An empty table gives files without blocks.
    """
    spark = docs.sparkSession
    vocabulary = max(tokenizer(path).get_vocab_size(), end_id + 1)
    dtype = chunk_encoder(path, False).dtype
    tokens = staged(token_table(docs, path, end_id), "tokens")
    ranks = id_ranks(tokens, vocabulary, dtype)
    by_id = spark.createDataFrame(pa.table({"rank": pa.array(ranks.astype(np.int64)), "id": pa.array(np.arange(vocabulary))}))
    by_id.coalesce(1).write.parquet(f"{folder}/ranks")  # one row per vocabulary entry

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, first = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        parts: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            control, data = encode_ranks(ranks[ids])
            known = np.array([n or 0 for n in names], "<i8").tobytes() + bytes(n is None for n in names)
            lengths = np.array([len(p) for p in parts], "<u4").tobytes()
            row = [part, block, first, len(names), len(ids), known, lengths, control, data]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, types)],
                ["part", "block", "first", "n_docs", "n_ids", "doc_ids", "lengths", "control", "data"])

        for batch in slices(batches, "ids"):
            for name, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                names.append(name)
                parts.append(np.frombuffer(ids, dtype))
                held += len(parts[-1])
                if held >= BLOCK_IDS:
                    yield close()
                    block, first, held = block + 1, first + held, 0
                    names, parts = [], []
        if names:
            yield close()

    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = tokens.withColumn("_tie", F.xxhash64("ids")).repartitionByRange(files, "doc_id", "_tie")
    ordered.sortWithinPartitions("doc_id", "_tie").select("doc_id", "ids").mapInArrow(write, _BLOCKS).write.option(
        "compression", "none").parquet(f"{folder}/blocks")


def read_token_files(spark: SparkSession, folder: str, keep_ids: bool = True) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 (crc32 of its ids as little-endian unsigned 32-bit) and, if asked for, those ids.

    The only running sum over more than a block is over the number of files.
    """
    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks")
    back = spark.read.parquet(f"{folder}/ranks")
    ids_of_rank = back.orderBy("rank").toPandas()["id"].to_numpy().astype("<u4")  # one row per vocabulary entry
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "data", FEW_CHARACTERS):
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
                ids = ids_of_rank[decode_ranks(row["control"], row["data"], row["n_ids"])]
                ends = np.cumsum(lengths)
                n = len(lengths)
                names = np.frombuffer(row["doc_ids"][: 8 * n], "<i8")
                unknown = np.frombuffer(row["doc_ids"][8 * n :], np.bool_)
                found = [ids[e - k : e].tobytes() for e, k in zip(ends, lengths)]
                columns = [pa.array(names, pa.int64(), mask=unknown), pa.array(ends - lengths + row["first"] + row["offset"]),
                           pa.array(lengths), pa.array([zlib.crc32(f) for f in found], pa.int64())]
                if keep_ids:
                    columns.append(pa.array(found, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + keep_ids])

    tasks = max(spark.sparkContext.defaultParallelism, -(-blocks.rdd.getNumPartitions() // FILES_A_TASK))
    return blocks.coalesce(tasks).join(F.broadcast(offsets), "part").mapInArrow(read, schema)


def through_files(docs: DataFrame, path: str, end_id: int = 2, keep_ids: bool = True) -> DataFrame:
    """Write the files into the shared folder and read them back."""
    folder = new_dir(docs.sparkSession, "token-files")
    write_token_files(docs, path, folder, end_id)
    return read_token_files(docs.sparkSession, folder, keep_ids)
