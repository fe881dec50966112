"""Ranked lexical search by presence masks.

Documents are read once and kept as lists of the asked terms they hold. A task lays a block of them out
as a matrix of terms by documents. For an item, bits of its terms form a mask for each document; documents
of one mask share a greatest possible score, the sum of what their terms give at best in the block. Masks are
scored by descending greatest score, until none left can reach the item's last rank so far.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from accrete.llm.frames import slices
from accrete.llm.terms import LETTERS_AND_DIGITS, Terms, counted, found_in
from accrete.llm.tokenizing import forget_chunks
from accrete.session import BROADCAST_BYTES, staged

# Cells of one matrix of terms by documents, and documents of a block at most.
CELLS, DOCS = 1 << 23, 2048
# Documents scored before the limit is looked at again.
STEP = 64
# Partial rankings merged in one group of the first round.
SALTS = 64
# Stands for a null id, so that it comes last among equal scores.
NO_ID = (1 << 63) - 1


@dataclass
class Questions:
    """Items as places in the sorted `keys` (digests of their terms), with how often each occurs."""

    ids: list[int | None]
    columns: list[np.ndarray]
    times: list[np.ndarray]
    keys: np.ndarray


def _read_items(items: DataFrame) -> DataFrame:
    """(item, item_id, terms): the digests of each item that has terms; every row is an item of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            terms = Terms(batch.column("text"), LETTERS_AND_DIGITS)
            ends = np.searchsorted(terms.doc, np.arange(terms.docs + 1))
            digests = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(terms.digest.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), digests], ["item_id", "terms"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(run, "item_id long, terms array<long>").where(F.size("terms") > 0)
    return staged(found.withColumn("item", F.monotonically_increasing_id()), "items")


def _questions(items: DataFrame) -> Questions:
    rows = items.orderBy("item").collect()
    keys = np.unique(np.array([t for r in rows for t in r["terms"]], np.int64))
    columns, times = [], []
    for r in rows:
        own, n = np.unique(np.array(r["terms"], np.int64), return_counts=True)
        columns.append(np.searchsorted(keys, own))
        times.append(n)
    return Questions([r["item_id"] for r in rows], columns, times, keys)


def matches(docs: DataFrame, keys: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with terms: how many it has, and the places in `keys`
    of those asked for with their occurrences."""
    shipped = docs.sparkSession.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_chunks()
        for batch in slices(batches, "text"):
            terms = Terms(batch.column("text"), LETTERS_AND_DIGITS)
            known, at = found_in(shipped.value, terms.digest.view(np.int64))
            (doc, term), (tf,) = counted([terms.doc[known], at[known]], [np.ones(int(known.sum()), np.int64)])
            ends = pa.array(np.searchsorted(doc, np.arange(terms.docs + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(c, pa.int32())) for c in (term, tf)]
            n = np.bincount(terms.doc, minlength=terms.docs)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), *lists], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>").where("n > 0")


def grouped(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, group) of the columns of a boolean matrix: a column of each distinct mask, and the
    number of the mask of every column. Masks are compared as 64-bit words."""
    bits = np.packbits(present, axis=0)
    whole = np.zeros((-(-len(bits) // 8) * 8, bits.shape[1]), np.uint8)
    whole[: len(bits)] = bits
    words = np.ascontiguousarray(whole.T).view(np.uint64)
    if words.shape[1] == 1:
        _, first, group = np.unique(words[:, 0], return_index=True, return_inverse=True)
        return first, group
    order = np.lexsort(words.T)
    new = np.concatenate([[True], (words[order[1:]] != words[order[:-1]]).any(axis=1)])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return order[new], group


class Ranking:
    """The best documents of one item so far, and the score that the next one must reach."""

    def __init__(self, top: int):
        self.top, self.limit = top, 1
        self.scores = self.docs = np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        fit = scores >= self.limit
        scores, docs = np.concatenate([self.scores, scores[fit]]), np.concatenate([self.docs, docs[fit]])
        order = np.lexsort((docs, -scores))[: self.top]
        self.scores, self.docs = scores[order], docs[order]
        if len(order) == self.top:
            self.limit = int(self.scores[-1])

    def block(self, part: np.ndarray, weights: np.ndarray, docs: np.ndarray) -> int:
        """Rank a block: `part` is terms by documents, `weights` of the terms. Gives the number of
        documents that were scored."""
        present = part > 0
        held = np.flatnonzero(present.any(axis=0))
        if not len(held):
            return 0
        part = part[:, held].astype(np.int64)
        first, group = grouped(present[:, held])
        most = (weights * part.max(axis=1)) @ present[:, held[first]]
        members = np.argsort(group, kind="stable")
        ends = np.cumsum(np.bincount(group))
        waiting, scored = [], 0
        for mask in np.argsort(-most, kind="stable"):
            if most[mask] < self.limit:
                break
            waiting.append(members[ends[mask - 1] if mask else 0 : ends[mask]])
            if sum(map(len, waiting)) >= STEP:
                scored += self._score(part, weights, docs[held], waiting)
        if waiting:
            scored += self._score(part, weights, docs[held], waiting)
        return scored

    def _score(self, part: np.ndarray, weights: np.ndarray, docs: np.ndarray, waiting: list[np.ndarray]) -> int:
        which = np.concatenate(waiting)
        waiting.clear()
        self.add(weights @ part[:, which], docs[which])
        return len(which)


def _ranked(spark: SparkSession, found: DataFrame, asked: Questions, top: int) -> DataFrame:
    """(item, doc_id, score): the best `top` of each task."""
    n, length = found.agg(F.count(F.lit(1)), F.sum("n")).first()
    # One row per asked term.
    df = np.zeros(len(asked.keys), np.int64)
    for r in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[r["term"]] = r["count"]
    weight = np.floor(1000 * np.log((2 * (n or 0) + 2) / (2 * df + 1))).astype(np.int64)
    weights = [weight[c] * t for c, t in zip(asked.columns, asked.times)]
    shipped = spark.sparkContext.broadcast((asked.columns, weights, len(asked.keys)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_chunks()
        columns, weights, keys = shipped.value
        best = [Ranking(top) for _ in columns]
        step = max(1, min(DOCS, CELLS // max(keys, 1)))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                m = 75 + 25 * batch.column("n").to_numpy() * n // length
                terms, tf = batch.column("terms"), batch.column("tfs").flatten().to_numpy().astype(np.int64)
                doc = np.repeat(np.arange(batch.num_rows), np.asarray(terms.value_lengths()))
                part = np.zeros((keys, batch.num_rows), np.int32)
                part[terms.flatten().to_numpy(), doc] = 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])
                docs = batch.column("doc_id").to_numpy()
                for ranking, own, w in zip(best, columns, weights):
                    ranking.block(part[own], w, docs)
        sizes = [len(b.docs) for b in best]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(best)), sizes)), pa.array(np.concatenate([b.docs for b in best])),
                 pa.array(np.concatenate([b.scores for b in best]))], ["item", "doc_id", "score"])

    return found.where(F.size("terms") > 0).mapInArrow(run, "item long, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = 20, limit_bytes: int = BROADCAST_BYTES // 4) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of highest score above 0 for each row of `items`.

    Terms are runs of 0-9, A-Z and characters beyond ASCII, A-Z lower-cased, over whole texts; a null or
    empty text has none. Equal scores are ranked by ascending doc_id, a null id last; repeated documents and
    repeated items are each ranked for themselves. An empty table on either side gives no rows. Other columns
    are not read. Items whose terms are above `limit_bytes` together are answered in blocks below it. Terms
    are compared by 64-bit digests.
    """
    spark, asked = docs.sparkSession, _read_items(items)
    size = asked.agg(F.sum(F.size("terms") * 8 + 64)).first()[0] or 0
    blocks, results = -(-size // limit_bytes), []
    for block in range(blocks):
        questions = _questions(asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block))
        if questions.ids:
            found = staged(matches(docs, questions.keys), "matches")
            ids = spark.createDataFrame(list(enumerate(questions.ids)), "item long, item_id long")
            partial = _ranked(spark, found, questions, top).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
            for keys in (["item", "salt"], ["item"]):
                order = Window.partitionBy(*keys).orderBy(F.desc("score"), "doc_id")
                partial = partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            results.append(partial.join(ids, "item").select(
                "item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score"))
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionByName(more)
    return whole
