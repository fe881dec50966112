"""Toxicity by class-conditional Kneser-Ney word models with a shared backoff.

For each class c (toxic, ordinary)

    P_c(w) = max(N_c(w) - D, 0) / N_c + D * T_c / N_c * P_shared(w)

where N_c(w) is a Kneser-Ney continuation count: the number of different contexts (documents) of
the class that the word occurs in, not its occurrences; T_c is the number of words of the class and
P_shared the continuation counts of both classes pooled. Every counted word has its odds, however
rare: log P_c is interpolated with log P_shared, which cancels between the classes, by the weight
G / (G + EVIDENCE), where G is the statistic of the word's class counts, so that what chance makes
of common words does not add up. A word that was not counted says nothing. The words of most documents are looked up where the
text is read; those that do not fit there are joined with their odds. A text is as toxic as its most
toxic expression: the difference of the log-likelihoods per word, taken over each run of EXPRESSION
neighbouring counted words, the greatest of them put on a 0 to 1 scale by a logistic curve fitted on
labelled rows the counts have not seen. So a long ordinary text around it does not hide an expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from accrete.llm.frames import slices
from accrete.llm.terms import counted, found_in
from accrete.llm.tokenizing import forget_chunks
from accrete.session import BROADCAST_BYTES, staged

DISCOUNT = 0.75
# Neighbouring counted words that are compared together: toxic words thin out in a longer stretch.
EXPRESSION = 2
# G statistic at which a word's own odds weigh half.
EVIDENCE = 8.0
# Words looked up where the text is read, at most, of 16 bytes each.
HELD_WORDS = BROADCAST_BYTES // 16
# Labelled rows that the logistic curve is fitted on, at most: those of smallest id digest.
CALIBRATION_ROWS = 20_000
# Slices of text hashed at once.
HASHED_BYTES = 2_000_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD = np.zeros(256, bool)
_WORD[[*b"abcdefghijklmnopqrstuvwxyz0123456789", *range(0x80, 0x100)]] = True


def _powers(base: int, count: int) -> np.ndarray:
    found = np.full(count, base, np.uint64)
    found[0] = 1
    return np.cumprod(found)


class WordHasher:
    """64-bit hashes of the words of many texts at once, by a running polynomial over their bytes."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def words(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of all texts in order, and the number of words of each text."""
        encoded = [(t or "").lower().encode() for t in texts]
        raw = np.frombuffer(b"\n".join([b"", *encoded, b""]), np.uint8)
        if len(raw) > len(self.up):
            self.up, self.down = _powers(_BASE, len(raw)), _powers(_INVERSE, len(raw))
        inside = _WORD[raw]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, stops = edges[::2], edges[1::2]
        total = np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[: len(raw)])
        found = (total[stops - 1] - total[starts - 1]) * self.down[starts]
        found ^= found >> np.uint64(32)
        found *= np.uint64(0xD6E8FEB86659FD93)
        found ^= found >> np.uint64(32)
        ends = np.cumsum([len(e) + 1 for e in encoded])
        upto = np.searchsorted(starts, ends, "right")
        return found, np.diff(upto, prepend=0)


@dataclass
class ToxicityModel:
    keys: np.ndarray  # word hashes, ascending
    odds: np.ndarray  # log P_toxic(w) / P_ordinary(w)
    slope: float
    middle: float
    rest: DataFrame | None = None  # (word, odds) of the words that are not held

    def measured(self, docs: DataFrame) -> DataFrame:
        """(row, x): each row of `docs` as a struct, and the greatest log-likelihood difference per word that
        an expression of its `text` has (see `greatest`)."""
        keys, odds = self.keys, self.odds
        rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("text").cast("string").alias("text"))
        if self.rest is not None:
            rows = self._with_rest(rows)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forget_chunks()
            hasher = WordHasher()
            for batch in slices(batches, "text", HASHED_BYTES):
                words, counts = hasher.words(batch.column("text").to_pylist())
                text_of = np.repeat(np.arange(len(counts)), counts)
                known, at = found_in(keys, words)
                value = np.where(known, odds[at], 0.0) if len(keys) else np.zeros(len(words))
                if "more" in batch.schema.names:
                    # Each text has its own list of further words: they are told apart by text and word.
                    more = batch.column("more")
                    own = np.repeat(np.arange(len(counts)), np.nan_to_num(np.asarray(more.value_lengths().fill_null(0))))
                    found = more.drop_null().flatten()
                    order = np.lexsort((found.field("word").to_numpy().view(np.uint64), own))
                    pairs = np.rec.fromarrays([own[order], found.field("word").to_numpy().view(np.uint64)[order]])
                    asked = np.rec.fromarrays([text_of, words], dtype=pairs.dtype)
                    place = np.minimum(np.searchsorted(pairs, asked), max(len(pairs) - 1, 0))
                    if len(pairs):
                        also = pairs[place] == asked
                        value[also] = found.field("odds").to_numpy()[order][place[also]]
                        known = known | also
                x = greatest(value[known], text_of[known], len(counts))
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(x)], ["row", "x"])

        return rows.mapInArrow(run, StructType([*rows.select("row").schema.fields, *StructType.fromDDL("x double").fields]))

    def _with_rest(self, rows: DataFrame) -> DataFrame:
        """Rows with the odds of the words of each that are not held; a list has a text's own words at most."""
        keys = self.keys

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forget_chunks()
            hasher = WordHasher()
            for batch in slices(batches, "text", HASHED_BYTES):
                words, counts = hasher.words(batch.column("text").to_pylist())
                (text, word), _ = counted([np.repeat(np.arange(len(counts)), counts), words], [])
                out = ~found_in(keys, word)[0]
                text, word = text[out], word[out]
                ends = pa.array(np.searchsorted(text, np.arange(len(counts) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("text"), pa.ListArray.from_arrays(ends, pa.array(word.view(np.int64)))], ["row", "text", "other"])

        schema = StructType([*rows.schema.fields, *StructType.fromDDL("other array<long>").fields])
        found = staged(rows.mapInArrow(ask, schema).withColumn("at", F.monotonically_increasing_id()), "asked")
        more = found.select("at", F.explode("other").alias("word")).join(self.rest, "word").groupBy("at").agg(
            F.collect_list(F.struct("word", "odds")).alias("more"))
        return found.drop("other").join(more, "at", "left").drop("at")


def greatest(values: np.ndarray, text_of: np.ndarray, texts: int) -> np.ndarray:
    """The greatest mean of EXPRESSION neighbouring values of each text; the mean of all where there are
    fewer, 0 where there is none. `text_of` ascends."""
    total = np.concatenate([[0.0], np.cumsum(values)])
    sizes = np.bincount(text_of, minlength=texts)
    ends = np.cumsum(sizes)
    found = np.where(sizes, (total[ends] - total[ends - sizes]) / np.maximum(sizes, 1), 0.0)
    last = len(values) - EXPRESSION + 1
    if last > 0:
        start = np.flatnonzero(text_of[:last] == text_of[EXPRESSION - 1 :])
        found[sizes >= EXPRESSION] = -np.inf
        np.maximum.at(found, text_of[start], (total[start + EXPRESSION] - total[start]) / EXPRESSION)
    return found


def labelled(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """(doc_id, text, label 0/1) of the rows with a label; an id labelled twice has its larger one."""
    known = labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("label"))
    known = staged(known, "labels")
    if known.count() * 16 <= BROADCAST_BYTES:
        known = F.broadcast(known)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(known, "doc_id")


def split_calibration(known: DataFrame, offered: Column) -> tuple[DataFrame, DataFrame]:
    """`known` as rows to count and rows for the curve: of those `offered`, CALIBRATION_ROWS at most,
    the ones of smallest id digest. No row is in both or in neither."""
    digest = F.xxhash64("doc_id")
    first = known.where(offered).select(digest.alias("d")).orderBy("d").limit(CALIBRATION_ROWS + 1)
    n, last = first.agg(F.count(F.lit(1)), F.max("d")).first()
    curve = offered & (digest < last) if n > CALIBRATION_ROWS else offered
    return known.where(~curve), known.where(curve)


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n0, n1): documents of either class that hold each word, over all rows (text, label).

    Tasks add up what they read in runs of about a million words before anything is shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_chunks()
        hasher, held, size = WordHasher(), [[], []], 0

        def summed() -> pa.RecordBatch:
            keys = np.concatenate([*held[0], *held[1]])
            toxic = np.repeat([0, 1], [sum(map(len, h)) for h in held])
            words, inverse = np.unique(keys, return_inverse=True)
            n1 = np.bincount(inverse, toxic, minlength=len(words)).astype(np.int64)
            n0 = np.bincount(inverse, minlength=len(words)) - n1
            return pa.RecordBatch.from_arrays(
                [pa.array(words.view(np.int64)), pa.array(n0), pa.array(n1)], ["word", "n0", "n1"])

        for batch in slices(batches, "text", HASHED_BYTES):
            words, counts = hasher.words(batch.column("text").to_pylist())
            stops = np.cumsum(counts)
            for low, high, label in zip(stops - counts, stops, batch.column("label").to_pylist()):
                own = np.unique(words[low:high])
                held[label].append(own)
                size += len(own)
            if size >= 1_000_000:
                yield summed()
                held, size = [[], []], 0
        if size:
            yield summed()

    return rows.select("text", "label").mapInArrow(count, "word long, n0 long, n1 long").groupBy("word").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def word_odds(counts: DataFrame, ordinary: int, toxic: int) -> DataFrame:
    """(word, n, odds) of all words: documents that hold it, and log P_toxic(w) / P_ordinary(w),
    weighed by how far its counts are beyond chance, given the documents of either class."""
    n = {0: F.col("n0"), 1: F.col("n1")}
    totals = counts.agg(
        *(F.sum(n[c]).alias(f"total{c}") for c in n), *(F.count_if(n[c] > 0).alias(f"types{c}") for c in n)).first()
    both = n[0] + n[1]
    if not totals["total0"] or not totals["total1"]:
        return counts.select("word", both.alias("n"), F.lit(0.0).alias("odds")).limit(0)
    share = {0: ordinary / (ordinary + toxic), 1: toxic / (ordinary + toxic)}
    g = 2 * sum((F.when(n[c] > 0, n[c] * F.log(n[c] / (both * share[c]))).otherwise(0.0) for c in n), F.lit(0.0))
    weight = F.greatest(g, F.lit(0.0)) / (F.greatest(g, F.lit(0.0)) + EVIDENCE)
    shared = both / (totals["total0"] + totals["total1"])
    p = {c: (F.greatest(n[c] - DISCOUNT, F.lit(0.0)) + DISCOUNT * totals[f"types{c}"] * shared) / totals[f"total{c}"] for c in n}
    return counts.select("word", both.alias("n"), (weight * F.log(p[1] / p[0])).alias("odds"))


def _held(odds: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The words of most documents, HELD_WORDS at most, and the others, if there are any."""
    if odds.count() <= HELD_WORDS:
        return odds, None
    # Documents the next word after the held ones has: words of as many are all joined.
    last = odds.select("n").orderBy(F.desc("n")).limit(HELD_WORDS + 1).agg(F.min("n")).first()[0]
    return odds.where(F.col("n") > last), odds.where(F.col("n") <= last).select("word", "odds")


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and middle of a logistic curve, by Newton steps with a small ridge."""
    scale = x.std() or 1.0
    design, w = np.stack([x / scale, np.ones(len(x))], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        ridge = np.array([1e-3, 1e-6])
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + np.diag(ridge), design.T @ (y - p) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    slope = max(w[0], 1e-6) / scale
    return slope, -w[1] / slope


def learn_toxicity(counted: DataFrame, calibration: DataFrame) -> ToxicityModel:
    """Learn counts from all rows of `counted` and the curve from those of `calibration` (both doc_id,
    text, label), which `split_calibration` keeps to CALIBRATION_ROWS. The model has the odds of every word
    counted. With one class only, or no rows, every score is the share of toxic rows."""
    sizes = counted.groupBy("label").count().collect()
    n = {r["label"]: r["count"] for r in sizes}
    counts = staged(word_counts(counted), "words")
    held, rest = _held(word_odds(counts, n.get(0, 0), n.get(1, 0)))
    # Arrow columns: rows as Python objects would be many times as large.
    found = held.select("word", "odds").toArrow()
    keys = found["word"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    model = ToxicityModel(keys[order], found["odds"].to_numpy().astype(float)[order], 1.0, 0.0, rest)
    del found
    # CALIBRATION_ROWS at most, by `split_calibration`.
    seen = model.measured(calibration.select("text", "label")).select("x", "row.label").toPandas()
    x, y = seen["x"].to_numpy(float), seen["label"].to_numpy(float)
    if len(set(y)) < 2 or not len(keys) and rest is None:
        rate = (n.get(1, 0) + 0.5) / (sum(n.values()) + 1)
        return ToxicityModel(keys[:0], model.odds[:0], 1.0, float(np.log(1 / rate - 1)))
    return ToxicityModel(model.keys, model.odds, *_logistic(x, y), rest)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """All columns of `docs` and score double (0 to 1) and predicted int (1 if score >= 0.5).

    A null text, or one without counted words, has a log-likelihood difference of 0 and the score that goes
    with it. Texts are scored whole, row by row, whatever their ids; columns of `docs` named score
    or predicted are replaced.
    """
    kept = docs.drop("score", "predicted")
    power = F.greatest(F.least(F.lit(float(model.slope)) * (F.col("x") - float(model.middle)), F.lit(30.0)), F.lit(-30.0))
    scored = model.measured(kept).withColumn("score", 1 / (1 + F.exp(-power)))
    columns = [F.col(f"row.`{c}`").alias(c) for c in kept.columns]
    return scored.select(*columns, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
