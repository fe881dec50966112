"""Language identification by error-correcting output codes over character n-grams.

Each language has a codeword of signs; one binary classifier per bit tells the languages with a
plus from those with a minus. A classifier is a table of log-odds of hashed byte trigrams of the
lower-cased text, estimated from counts over all learning rows, so a prediction is one histogram
and one matrix product. Decoding is loss-weighted: for each language, the exponential losses of
its signs against the margins, each bit weighted by how well it separates the languages, are
summed, and the smallest sum wins. Two close sums mean an ambiguous text.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from accrete.llm.frames import FEW_CHARACTERS, slices
from accrete.llm.tokenizing import forget_chunks

# Buckets of the trigram hash.
BUCKETS = 1 << 14
# Added to every count.
PRIOR = 0.5
# Log-odds beyond this are cut, so that no single trigram decides a text.
CLIP = 4.0
# Sharpness of the exponential loss and of the score.
SHARPNESS = 2.0
# A second language within this share of the score makes a prediction ambiguous.
AMBIGUOUS = 0.2

UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def trigram_counts(text: str) -> np.ndarray:
    """Histogram of the hashed byte trigrams of the lower-cased text, a space at each end."""
    raw = np.frombuffer(f" {text.lower()} ".encode(), np.uint8).astype(np.uint32)
    mixed = raw[:-2] * np.uint32(0x9E3779B1) + raw[1:-1] * np.uint32(0x85EBCA77) + raw[2:] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    return np.bincount(mixed >> np.uint32(32 - BUCKETS.bit_length() + 1), minlength=BUCKETS)


def codewords(languages: int) -> np.ndarray:
    """Signs (languages x bits). Up to six languages: all different splits of them, which is the
    code of largest distance (2^(n-2) for n languages). More: the best of many seeded random codes
    of about 10 log2(n) bits, by smallest distance between any two words."""
    if languages <= 1:
        return np.ones((languages, 1))
    if languages <= 6:
        splits = [(1, *rest) for rest in itertools.product((1, -1), repeat=languages - 1)]
        return np.array([s for s in splits if -1 in s], float).T
    bits, best, distance = int(np.ceil(10 * np.log2(languages))), None, -1
    random = np.random.default_rng(0)
    for _ in range(200):
        code = np.where(random.random((languages, bits)) < 0.5, -1.0, 1.0)
        code = code[:, np.abs(code.sum(axis=0)) < languages]
        gaps = (code.shape[1] - code @ code.T) / 2 + np.eye(languages) * bits
        if gaps.min() > distance:
            best, distance = code, gaps.min()
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # languages x bits
    odds: np.ndarray  # buckets x bits
    middle: np.ndarray  # bits: margin halfway between the two sides
    spread: np.ndarray  # bits: from there to the nearest language of either side
    weight: np.ndarray  # bits: share in the decoding

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Score of each language (rows sum to one) for rows of trigram counts."""
        if len(self.languages) == 1:
            return np.ones((len(counts), 1))
        margins = (counts @ self.odds / np.maximum(counts.sum(axis=1, keepdims=True), 1) - self.middle) / self.spread
        # Cut margins bound the loss of a bit that is far on the wrong side.
        margins = np.clip(margins, -3, 3)
        loss = np.exp(-self.code[None, :, :] * margins[:, None, :]) @ self.weight
        raised = np.exp(-SHARPNESS * (loss - loss.min(axis=1, keepdims=True)))
        return raised / raised.sum(axis=1, keepdims=True)


def model_of(languages: list[str], counts: np.ndarray) -> LanguageModel:
    """Model from trigram counts (languages x buckets)."""
    code = codewords(len(languages))
    shares = (counts + PRIOR) / (counts + PRIOR).sum(axis=1, keepdims=True)
    odds, middle, spread = [], [], []
    for signs in code.T:
        plus, minus = shares[signs > 0], shares[signs < 0]
        if not len(plus) or not len(minus):
            odds.append(np.zeros(BUCKETS)), middle.append(0.0), spread.append(1.0)
            continue
        # Every language counts alike, however many texts it has.
        column = np.clip(np.log(plus.mean(axis=0)) - np.log(minus.mean(axis=0)), -CLIP, CLIP)
        expected = shares @ column
        low, high = expected[signs < 0].max(), expected[signs > 0].min()
        odds.append(column)
        middle.append((low + high) / 2)
        spread.append(max((high - low) / 2, 1e-3))
    weight = np.array(spread)
    return LanguageModel(languages, code, np.array(odds).T, np.array(middle), np.array(spread), weight / weight.sum())


def learn_languages(docs: DataFrame) -> LanguageModel:
    """Learn from all rows of `docs` (text, lang) with a non-null lang and a text.

    Each task adds up one histogram per language; they are summed per language and cell, so what
    reaches the driver is one number per language and bucket. No rows: a model of no language.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_chunks()
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text", FEW_CHARACTERS):
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                found = trigram_counts(text)
                sums[lang] = sums[lang] + found if lang in sums else found
        for lang, total in sums.items():
            cells = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(cells), pa.string()), pa.array(cells), pa.array(total[cells])], ["lang", "cell", "n"])

    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    found = (
        rows.where("text is not null and lang is not null").mapInArrow(count, "lang string, cell long, n long")
        .groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    )
    languages = sorted(found["lang"].unique())
    counts = np.zeros((len(languages), BUCKETS))
    counts[found["lang"].map({l: i for i, l in enumerate(languages)}).to_numpy(int), found["cell"].to_numpy(int)] = found["n"]
    return model_of(languages, counts)


def identify_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """All columns of `docs` and lang_pred string, score double (0 to 1) and ambiguous boolean.

    A text that is null or has no letter is `und` with score 0; so is every text if the model knows
    no language. Ties go to the language that sorts first. Texts are read whole. Columns of `docs`
    with those three names are replaced. Rows are answered one by one, whatever their ids.
    """
    new = ["lang_pred", "score", "ambiguous"]
    kept = docs.drop(*new)
    schema = StructType([*kept.schema.fields, *StructType.fromDDL("lang_pred string, score double, ambiguous boolean").fields])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_chunks()
        for batch in slices(batches, "text", FEW_CHARACTERS):
            texts = batch.column("text").to_pylist()
            names, scores, unsure = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
            known = [i for i, t in enumerate(texts) if t is not None and _LETTER.search(t)] if model.languages else []
            for low in range(0, len(known), 64):
                rows = known[low : low + 64]
                found = model.scores(np.stack([trigram_counts(texts[i]) for i in rows]).astype(np.float32))
                best = found.argmax(axis=1)
                ranked = np.sort(found, axis=1)
                scores[rows] = ranked[:, -1]
                if found.shape[1] > 1:
                    unsure[rows] = ranked[:, -1] - ranked[:, -2] < AMBIGUOUS
                for i, b in zip(rows, best):
                    names[i] = model.languages[b]
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(scores), pa.array(unsure)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *new])

    return kept.mapInArrow(predict, schema)
