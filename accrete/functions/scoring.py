"""Answer scoring as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from accrete.functions.text import normalise_answer

# Fixed value: this many agreeing truths make an answer fully right.
FULL_MATCHES = 3.0


def normalised_truths(truths: Column) -> Column:
    return F.transform(truths, normalise_answer)


def score_against(prediction: Column, normalised: Column, count: Column | None = None) -> Column:
    """`answer_score` against truths already normalised: a table's truths are normalised once."""
    others = F.array_remove(normalised, normalise_answer(prediction))
    agreeing = F.coalesce((F.size(normalised) if count is None else count) - F.size(others), F.lit(0))
    score = F.least(agreeing / F.lit(FULL_MATCHES), F.lit(1.0))
    return F.when(F.coalesce(prediction, F.lit("")) == "", 0.0).otherwise(score)


def answer_score(prediction: Column, truths: Column) -> Column:
    """min(agreeing truths / 3, 1); a null or empty prediction scores 0."""
    return score_against(prediction, normalised_truths(truths), F.size(truths))
