"""Before/after evaluation of two sets of predictions against the same truths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrete.functions.scoring import normalised_truths, score_against
from accrete.functions.text import fixed, prefix_text


def scored(truths: DataFrame, base: DataFrame, tuned: DataFrame, key: str, answers: str = "answers",
           prediction: str = "prediction") -> DataFrame:
    """Truths with both predictions and both scores, matched by key; one row per truth.

    A truth without a prediction has a null one, which scores 0. Predictions without a truth are left
    out; two predictions for one key raise.
    """
    both = (
        truths.withColumn("_truths", normalised_truths(F.col(answers)))
        .join(_one_each(base, key, prediction, "base"), key, "left")
        .join(_one_each(tuned, key, prediction, "tuned"), key, "left")
    )
    return (
        both.withColumn("base_score", score_against(F.col("base"), F.col("_truths")))
        .withColumn("tuned_score", score_against(F.col("tuned"), F.col("_truths")))
        .withColumn("tuned_wins", F.col("tuned_score") > F.col("base_score"))
        .drop("_truths")
    )


def _one_each(predictions: DataFrame, key: str, prediction: str, name: str) -> DataFrame:
    """(key, prediction), refusing repeated keys; the count needs no shuffle beyond the join's."""
    repeated = F.raise_error(F.concat(F.lit(f"more than one {name} prediction for "), F.first(key).cast("string")))
    return predictions.groupBy(key).agg(
        F.when(F.count(F.lit(1)) > 1, repeated.cast("string")).otherwise(F.max(prediction)).alias(name))


def accuracy(scores: DataFrame) -> DataFrame:
    """One row: rows, mean scores, lift in points and number of rows where tuned is better."""
    return scores.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg("base_score").alias("base_accuracy"),
        F.avg("tuned_score").alias("tuned_accuracy"),
        ((F.avg("tuned_score") - F.avg("base_score")) * 100).alias("lift_points"),
        F.count_if("tuned_wins").alias("wins"),
    )


def accuracy_text(summary: DataFrame) -> DataFrame:
    return summary.select(
        fixed(F.col("base_accuracy"), 3).alias("base"),
        fixed(F.col("tuned_accuracy"), 3).alias("tuned"),
        fixed(F.col("lift_points"), 1, signed=True, suffix=" pp").alias("lift"),
    )


def comparison(scores: DataFrame, key: str, question: str, answers: str = "answers", truths: int = 5) -> DataFrame:
    """Readable rows: question, both answers, the first truths, and whether tuned is better."""
    return scores.select(
        key, F.col(question).alias("question"), "base", "tuned",
        prefix_text(F.col(answers), truths, ", ").alias("truths"), "base_score", "tuned_score", "tuned_wins",
    )
