"""A profile of a growing table, kept as mergeable summaries of its parts.

Parts never change, so each is summarised once and the summary is written beside it: value histograms
of columns with values worth counting, and HyperLogLog and KLL sketches of the others. Reading the
profile merges the summaries; after an append only the new part is read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrete.operators.rank import cumulative
from accrete.operators.table import FeatureTable

SCHEMA = "column string, number long, word string, n long, distinct binary, quantiles binary, part string"


def summarised(rows: DataFrame, counted: list[str], sketched: list[str]) -> DataFrame:
    """(column, number, word, n, distinct, quantiles): for each counted column a row per value, integers as
    `number`, others as `word`; for each sketched integer column one row with n, its non-null values."""
    pieces = []
    if counted:
        kind = dict(rows.dtypes)
        values = [F.struct(F.lit(c).alias("column"), *(
            (F.col(c).cast("long").alias("number"), F.lit(None).cast("string").alias("word")) if kind[c] in ("tinyint", "smallint", "int", "bigint")
            else (F.lit(None).cast("long").alias("number"), F.col(c).cast("string").alias("word")))) for c in counted]
        none = F.lit(None).cast("binary")
        pieces.append(rows.select(F.inline(F.array(*values))).groupBy("column", "number", "word").agg(
            F.count(F.lit(1)).alias("n"), F.first(none).alias("distinct"), F.first(none).alias("quantiles")))
    if sketched:
        one = rows.agg(*[f for i, c in enumerate(sketched) for f in (
            F.count(c).alias(f"n{i}"), F.hll_sketch_agg(F.col(c).cast("long")).alias(f"d{i}"),
            F.kll_sketch_agg_bigint(F.col(c).cast("long")).alias(f"q{i}"))])
        entries = [F.struct(
            F.lit(c).alias("column"), F.lit(None).cast("long").alias("number"), F.lit(None).cast("string").alias("word"),
            F.col(f"n{i}").alias("n"), F.col(f"d{i}").alias("distinct"), F.col(f"q{i}").alias("quantiles")) for i, c in enumerate(sketched)]
        pieces.append(one.select(F.inline(F.array(*entries))))
    return pieces[0].unionByName(pieces[1]) if len(pieces) == 2 else pieces[0]


class Profile:
    """Profile of raw columns of a FeatureTable; `counted` exactly, `sketched` (integers) approximately."""

    def __init__(self, table: FeatureTable, counted: list[str], sketched: list[str] = ()):
        unknown = [c for c in [*counted, *sketched] if c not in table.raw_schema.names]
        if unknown or not [*counted, *sketched]:
            raise KeyError(f"no such raw columns: {unknown}")
        self.table, self.counted, self.sketched = table, list(counted), list(sketched)
        told = hashlib.sha256(repr((self.counted, self.sketched)).encode()).hexdigest()[:12]
        self.place = f"{table.manifest['base']}/summary-{told}"

    def refresh(self) -> list[str]:
        """Summarise the parts that have no summary yet, and give their names."""
        there = {n.removeprefix("part=") for n in self.table.folder.files(*self.place.split("/"))}
        new = [p for p in self.table.manifest["parts"] if p["name"] not in there and p["rows"]]
        for part in new:
            rows = self.table.part_rows(part["name"], [*self.counted, *self.sketched])
            self.table.put_small(summarised(rows, self.counted, self.sketched), self.place, part["name"])
        return [p["name"] for p in new]

    def rows(self) -> DataFrame:
        """The summaries of all parts of the table, brought up to date first."""
        self.refresh()
        parts = [p["name"] for p in self.table.manifest["parts"] if p["rows"]]
        if not parts:
            return self.table.spark.createDataFrame([], SCHEMA)
        return self.table.small_files(self.place, parts, SCHEMA)

    def value_counts(self, column: str) -> DataFrame:
        """(value, count) of a counted column, nulls included, most frequent first and equal counts by value."""
        kind = self.table.raw_schema[column].dataType
        found = self._of(column, self.counted).groupBy("number", "word").agg(F.sum("n").alias("count"))
        value = F.coalesce("word", F.col("number").cast("string")).cast(kind).alias("value")
        return found.select(value, "count").orderBy(F.desc("count"), "value")

    def distinct_values(self, column: str) -> DataFrame:
        """(distinct_values, rows): exact for a counted column, else by merged sketches over non-null values."""
        if column in self.counted:
            found = self.value_counts(column)
            return found.agg(F.count("value").alias("distinct_values"), F.coalesce(F.sum("count"), F.lit(0)).alias("rows"))
        return self._of(column, self.sketched).agg(
            F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_values"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))

    def int_median(self, column: str) -> DataFrame:
        """(column, median) of a counted integer column, halves cut off towards zero; nulls are skipped."""
        values = self._of(column, self.counted).where(F.col("number").isNotNull()).groupBy("number").agg(F.sum("n").alias("n"))
        total = values.agg(F.sum("n")).first()[0] or 0
        covers = (F.col("below") < total // 2 + 1) & (F.col("upto") >= (total + 1) // 2)
        middle = cumulative(values, "number", "n").where(covers)
        return middle.agg(((F.min("number") + F.max("number")) / 2).cast("bigint").alias("median")).select(F.lit(column).alias("column"), "median")

    def clipped_histogram(self, column: str, width: int, cap: int) -> DataFrame:
        """(bin, count) of a counted integer column in bins of `width` from 0, values beyond the last in it."""
        at = F.least(F.floor(F.col("number") / width), F.lit(cap)).cast("int").alias("bin")
        return self._of(column, self.counted).where(F.col("number") >= 0).groupBy(at).agg(F.sum("n").alias("count"))

    def quantile(self, column: str, share: float) -> DataFrame:
        """(column, quantile) of a sketched column by merged KLL sketches."""
        merged = self._of(column, self.sketched).where("n > 0").agg(F.kll_merge_agg_bigint("quantiles").alias("q"))
        return merged.select(F.lit(column).alias("column"), F.kll_sketch_get_quantile_bigint("q", F.lit(float(share))).alias("quantile"))

    def _of(self, column: str, known: list[str]) -> DataFrame:
        if column not in known:
            raise KeyError(f"not a column of this kind in the profile: {column}")
        return self.rows().where(F.col("column") == column)
