"""Benchmark decontamination by winnowing, in SQL functions only.

A window is `window` consecutive words. Of the k-grams inside each window the smallest hash is its
fingerprint, on both sides; a shared window therefore always shares a fingerprint, while a document
sends only its distinct fingerprints, about two in seven positions, to the join. Hits are extended
to the windows that hold them and verified word by word. Items shorter than a window are one window
of their own length; for each such length that occurs (at most window - 1), documents also send the
hashes of their runs of that length.

Documents are read once: the join with the benchmark happens while their words are at hand, and
only hits travel. The benchmark is broadcast in blocks of a checked size, one pass over the
documents each.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrete.llm.frames import identified, same_row, unwrapped
from accrete.session import BROADCAST_BYTES, staged

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Anything but 0-9, a-z and characters beyond ASCII.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased and nothing else; none for null."""
    plain = F.octet_length(text) == F.char_length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), _BETWEEN), "")


def _after(values: Column, i: Column, count: int) -> list[Column]:
    return [F.get(values, i + j) for j in range(1, count)]


def _grams(hashes: Column, n: Column, length: int) -> Column:
    """Hash of each run of `length` word hashes."""
    runs = F.transform(hashes, lambda x, i: F.xxhash64(F.lit(length), x, *_after(hashes, i, length)))
    return F.slice(runs, 1, F.greatest(n - (length - 1), F.lit(0)))


def _prints(rows: DataFrame, window: int, k: int, short: list[int]) -> DataFrame:
    """Add `words`, `n` and, per level (window, or a short length), an array of the fingerprint of
    every run: column `at_<level>`, the run's start being its place."""
    rows = rows.withColumn("words", words_of(F.col("text"))).drop("text")
    rows = rows.withColumn("n", F.size("words")).withColumn("_h", F.transform("words", lambda w: F.xxhash64(w)))
    rows = rows.withColumn("_g", _grams(F.col("_h"), F.col("n"), k))
    g = F.col("_g")
    least = F.transform(g, lambda x, i: F.least(x, *_after(g, i, window - k + 1)))
    rows = rows.withColumn(f"at_{window}", F.slice(least, 1, F.greatest(F.col("n") - (window - 1), F.lit(0))))
    for length in short:
        rows = rows.withColumn(f"at_{length}", _grams(F.col("_h"), F.col("n"), length))
    return rows.drop("_h", "_g")


def _run_text(words: Column, start: Column, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start + 1, length), " ")


def benchmark_windows(benchmark: DataFrame, window: int, k: int) -> DataFrame:
    """(level, print, run, items): each distinct window text with its fingerprint and item ids."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where(F.size(words_of(F.col("text"))) > 0)
    lengths = items.select(F.size(words_of(F.col("text"))).alias("n")).where(F.col("n") < window).distinct()
    short = sorted(r["n"] for r in lengths.collect())  # fewer than `window` values
    marked = _prints(items, window, k, short)
    level = F.least("n", F.lit(window))
    prints = reduce(lambda c, s: c.when(F.col("_level") == s, F.col(f"at_{s}")), short,
                    F.when(F.col("_level") == window, F.col(f"at_{window}")))
    runs = marked.withColumn("_level", level).select("item_id", "words", "_level", F.posexplode(prints).alias("_start", "print"))
    return runs.select(
        F.col("_level").alias("level"), "print", _run_text(F.col("words"), F.col("_start"), F.col("_level")).alias("run"), "item_id",
    ).groupBy("level", "print", "run").agg(F.collect_set("item_id").alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, k: int = 5) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, content (hash of the text), n_words, n_hit
    (words inside an occurrence of a benchmark window), items (sorted ids, as text, of the items with
    occurring windows) and spans (start and length in words of the hit windows).

    Null and empty texts have no words and no hits; items without words never match. Repeated rows
    and ids are answered row by row; a null item id counts for hits but is no item. Other columns are
    left out. An empty benchmark hits nothing.
    """
    windows = staged(benchmark_windows(benchmark, window, k), "windows")
    size = windows.agg(F.count(F.lit(1)), F.sum(F.length("run") + 64 + 16 * F.size("items"))).first()
    passes = max(1, math.ceil((size[1] or 0) / (BROADCAST_BYTES // 4)))
    short = sorted(r["level"] for r in windows.where(F.col("level") < window).select("level").distinct().collect())
    levels = [window, *short]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("*", F.xxhash64("text").alias("content"), F.monotonically_increasing_id().alias("_row"))
    if passes > 1:
        rows = staged(rows, "documents")  # so that a row has one number in all passes
    marked = _prints(rows, window, k, short)
    found = [_hits(marked, windows.where(F.pmod("print", F.lit(passes)) == p), levels, p == 0) for p in range(passes)]
    # Each row of the documents comes once without a hit, for its own sake, and once per hit.
    hits = reduce(DataFrame.unionByName, found)
    grouped = hits.groupBy("_row").agg(
        F.max("doc_id").alias("doc_id"), F.max("content").alias("content"), F.max("n").cast("long").alias("n_words"),
        F.sort_array(F.collect_set(F.struct("start", "length"))).alias("_spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("_items"))
    spans = F.filter("_spans", lambda s: s["length"].isNotNull())
    covered = F.aggregate(
        spans, F.struct(F.lit(0).alias("hit"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["hit"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(s["start"], a["end"]))).alias("hit"),
            F.greatest(a["end"], s["start"] + s["length"]).alias("end")),
        lambda a: a["hit"])
    return grouped.select(
        "doc_id", "content", "n_words", covered.cast("long").alias("n_hit"),
        F.sort_array(F.filter("_items", lambda x: x.isNotNull())).alias("items"), spans.alias("spans"))


def _hits(marked: DataFrame, windows: DataFrame, levels: list[int], own: bool) -> DataFrame:
    """Rows (_row, doc_id, content, n, start, length, items): the verified windows of one block, and
    with `own` one row without a window per document."""
    pair = "struct<level: int, print: bigint>"

    def prints(s: int) -> Column:
        return F.transform(F.array_distinct(f"at_{s}"), lambda p: F.struct(F.lit(s).alias("level"), p.alias("print")))

    sent = [prints(s) for s in levels]
    if own:
        sent.insert(0, F.array(F.struct(F.lit(0).alias("level"), F.lit(0).cast("long").alias("print"))))
    kept = ["_row", "doc_id", "content", "n", "words", *(f"at_{s}" for s in levels)]
    exploded = marked.select(*kept, F.explode(F.concat(*(c.cast(f"array<{pair}>") for c in sent))).alias("_sent"))
    known = windows.select(F.col("level").alias("_level"), F.col("print").alias("_print")).distinct()
    if own:
        known = known.unionByName(marked.sparkSession.range(1).select(
            F.lit(0).alias("_level"), F.lit(0).cast("long").alias("_print")))
    met = exploded.join(
        F.broadcast(known), (F.col("_sent.level") == F.col("_level")) & (F.col("_sent.print") == F.col("_print")), "left_semi")
    level, words = F.col("_sent.level"), F.col("words")

    def places(s: int) -> Column:
        found = F.filter(F.transform(f"at_{s}", lambda p, i: F.when(p == F.col("_sent.print"), i)), lambda i: i.isNotNull())
        return F.transform(found, lambda i: F.struct(i.alias("start"), _run_text(words, i, s).alias("run")))

    runs = reduce(lambda c, s: c.when(level == s, places(s)), levels[1:], F.when(level == levels[0], places(levels[0])))
    spread = met.select("_row", "doc_id", "content", "n", level.alias("level"), F.explode_outer(runs).alias("_run"))
    texts = windows.groupBy("level", "run").agg(F.flatten(F.collect_list("items")).alias("items"))
    verified = spread.withColumn("run", F.col("_run.run")).join(F.broadcast(texts), ["level", "run"], "left")
    is_hit = F.col("items").isNotNull()
    return verified.where(is_hit | (F.col("level") == 0)).select(
        "_row", "doc_id", "content", "n", F.when(is_hit, F.col("_run.start")).alias("start"),
        F.when(is_hit, F.col("level")).alias("length"), "items")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, k: int = 5) -> DataFrame:
    """The rows of `docs` in which no benchmark window occurs; all columns stay."""
    hit = staged(contamination(docs, benchmark, window, k).where("n_hit > 0").select("doc_id", "content").distinct(), "contaminated")
    return identified(docs).join(hit, same_row(hit), "left_anti").select(*unwrapped(docs))
