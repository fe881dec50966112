"""Divergence of the sources of each language, with terms as digests until the last step.

Shuffles carry fixed-width digests and counts. The text of a term is met twice: for terms that are
kept, tasks compare every occurrence with the first one they saw and send each text once, so that the
least and the greatest string of a digest show a collision, whose terms are then counted apart by
their text; and the few terms of the report get their text back by a join at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accrete.llm.frames import slices
from accrete.llm.terms import LETTERS, Summed, Terms, counted, found_in, spread
from accrete.llm.tokenizing import forget_chunks
from accrete.session import BROADCAST_BYTES, staged

# Unit of the probabilities, and what is added to each count.
UNIT, ADDED = 1_000_000_000, 5
# Sources of a language compared with all others at once inside a task.
SIDE = 1000
# Numbers of one matrix of terms by sources.
CELLS = 1 << 20


def _coded(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents as (language, grp, text) with 64-bit codes, and the groups (lang, source, language, grp).
    Codes are salted anew until no two names share one."""
    named = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    salt = 0
    while True:
        codes = [F.xxhash64(F.lit(salt), "lang").alias("language"), F.xxhash64(F.lit(salt), "lang", "source").alias("grp")]
        groups = staged(named.select("lang", "source").distinct().select("*", *codes), "groups")
        langs = groups.select("lang", "language").distinct()
        whole = groups.count() == groups.select("grp").distinct().count()
        if whole and langs.count() == langs.select("language").distinct().count():
            return named.select(*codes, "text"), groups
        salt += 1


def _small(keys: DataFrame) -> np.ndarray | None:
    """Sorted digests to look for inside tasks, if they are below the size that may be shipped."""
    keys = keys.select("digest").distinct()
    if keys.count() * 8 > BROADCAST_BYTES:
        return None
    return np.sort(keys.toArrow()["digest"].to_numpy().astype(np.int64))


class _Reader:
    """Batches of coded documents as terms, of `wanted` digests only, if given."""

    def __init__(self, docs: DataFrame, bits: int):
        self.docs, self.shift, self.spark = docs, np.uint64(64 - bits), docs.sparkSession

    def rows(self, schema: str, work: Callable, wanted: np.ndarray | None = None) -> DataFrame:
        shift = self.shift
        shipped = None if wanted is None else self.spark.sparkContext.broadcast(wanted)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forget_chunks()

            def read() -> Iterator[tuple]:
                for batch in slices(batches, "text"):
                    terms = Terms(batch.column("text"), LETTERS)
                    digest = (terms.digest >> shift).view(np.int64)
                    which = np.arange(len(digest)) if shipped is None else np.flatnonzero(found_in(shipped.value, digest)[0])
                    codes = [batch.column(c).to_numpy() for c in ("language", "grp")]
                    yield terms, which, digest[which], *(c[terms.doc[which]] for c in codes)

            yield from work(read())

        return self.docs.mapInArrow(run, schema)


def _document_counts(read: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    summed = Summed(["language", "digest", "docs"], 2)
    for terms, which, digest, language, _ in read:
        (_, digest, language), _ = counted([terms.doc[which], digest, language], [])
        yield from summed.add(language, digest, np.ones(len(digest), np.int64))
    yield from summed.rest()


def _group_counts(read: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    summed = Summed(["language", "grp", "digest", "n"], 3)
    for _, _, digest, language, group in read:
        yield from summed.add(language, group, digest, np.ones(len(digest), np.int64))
    yield from summed.rest()


def _same(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether a[a_at : a_at + size] and b[b_at : b_at + size] agree, for each place; sizes are positive."""
    if not len(sizes):
        return np.zeros(0, bool)
    differ = a[spread(a_at, sizes)] != b[spread(b_at, sizes)]
    return ~np.logical_or.reduceat(differ, np.cumsum(sizes) - sizes)


def _texts(read: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """(digest, term): the first text of each digest in the task, and every text unlike the first."""
    known, begin, size, kept = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint8),)

    def rows(terms: Terms, digest: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(digest), terms.strings(places)], ["digest", "term"])

    for terms, which, digest, _, _ in read:
        if not len(which):
            continue
        own, first, back = np.unique(digest, return_index=True, return_inverse=True)
        lengths = terms.stop[which] - terms.start[which]
        like = np.flatnonzero(lengths == lengths[first][back])
        odd = np.ones(len(which), bool)
        odd[like] = ~_same(terms.raw, terms.start[which[like]], terms.raw, terms.start[which[first]][back[like]], lengths[like])
        if odd.any():
            yield rows(terms, digest[odd], which[odd])
        seen, at = found_in(known, own)
        begins, sizes = terms.start[which[first]], lengths[first]
        like = np.flatnonzero(seen)
        like = like[sizes[like] == size[at[like]]]
        new = np.ones(len(own), bool)
        new[like] = ~_same(terms.raw, begins[like], kept, begin[at[like]], sizes[like])
        if new.any():
            yield rows(terms, own[new], which[first[new]])
        fresh = ~seen
        merged = np.concatenate([known, own[fresh]])
        order = np.argsort(merged)
        begin = np.concatenate([begin, len(kept) + np.cumsum(sizes[fresh]) - sizes[fresh]])[order]
        size, known = np.concatenate([size, sizes[fresh]])[order], merged[order]
        kept = np.concatenate([kept, terms.raw[spread(begins[fresh], sizes[fresh])]])


def _text_counts(read: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """(language, grp, digest, term, n, docs) by the text of the term."""
    for terms, which, digest, language, group in read:
        strings = terms.strings(which).to_pylist()
        found: dict[tuple, list[int]] = {}
        last: dict[tuple, int] = {}
        for at, doc in enumerate(terms.doc[which].tolist()):
            key = (int(language[at]), int(group[at]), int(digest[at]), strings[at])
            n = found.setdefault(key, [0, 0])
            n[0] += 1
            n[1] += last.get(key) != doc
            last[key] = doc
        if found:
            columns = [*zip(*found), *zip(*found.values())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in columns], ["language", "grp", "digest", "term", "n", "docs"])


def kept_terms(docs: DataFrame, least: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """(language, digest, split, held, total) of the terms in at least `least` documents of a language:
    `held` lists its groups with their counts, `split` is the term where its digest is another's too and
    else empty; and (digest, term) of the digests that are one term's alone.

    Much is shuffled and little is left, so what is written is dealt anew first: the number of files follows
    what is left. Where Hadoop has no native library, each file costs a process started by the executor."""
    reader = _Reader(docs, bits)
    common = staged(
        reader.rows("language long, digest long, docs long", _document_counts)
        .groupBy("language", "digest").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least)
        .select("language", "digest").repartition("digest"), "common")
    wanted = _small(common)

    texts = reader.rows("digest long, term string", _texts, wanted)
    if wanted is None:
        texts = texts.join(common.select("digest").distinct(), "digest", "left_semi")
    names = staged(texts.groupBy("digest").agg(F.min("term").alias("term"), F.max("term").alias("most")).repartition("term"), "names")
    collided = names.where(F.col("term") != F.col("most")).select("digest")

    # Rows of a term meet once: sums, the test of being kept and the list of groups need no further shuffle.
    counts = reader.rows("language long, grp long, digest long, n long", _group_counts, wanted).repartition("language", "digest")
    counts = counts.groupBy("language", "digest", "grp").agg(F.sum("n").alias("n")).join(common, ["language", "digest"], "left_semi")
    if collided.isEmpty():
        counts = counts.withColumn("split", F.lit(""))
    else:
        odd = reader.rows("language long, grp long, digest long, term string, n long, docs long", _text_counts, _small(collided))
        odd = staged(
            odd.join(collided, "digest", "left_semi").groupBy("language", "grp", "digest", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "split")
        enough = odd.groupBy("language", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least)
        odd = odd.join(enough.select("language", "term"), ["language", "term"], "left_semi")
        counts = counts.join(collided, "digest", "left_anti").withColumn("split", F.lit("")).unionByName(
            odd.select("language", "grp", "digest", "n", F.col("term").alias("split")))
    held = counts.groupBy("language", "digest", "split").agg(
        F.collect_list(F.struct("grp", "n")).alias("held"), F.sum("n").alias("total"))
    return staged(held.repartition("digest"), "terms"), names.where(F.col("term") == F.col("most")).select("digest", "term")


def _shared(n: Column, mass: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + ADDED) / (mass + ADDED * terms)), exactly."""
    over = (n + ADDED).cast("decimal(19,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.call_function("div", over, (mass + ADDED * terms).cast("decimal(19,0)")) + 1


def shares(n: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """The same for arrays, `mass` with ADDED * terms in it: a long division in steps that stay in 64 bits."""
    whole, left = np.divmod(n + ADDED, mass)
    high, left = np.divmod(left * 100_000, mass)
    return 1 + whole * UNIT + high * 10_000 + left * 10_000 // mass


def _distances(terms: DataFrame, sized: DataFrame) -> DataFrame:
    """(a, b, value) with a < b: the sum of |p - q| over the kept terms of the language of two groups.

    A task lays its terms out as matrices of terms by groups; SIDE groups of a language are compared
    with all of them at once, so no pair is a row before it is a sum."""
    listed = sized.groupBy("language").agg(F.array_sort(F.collect_list(F.struct("grp", "mass"))).alias("groups"))
    sides = F.explode(F.sequence(F.lit(0), F.floor((F.size("groups") - 1) / SIDE).cast("int"))).alias("side")
    params = {r["language"]: r["groups"] for r in listed.collect()}  # the result has a row for each two of them
    shipped = terms.sparkSession.sparkContext.broadcast(
        {k: (np.array([g["grp"] for g in v]), np.array([g["mass"] for g in v])) for k, v in params.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_chunks()
        now, sums = None, None

        def out() -> Iterator[pa.RecordBatch]:
            groups, low = shipped.value[now[0]][0], now[1] * SIDE
            for i in range(sums.shape[0]):
                others = len(groups) - (low + i) - 1
                if others:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(others, groups[low + i])), pa.array(groups[low + i + 1 :]), pa.array(sums[i, low + i + 1 :])],
                        ["a", "b", "value"])

        for batch in batches:
            languages, places = (batch.column(c).to_numpy() for c in ("language", "side"))
            cuts = np.flatnonzero((np.diff(languages) != 0) | (np.diff(places) != 0)) + 1
            for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
                if low == high:
                    continue
                key = (int(languages[low]), int(places[low]))
                groups, mass = shipped.value[key[0]]
                own = slice(key[1] * SIDE, min(key[1] * SIDE + SIDE, len(groups)))
                if key != now:
                    if now is not None:
                        yield from out()
                    now, sums = key, np.zeros((own.stop - own.start, len(groups)), np.int64)
                step = max(1, CELLS // len(groups))
                for at in range(low, high, step):
                    rows = batch.column("held").slice(at, min(step, high - at))
                    flat = rows.flatten()
                    line = np.repeat(np.arange(len(rows)), np.asarray(rows.value_lengths()))
                    n = np.zeros((len(rows), len(groups)), np.int64)
                    n[line, np.searchsorted(groups, flat.field("grp").to_numpy())] = flat.field("n").to_numpy()
                    p = shares(n, mass)
                    for i in range(own.start, own.stop):
                        sums[i - own.start, i:] += np.abs(p[:, i:] - p[:, i : i + 1]).sum(axis=0)
        if now is not None:
            yield from out()

    met = terms.select("language", "digest", "held").join(listed.select("language", sides), "language")
    laid = met.repartition("language", "side", "digest").sortWithinPartitions("language", "side")
    found = laid.select("language", "side", "held").mapInArrow(run, "a long, b long, value long")
    return found.groupBy("a", "b").agg(F.sum("value").alias("value"))


def audit_sources(docs: DataFrame, least: int = 30, top: int = 50, bits: int = 64) -> DataFrame:
    """(lang, source, part, item, value, rank): how far the sources of a language are apart, and the
    terms each source has more of than its language.

    Null lang, source and text count as ''. Terms are runs of letters A-Z and characters beyond ASCII,
    A-Z lower-cased, over whole texts; repeated rows count as often as they occur. A language keeps its
    terms in at least `least` rows. Part `pair` has each other source of the language, part `term` the
    `top` terms with the largest excess; equal values are ranked by item. An empty table gives no rows,
    a language without kept terms the value 0 for each pair. Other columns of `docs` are not read.
    `bits` is the width of the digests; the result does not depend on it.
    """
    coded, groups = _coded(docs)
    terms, names = kept_terms(coded, least, bits)
    masses = terms.select(F.inline("held")).groupBy("grp").agg(F.sum("n").alias("n"))
    languages = terms.groupBy("language").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("all_n"))
    sized = staged(
        groups.join(masses, "grp", "left").join(languages, "language", "left").na.fill(0, ["n", "v", "all_n"])
        .withColumn("mass", F.col("n") + ADDED * F.col("v")), "sizes")

    apart = _distances(terms, sized.where("v > 0"))
    apart = apart.unionByName(apart.select(F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    a, b = sized.select("language", "lang", "source", F.col("grp").alias("a")), sized.select("language", F.col("source").alias("item"), F.col("grp").alias("b"))
    pairs = a.join(b, "language").where("a <> b").join(apart, ["a", "b"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))

    rows = terms.select("digest", "split", "total", F.inline("held")).withColumnRenamed("n", "count").join(sized, "grp")
    rows = rows.select("lang", "source", "digest", "split", (
        _shared(F.col("count"), F.col("n"), F.col("v")) - _shared(F.col("total"), F.col("all_n"), F.col("v"))).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    # Terms as good as the last of the top ones stay until their texts are there to rank them.
    best = rows.where("value > 0").withColumn("place", F.rank().over(by_value)).where(F.col("place") <= top).drop("place")
    told = best.join(names, "digest", "left").withColumn("item", F.when(F.col("split") == "", F.col("term")).otherwise(F.col("split")))
    found = pairs.unionByName(told.select("lang", "source", F.lit("term").alias("part"), "item", "value"))
    ranked = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return found.withColumn("rank", F.row_number().over(ranked)).where((F.col("part") == "pair") | (F.col("rank") <= top))
