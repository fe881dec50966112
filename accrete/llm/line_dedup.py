"""Line dedup within an edit, by a deletion-neighbourhood join, in SQL functions only.

Two lines are within one edit exactly if deleting at most one character from each makes them equal.
Each line therefore sends its variants (itself, and itself less one character) as hashed keys, and
lines meet in equal keys: those that miss the same character place differ by a substitution, one
that is a variant of the other by an insertion. A key's lines need not be paired: the earliest line
of a place is within one edit of all others there, so one minimum per key names the witness of
every later line. Witnesses are verified by their edit distance.

Not every line sends every variant. An edit lies in one half of a line, so a line without a half in
common with another has no partner; the rest are cut into blocks, and a line sends variants of a
block only if some other line agrees with it in all but that block. Both sieves are exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrete.llm.frames import copy_number, identified, same_row, unwrapped
from accrete.operators.lookup import balanced_lookup
from accrete.session import BROADCAST_BYTES, staged

# Shorter lines are repeats only if equal: one edit may turn a short line into any other.
LEAST_CHARACTERS = 20
# Characters of a block, and blocks a line or a long block is cut into at once.
BLOCK_CHARACTERS = 16
# Characters of the stretches in which long lines are compared.
STRETCH = 1024
MOST_BLOCKS = 64


def _trimmed(line: Column) -> Column:
    """Without white space at the ends; what white space there is inside counts as spaces."""
    return F.trim(F.regexp_replace(line, r"[\t\r\f\x0B]", " "))


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, content, no, line): the non-blank lines, white space at their ends cut."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spread = rows.select("doc_id", F.xxhash64("text").alias("content"), F.posexplode(F.split("text", "\n")).alias("no", "line"))
    return spread.withColumn("line", _trimmed(F.col("line"))).where("line <> ''")


def _key(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def _halves(line: Column) -> Column:
    """Keys of which two lines within one edit share at least one: for a line of n characters the
    first and last halves of it as the longer or as the shorter line of a pair."""
    n = F.length(line)
    keys = []
    for base in (n, n - 1):
        head = F.floor(base / 2).cast("int")
        keys += [F.xxhash64(F.lit(0), F.left(line, head)), F.xxhash64(F.lit(1), F.right(line, base - head))]
    return F.array_distinct(F.array(*keys))


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """Values of `key` that stand in at least two rows; no group is gathered."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")


def _cut(rows: DataFrame, whole: str, context: Column | None) -> DataFrame:
    """One row per block of `whole`, whose length is `base`, or one more if it is the `longer` one of a pair:
    `context` hashes all but the block, and what it was before; `middle` is the block, one character longer
    if `whole` is."""
    blocks = F.least(F.greatest(F.floor(F.col("base") / BLOCK_CHARACTERS), F.lit(1)), F.lit(MOST_BLOCKS)).cast("int")
    spread = rows.withColumn("_blocks", blocks).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    spread = spread.withColumn("_low", F.floor(F.col("block") * F.col("base") / F.col("_blocks")).cast("int"))
    spread = spread.withColumn("_high", F.floor((F.col("block") + 1) * F.col("base") / F.col("_blocks")).cast("int"))
    around = ["base", "block", F.left(whole, F.col("_low")), F.right(whole, F.col("base") - F.col("_high"))]
    return spread.select(
        "key", "first", "longer", F.xxhash64(*([] if context is None else [context]), *around).alias("context"),
        F.substring(F.col(whole), F.col("_low") + 1, F.col("_high") - F.col("_low") + F.col("longer")).alias("middle"))


def _contexts(lines: DataFrame) -> DataFrame:
    """One row per line, length of the shorter line of a pair and block, see `_cut`."""
    size = F.length("line")
    spread = lines.withColumn("base", F.explode(F.array(size, size - 1)))
    return _cut(spread.withColumn("longer", F.length("line") - F.col("base")), "line", None)


def _agreeing(contexts: DataFrame) -> DataFrame:
    """The contexts that at least two rows share, in blocks of few characters. The blocks of a long line are
    long themselves: those with a shared context are cut again, and only they, until all are short. So what a
    line costs follows its length, and an edit is found however long the line is."""
    found, short = [], F.length("middle") <= 2 * BLOCK_CHARACTERS
    while True:
        agreeing = staged(_shared(contexts.select("context"), "context"), "contexts")
        met = contexts.join(agreeing.select("context"), "context")
        found.append(met.where(short))
        longer = staged(met.where(~short), "long-blocks")
        if longer.isEmpty():
            return reduce(DataFrame.unionByName, found)
        base = F.length("middle") - F.col("longer")
        contexts = _cut(longer.withColumn("base", base).withColumn("_before", F.col("context")), "middle", F.col("_before"))


def _variants(contexts: DataFrame) -> DataFrame:
    """One row per variant of a block: key, first, variant (hash), place (of the missing character,
    -1 if none is missing) and whether the line is the longer one of its pair."""
    middle = F.col("middle")
    less = F.transform(
        F.sequence(F.lit(1), F.length(middle)),
        lambda i: F.struct((i - 1).alias("place"), F.concat(F.left(middle, i - 1), F.substring(middle, i + 1, F.length(middle))).alias("rest")))
    less = F.when(F.length(middle) > 0, less).otherwise(F.array().cast("array<struct<place:int,rest:string>>"))
    whole = F.array(F.struct(F.lit(-1).alias("place"), middle.alias("rest")))
    sent = F.when(F.col("longer") == 0, F.concat(whole, less)).otherwise(less)
    spread = contexts.select("key", "first", "longer", "context", F.explode(sent).alias("_sent"))
    return spread.select(
        "key", "first", "longer", F.col("_sent.place").alias("place"), F.xxhash64("context", "_sent.rest").alias("variant"))


def _witnesses(variants: DataFrame) -> DataFrame:
    """(key, witness): later lines and the earliest line that one of their variants shows to be
    within one edit; `witness` is a struct (first, key)."""
    own = F.struct("first", "key")
    same = variants.where("longer = 0 and place >= 0").select("key", F.struct("variant", "place").alias("_at"), own.alias("own"))
    # A whole line meets the longer lines that lose a character to become it.
    whole = variants.where("place = -1").select("variant", own.alias("own"), F.lit(0).alias("side"))
    long = variants.where("longer = 1").select("variant", own.alias("own"), F.lit(1).alias("side"))
    found = []
    for rows, at, sides in ((same, "_at", None), (whole.unionByName(long), "variant", "side")):
        least = rows.groupBy(at, *([sides] if sides else [])).agg(F.min("own").alias("witness"), F.count(F.lit(1)).alias("_n"))
        if sides:
            least = least.withColumn("_meets", 1 - F.col("side"))
            rows, least = (r.withColumn("_key", F.struct(F.col(at).alias("at"), F.col(c).alias("side"))) for r, c in ((rows, "side"), (least, "_meets")))
        else:
            rows, least = rows.withColumn("_key", F.col(at)), least.withColumn("_key", F.col(at))
        met = balanced_lookup(rows.select("_key", "own"), staged(least.select("_key", "witness", "_n"), "least"), "_key", "_n")
        found.append(met.where("witness < own").select(F.col("own.key").alias("key"), "witness"))
    return reduce(DataFrame.unionByName, found).groupBy("key").agg(F.min("witness").alias("witness"))


def repeated_lines(docs: DataFrame, max_edits: int = 1, least_characters: int = LEAST_CHARACTERS) -> DataFrame:
    """(doc_id, content, lines): for each document of `docs` (doc_id, text) with repeated lines, the
    numbers (from 0) of those to remove.

    A line is repeated if an earlier one, by (doc_id, text hash, line number), is equal to it or, with
    `max_edits` 1 and at least `least_characters` characters, within one edit of it, white space at
    the ends aside. Blank lines are never repeated. A null id comes first. Rows that repeat id and
    text are one document here. Other columns are left out.
    """
    if max_edits not in (0, 1):
        raise ValueError("max_edits is 0 or 1")
    first = F.struct("doc_id", "content", "no")
    keyed = staged(_lines(docs).select("doc_id", "content", "no", _key(F.col("line")).alias("key"), (F.length("line") >= least_characters).alias("long"),
                                       F.when(F.length("line") >= least_characters, _halves(F.col("line"))).alias("halves")), "lines")
    different = staged(keyed.groupBy("key").agg(
        F.min(first).alias("first"), F.count(F.lit(1)).alias("n"), F.max("halves").alias("halves")), "different")
    removed = different.where("n > 1").select("key", "first", "n", F.lit(False).alias("near"))
    if max_edits:
        near = staged(_near(docs, different, least_characters), "near")
        removed = different.join(near.withColumn("near", F.lit(True)), "key", "left").withColumn(
            "near", F.coalesce("near", F.lit(False))).where("n > 1 or near").select("key", "first", "n", "near")
    found = balanced_lookup(keyed.select("doc_id", "content", "no", "key"), staged(removed, "removed"), "key", "n")
    mine = F.struct("doc_id", "content", "no")
    return found.where(F.col("first").isNotNull() & (F.col("near") | ~F.col("first").eqNullSafe(mine))).groupBy("doc_id", "content").agg(
        F.collect_set("no").alias("lines"))


def _near(docs: DataFrame, different: DataFrame, least_characters: int) -> DataFrame:
    """Keys of the different lines that are one edit from an earlier one."""
    halves = different.where("halves is not null").select("key", F.explode("halves").alias("half"))
    shared = staged(_shared(halves, "half"), "halves")
    maybe = staged(halves.join(shared.select("half"), "half").select("key").distinct(), "maybe")
    small = maybe.count() * 32 <= BROADCAST_BYTES
    text = _lines(docs).where(F.length("line") >= least_characters).withColumn("key", _key(F.col("line")))
    text = text.join(F.broadcast(maybe) if small else maybe, "key")
    lines = staged(text.groupBy("key").agg(
        F.min(F.struct("doc_id", "content", "no")).alias("first"), F.min("line").alias("line")), "texts")
    contexts = _contexts(lines)
    found = staged(_witnesses(_variants(_agreeing(contexts))), "witnesses")
    other = lines.select(F.col("key").alias("_other"), F.col("line").alias("_line"))
    verified = lines.select("key", "line").join(found, "key").join(other, F.col("witness.key") == F.col("_other"))
    return _one_edit(verified, "line", "_line").select("key").distinct()


def _without_start(pairs: DataFrame, a: str, b: str, turned: bool) -> DataFrame:
    """Pairs less the stretches of STRETCH characters that both begin with, read from the end if `turned`."""
    if turned:
        pairs = pairs.withColumns({a: F.reverse(a), b: F.reverse(b)})
    cut = [F.regexp_extract_all(F.col(c), F.lit(f"(?s).{{1,{STRETCH}}}"), F.lit(0)) for c in (a, b)]
    differ = F.array_position(F.zip_with(*cut, lambda x, y: ~x.eqNullSafe(y)), True)
    pairs = pairs.withColumn("_same", ((differ - 1) * STRETCH).cast("int"))
    return pairs.withColumns({c: F.substring(F.col(c), F.col("_same") + 1, F.length(c)) for c in (a, b)})


def _one_edit(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """The pairs of different lines within one edit. What long lines begin and end with alike is taken off
    first: what an edit leaves of them is a few stretches, and the edit distance of long lines takes time by
    the square of their length."""
    size = F.greatest(F.length(a), F.length(b))
    near, short = F.levenshtein(a, b, 1) >= 0, 4 * STRETCH
    # An or of both would let the distance of long lines be taken.
    found = pairs.where(F.when(size <= short, near).otherwise(F.lit(False)))
    long = staged(pairs.where(size > short), "long-pairs")
    if long.isEmpty():
        return found
    left = _without_start(_without_start(long, a, b, False), a, b, True)
    return found.select("key").unionByName(
        staged(left, "left").where(F.when(size <= short, near).otherwise(F.lit(False))).select("key"))


def without_repeated_lines(docs: DataFrame, max_edits: int = 1, least_characters: int = LEAST_CHARACTERS) -> DataFrame:
    """`docs` with the repeated lines taken out of `text`; all rows and columns stay.

    The earliest of lines that are equal or within one edit stays (see `repeated_lines`). A text whose
    lines all go becomes empty, a null text stays null. Of rows that repeat id and text one keeps its
    lines and the others lose them all but the blank ones.
    """
    repeated = staged(repeated_lines(docs, max_edits, least_characters), "repeated")
    rows = identified(docs)
    copy = copy_number(rows)
    joined = rows.join(repeated.hint("shuffle_hash"), same_row(repeated), "left").select("row", "id", "key", "lines")
    text = F.col("row.text").cast("string")
    lines = F.split(text, "\n")
    kept = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains("lines", i)), "\n")
    blank = F.array_join(F.filter(lines, lambda line: _trimmed(line) == ""), "\n")
    new = F.when(F.col("copy") > 1, blank).when(F.col("lines").isNotNull(), kept).otherwise(text)
    return joined.withColumn("copy", copy).select(*unwrapped(docs, new))
