"""Token columns: vocabulary ids, fixed budgets, image placeholders and the vectors put there."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrete.functions.text import prompt, words
from accrete.functions.vectors import list_matrix
from accrete.operators.lookup import balanced_lookup
from accrete.operators.rank import sorted_rank
from accrete.session import BROADCAST_BYTES

# Fixed value: the text budget of a training row.
MAX_TEXT_TOKENS = 512
PAD_ID = 0


def vocabulary(df: DataFrame, tokens: str) -> DataFrame:
    """(token, n, token_id): ids from 1, most frequent token first, equal counts in token order."""
    counts = df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return sorted_rank(counts, [F.col("n").desc(), "token"], "token_id")


def token_ids(
    df: DataFrame, key: str, tokens: str, vocabulary: DataFrame, budget: int = MAX_TEXT_TOKENS,
    limit_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(key, ids): ids of the first `budget` tokens, unknown ones left out; null lists are empty.

    A vocabulary below `limit_bytes` travels to the tasks and nothing is shuffled. A larger one
    is joined, very frequent tokens apart from the rest.
    """
    rows = df.select(key, F.slice(F.coalesce(tokens, F.array().cast("array<string>")), 1, budget).alias("tokens"))
    words, characters = vocabulary.agg(F.count(F.lit(1)), F.sum(F.octet_length("token"))).first()
    if (characters or 0) + 16 * words <= limit_bytes:
        return _ids_in_workers(rows, key, vocabulary)
    known = vocabulary.select("token", "n", F.col("token_id").cast("int").alias("token_id"))
    # At most `budget` rows per key here, and the regrouped list is as short.
    spread = rows.select(key, F.posexplode("tokens").alias("pos", "token"))
    found = balanced_lookup(spread, known, "token", weight="n").where(F.col("token_id").isNotNull())
    listed = found.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "token_id"))).alias("l"))
    ids = F.coalesce(F.col("l.token_id"), F.array().cast("array<int>"))
    return rows.select(key).join(listed, key, "left").select(key, ids.alias("ids"))


def _digest(token: Column | str, salt: int) -> Column:
    return F.xxhash64(F.lit(salt), token)


def _ids_in_workers(rows: DataFrame, key: str, vocabulary: DataFrame) -> DataFrame:
    """A worker holds the vocabulary as three flat columns in digest order, and no object or hash table of
    words; a token found by its digest is compared with the word itself."""
    for salt in itertools.count():  # until no two words share a digest
        known = vocabulary.select(_digest("token", salt).alias("digest"), "token", F.col("token_id").cast("int").alias("token_id")).toArrow()
        digests = known.column("digest").to_numpy()
        order = np.argsort(digests)
        if (np.diff(digests[order]) != 0).all():
            break
    shipped = rows.sparkSession.sparkContext.broadcast((
        digests[order], known.column("token").combine_chunks().cast(pa.string()).take(pa.array(order)),
        known.column("token_id").to_numpy()[order]))
    told = rows.select(key, "tokens", F.transform("tokens", lambda t: _digest(t, salt)).alias("digests"))

    def run(batches):
        digests, words, numbers = shipped.value
        for batch in batches:
            lists = batch.column(1)
            tokens = lists.flatten().cast(pa.string())
            wanted = batch.column(2).flatten().to_numpy()
            at = np.searchsorted(digests, wanted)
            near = np.flatnonzero(at < len(digests))
            near = near[digests[at[near]] == wanted[near]]
            ours, theirs = words.take(pa.array(at[near])), tokens.take(pa.array(near))
            same = pc.or_(pc.fill_null(pc.equal(ours, theirs), False), pc.and_(pc.is_null(ours), pc.is_null(theirs)))
            kept = near[same.to_numpy(zero_copy_only=False)]
            owner = pc.list_parent_indices(lists).to_numpy()
            sizes = np.bincount(owner[kept], minlength=batch.num_rows)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            out = pa.ListArray.from_arrays(offsets, pa.array(numbers[at[kept]], pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), out], names=[key, "ids"])

    return told.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, ids array<int>")


def pad_to(ids: Column, budget: int = MAX_TEXT_TOKENS, pad: int = PAD_ID) -> Column:
    """Exactly `budget` ids: cut off or filled up with `pad`."""
    return F.slice(F.concat(ids, F.array_repeat(F.lit(pad).cast("int"), budget)), 1, budget)


def mask_to(ids: Column, budget: int = MAX_TEXT_TOKENS) -> Column:
    """1 for every kept token, 0 for every pad."""
    return pad_to(F.transform(ids, lambda _: F.lit(1)), budget, 0)


def packed_tokens(ids: DataFrame, budget: int = MAX_TEXT_TOKENS, pad: int = PAD_ID, ignore: int = -100,
                  prompt_length: str | None = None) -> DataFrame:
    """Add input_ids, attention_mask and labels of fixed length; prompt and pads carry no label."""
    listed = F.col("ids")
    if prompt_length is None:
        labels = listed
    else:
        start = F.col(prompt_length)
        labels = F.transform(listed, lambda x, i: F.when(i < start, F.lit(ignore)).otherwise(x))
    return ids.select(
        *[c for c in ids.columns if c != "ids"],
        pad_to(listed, budget, pad).alias("input_ids"),
        mask_to(listed, budget).alias("attention_mask"),
        pad_to(labels, budget, ignore).alias("labels"),
    )


def prompt_answer_tokens(
    df: DataFrame, key: str, question: str, answer: str, budget: int = MAX_TEXT_TOKENS, limit_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(key, input_ids, attention_mask, labels, n_tokens, truncated): question with the answer hint,
    then the answer, as training rows of `budget` tokens.

    The vocabulary is that of all these texts. Labels cover the answer only: the prompt is masked by
    its own length. `n_tokens` counts what the row had before it was cut to the budget.
    """
    told = df.select(key, words(prompt(F.col(question))).alias("_prompt"), words(F.coalesce(answer, F.lit(""))).alias("_answer"))
    rows = told.select(key, F.concat("_prompt", "_answer").alias("tokens"), F.size("_prompt").alias("start"))
    ids = token_ids(rows, key, "tokens", vocabulary(rows, "tokens"), budget, limit_bytes)
    sizes = rows.select(key, "start", F.size("tokens").alias("n_tokens"), (F.size("tokens") > budget).alias("truncated"))
    return packed_tokens(ids.join(sizes, key), budget, prompt_length="start").drop("start")


def placeholder_count(ids: Column, placeholder: int) -> Column:
    return F.size(F.filter(ids, lambda x: x == placeholder))


def placeholder_check(df: DataFrame, key: str, ids: str, vectors: str, placeholder: int) -> DataFrame:
    """(key, placeholders, vectors, matches) per row."""
    slots, given = placeholder_count(F.col(ids), placeholder), F.size(vectors)
    return df.select(key, slots.alias("placeholders"), given.alias("vectors"), (slots == given).alias("matches"))


def fill_placeholders(
    df: DataFrame, key: str, ids: str, embeddings: str, vectors: str, placeholder: int
) -> DataFrame:
    """(key, filled): embeddings with the k-th vector in place of the k-th placeholder of the row.

    A row whose number of vectors and placeholders differ is an error.
    """
    kept = df.select(key, ids, embeddings, vectors)

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            names, tokens, text, given = batch.columns
            slots = tokens.flatten().to_numpy() == placeholder
            owner = pc.list_parent_indices(tokens).to_numpy()
            per_row = np.bincount(owner[slots], minlength=batch.num_rows)
            lengths = [pc.list_value_length(c).to_numpy() for c in (tokens, text, given)]
            if not np.array_equal(per_row, lengths[2]) or not np.array_equal(lengths[0], lengths[1]):
                bad = int(np.flatnonzero((per_row != lengths[2]) | (lengths[0] != lengths[1]))[0])
                raise ValueError(
                    f"row {names[bad].as_py()}: {per_row[bad]} placeholders, {lengths[2][bad]} vectors, "
                    f"{lengths[0][bad]} tokens, {lengths[1][bad]} embeddings"
                )
            filled = list_matrix(text.flatten(), np.float32).copy()
            if slots.any():
                # Counts agree row by row, so row-major order puts every vector into its own row.
                filled[slots] = list_matrix(given.flatten(), np.float32)
            width = filled.shape[1] if filled.size else 0
            inner = pa.ListArray.from_arrays(
                pa.array(np.arange(len(filled) + 1, dtype=np.int32) * width), pa.array(filled.reshape(-1))
            )
            outer = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(lengths[0])]).astype(np.int32)), inner
            )
            yield pa.RecordBatch.from_arrays([names, outer], names=[key, "filled"])

    return kept.mapInArrow(run, f"{key} {kept.schema[key].dataType.simpleString()}, filled array<array<float>>")
