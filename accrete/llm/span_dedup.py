"""Substring dedup over sliding spans of sentences.

Sentences of more than LONG words are cut into pieces of at most PIECE words, at words chosen by
the words around them, so that a passage inside a long sentence has the same pieces wherever it
stands; a piece counts as a sentence. The shortest runs of at least `run` consecutive sentences and
`least_words` words from every sentence on, and those up to every sentence, are hashed (128 bits,
over their words); they cover all that any longer repeated run covers. Of equal spans anywhere in the corpus the first stays, by (doc_id, text hash, place);
sentences that any other one covers are removed. A task first settles the spans among the texts it
has read itself, so a span that stands everywhere sends one row per task, not one per document, to
the join.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from accrete.llm.frames import copy_number, identified, slices, unwrapped
from accrete.llm.tokenizing import forget_chunks
from accrete.session import staged

# Spans a task settles together.
SETTLED = 500_000

# Words of a sentence that is not cut, and of a piece of a longer one, at most. Any passage of over
# 50 words then has two pieces and 12 words whose ends do not hang on what stands around it.
LONG, PIECE = 16, 10

_MARKS = (".!?\n\u0589\u061f\u06d4\u0700-\u0702\u0964\u0965\u104a\u104b\u1362\u1367\u1368\u166e\u17d4\u17d5\u1803\u1809"
          "\u203c\u203d\u2047-\u2049\u2028\u2029\u3002\ufe52\ufe56\ufe57\uff01\uff0e\uff1f\uff61")
_SENTENCE = re.compile(rf"[^{_MARKS}]+[{_MARKS}]*\s*|[{_MARKS}]+\s*")
# Scripts written without spaces (Thai to Lao, Myanmar, Khmer, kana, Han): each character is a word.
_ALONE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_UNSPACED = re.compile(f"[{_ALONE}]")
_WORD = re.compile(rf"[{_ALONE}]|[^\s{_ALONE}]+")


def words_of(part: str) -> list[str]:
    """Words at white space; in scripts without it each character is one."""
    return part.split() if part.isascii() or not _UNSPACED.search(part) else _WORD.findall(part)


def _cuts(words: list[str]) -> list[int]:
    """Words after which a long sentence is cut: the last least hash of every PIECE words in a row."""
    hashes = [zlib.crc32(w.encode("utf-8", "replace")) for w in words]
    chosen, at = [], -1
    for low in range(len(words) - PIECE + 1):
        new = low + PIECE - 1
        if at < low:
            window = hashes[low : new + 1]
            new -= window[::-1].index(min(window))
        elif hashes[new] > hashes[at]:
            continue
        at = new
        chosen.append(at)
    return chosen


def sentences(text: str) -> list[str]:
    """Sentences with what follows them, long ones in pieces; joined they are the text."""
    found = []
    for part in _SENTENCE.findall(text):
        # No part has more words than characters.
        words = words_of(part) if len(part) > LONG else ()
        if len(words) <= LONG:
            found.append(part)
            continue
        starts, low = [], 0
        for word in words:
            low = part.index(word, low)
            starts.append(low)
            low += len(word)
        low = 0
        for cut in _cuts(words):
            if cut + 1 < len(words):
                found.append(part[low : starts[cut + 1]])
                low = starts[cut + 1]
        found.append(part[low:])
    return found


def span_digests(parts: list[str], run: int, least_words: int) -> tuple[list[int], list[int], list[bytes]]:
    """First sentence, end (exclusive) and digest of the spans: the shortest of at least `run`
    sentences and `least_words` words from each sentence on, and up to each, where the text has them."""
    words = [words_of(p) for p in parts]
    joined, upto = [" ".join(w) for w in words], [0]
    for w in words:
        upto.append(upto[-1] + len(w))
    spans, stop = {}, 0
    for start in range(len(parts)):
        stop = max(stop, start + run)
        while stop <= len(parts) and upto[stop] - upto[start] < least_words:
            stop += 1
        if stop > len(parts):
            break
        spans[start, stop] = None
    start = 0
    for stop in range(run, len(parts) + 1):
        while start + 1 <= stop - run and upto[stop] - upto[start + 1] >= least_words:
            start += 1
        if upto[stop] - upto[start] >= least_words:
            spans[start, stop] = None
    digests = [xxhash.xxh3_128_digest(" ".join(joined[start:stop]).encode()) for start, stop in spans]
    return [a for a, _ in spans], [b for _, b in spans], digests


def _identified(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.withColumn("content", _content(F.xxhash64("text")))


def _content(key: Column) -> Column:
    """32 bits of the hash of a text: they tell rows of one doc_id apart, and spans stay narrow."""
    return F.shiftright(key, 32).cast("int")


def repeated_spans(docs: DataFrame, run: int = 2, least_words: int = 12) -> DataFrame:
    """(doc_id, content, spans): start and stop of the non-first repeated spans of each document.

    Null texts and texts of fewer than `run` sentences (pieces of long ones counted) have no spans. Rows that repeat id and text
    are one document here. A null id comes first.
    """

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_chunks()
        held: list[list] = [[], [], [], [], []]

        def settled() -> pa.RecordBatch:
            digests = np.frombuffer(b"".join(held[4]), ">u8").reshape(-1, 2).astype(np.uint64)
            null = np.array([d is None for d in held[0]])
            doc = np.array([d or 0 for d in held[0]], np.int64)
            content, start, stop = np.array(held[1], np.int32), np.array(held[2], np.int32), np.array(held[3], np.int32)
            order = np.lexsort((start, content, doc, ~null, digests[:, 1], digests[:, 0]))
            digests, null, doc, content, start, stop = (c[order] for c in (digests, null, doc, content, start, stop))
            new = np.ones(len(doc), bool)
            new[1:] = (digests[1:] != digests[:-1]).any(axis=1)
            lead = np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))
            own = (doc == doc[lead]) & (null == null[lead]) & (content == content[lead]) & (start == start[lead])
            again = ~own
            keep = new | again
            return pa.RecordBatch.from_arrays(
                [pa.array(digests[keep, 0].view(np.int64)), pa.array((digests[keep, 1] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                 pa.array(doc[keep], mask=null[keep]), pa.array(content[keep]), pa.array(start[keep]), pa.array(stop[keep]), pa.array(again[keep])],
                ["a", "b", "doc_id", "content", "start", "stop", "again"])

        for batch in slices(batches, "text"):
            for doc_id, content, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "content", "text"))):
                starts, stops, digests = span_digests(sentences(text), run, least_words)
                held[0].extend([doc_id] * len(starts))
                held[1].extend([content] * len(starts))
                held[2].extend(starts)
                held[3].extend(stops)
                held[4].extend(digests)
            if len(held[0]) >= SETTLED:
                yield settled()
                held = [[], [], [], [], []]
        if held[0]:
            yield settled()

    # 96 bits of a digest: among 10^13 spans two different ones share them with a chance below one in a thousand.
    schema = "a long, b int, doc_id long, content int, start int, stop int, again boolean"
    rows = staged(_identified(docs).where("text is not null").select("doc_id", "content", "text").mapInArrow(spans, schema), "spans")
    mine = F.struct("doc_id", "content", "start")
    leads = rows.where("not again").withColumn("_first", F.min(mine).over(Window.partitionBy("a", "b")))
    later = leads.where(~F.col("_first").eqNullSafe(mine)).select("doc_id", "content", "start", "stop")
    found = later.unionByName(rows.where("again").select("doc_id", "content", "start", "stop"))
    return found.groupBy("doc_id", "content").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def without_repeated_spans(docs: DataFrame, run: int = 2, least_words: int = 12) -> DataFrame:
    """`docs` with the sentences of non-first repeated spans taken out of `text`, and n_sentences and
    n_removed (long; existing columns of these names are replaced). All rows stay.

    A text whose sentences all go becomes empty; a null text stays null with no sentences. Of rows
    that repeat id and text one keeps what is left of it and the others become empty.
    """
    kept = docs.drop("n_sentences", "n_removed")
    repeated = staged(repeated_spans(kept, run, least_words), "repeated")
    rows = identified(kept)
    copy = copy_number(rows)
    mine = F.col("id").eqNullSafe(repeated["doc_id"]) & (_content(F.col("key")) == repeated["content"])
    joined = rows.join(repeated.hint("shuffle_hash"), mine, "left").select("row", "id", "key", "spans")
    joined = joined.withColumn("copy", copy).select("row", F.col("row.text").cast("string").alias("text"), "spans", "copy")
    schema = StructType([*joined.select("row").schema.fields, *StructType.fromDDL("text string, n_sentences long, n_removed long").fields])

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, total, gone = batch.column("text").to_pylist(), [], []
            for i, (spans, number) in enumerate(zip(batch.column("spans").to_pylist(), batch.column("copy").to_pylist())):
                parts = sentences(texts[i] or "")
                removed = {j for s in spans or () for j in range(s["start"], s["stop"])} if number == 1 else set(range(len(parts)))
                if removed:
                    texts[i] = "".join(p for j, p in enumerate(parts) if j not in removed)
                total.append(len(parts))
                gone.append(len(removed))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                ["row", "text", "n_sentences", "n_removed"])

    return joined.mapInArrow(rewrite, schema).select(*unwrapped(kept, F.col("text")), "n_sentences", "n_removed")
