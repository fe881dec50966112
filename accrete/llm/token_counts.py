"""Token counts at every prefix of a text, found once and asked many times.

The count P[i] of the prefix ending at character i follows the recurrence

    P[i] = P[start of the pre-token holding i] + T[pre-token][i - start]

P is stored at chunk ends and found at pre-token ends of the one chunk a question falls into. T is a
dynamic programme over the bytes of a pre-token: the encoding of a prefix ends in the one token t for
which the prefix before t ends in a token that byte-pair merging keeps apart from t, so

    last[i] = t,  T[i] = T[i - len(t)] + 1

No prefix is encoded again, and a text of any length is gone through once.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from accrete.llm.frames import slices
from accrete.llm.tokenizing import ChunkEncoder, chunk_encoder

# Chunks whose counts a worker remembers, and characters of a chunk that is not remembered.
REMEMBERED_CHUNKS = 100_000
LONG_CHUNK = 10_000

COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, limit_bytes long, prefix_table binary"


def pack_table(ends: np.ndarray, counts: np.ndarray) -> bytes:
    """Chunk ends (characters), then counts at them, as 32-bit integers."""
    return ends.astype("<u4").tobytes() + counts.astype("<u4").tobytes()


def unpack_table(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(table, "<u4")
    return both[: len(both) // 2], both[len(both) // 2 :]


class BytePairs:
    """Merges of a byte-level tokenizer, and by them the token counts of all prefixes of a pre-token."""

    def __init__(self, tokenizer):
        model = json.loads(tokenizer.to_str())["model"]
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        self.longest = max(map(len, model["vocab"]), default=1)
        self.vocab = model["vocab"]
        self._alone: dict[str, bool] = {}
        self._apart: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """The tokens of a few bytes, by merging pairs in the order of their ranks."""
        parts = list(text)
        while len(parts) > 1:
            ranks = [self.rank.get(pair, len(self.rank)) for pair in zip(parts, parts[1:])]
            at = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[at] == len(self.rank):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _stands(self, token: str) -> bool:
        if token not in self._alone:
            self._alone[token] = token in self.vocab and self.merged(token) == [token]
        return self._alone[token]

    def apart(self, before: str, token: str) -> bool:
        """Whether two tokens side by side stay as they are."""
        pair = (before, token)
        if pair not in self._apart:
            if len(self._apart) > 1_000_000:
                self._apart.clear()
            self._apart[pair] = self.merged(before + token) == [before, token]
        return self._apart[pair]

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of the first 0, 1, ... bytes; `text` has a character for each byte."""
        last, counts = [""] * (len(text) + 1), np.zeros(len(text) + 1, np.int64)
        for i in range(1, len(text) + 1):
            for j in range(i - 1, max(i - self.longest, 0) - 1, -1):
                token = text[j:i]
                if self._stands(token) and (j == 0 or self.apart(last[j], token)):
                    last[i], counts[i] = token, counts[j] + 1
                    break
            else:
                raise ValueError("a byte without a token")
        return counts


class PieceCounts:
    """Token counts at the prefixes of one chunk: at the ends of its pre-tokens, and inside one on demand.

    Where a text ends decides how the last pre-tokens are cut (white space, clitics), so a prefix that ends
    within SHORT characters of a pre-token's start is encoded from two pre-tokens before on."""

    SHORT = 3

    def __init__(self, tokenizer, pairs: BytePairs, chunk: str):
        self.tokenizer, self.pairs, self.chunk = tokenizer, pairs, chunk
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        parts = re.split("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")", chunk) if special else [chunk]
        starts, self.bytes, at = [], [], 0
        for part in parts:
            if part in special:
                starts.append(at)
                self.bytes.append(None)
            else:
                for mapped, (low, _) in tokenizer.pre_tokenizer.pre_tokenize_str(part):
                    starts.append(at + low)
                    self.bytes.append(mapped)
            at += len(part)
        self.start = np.array(starts, np.int64)
        self.stop = np.append(self.start[1:], len(chunk))
        pieces = [chunk[a:b] for a, b in zip(self.start, self.stop)]
        found = np.array([0, *(len(e.ids) for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False))], np.int64)
        self.base = np.cumsum(found)
        self._tables: dict[int, np.ndarray] = {}

    def _table(self, k: int) -> np.ndarray:
        """Tokens of the first 0, 1, ... characters of a pre-token."""
        if k not in self._tables:
            sizes = [len(c.encode()) for c in self.chunk[self.start[k] : self.stop[k]]]
            self._tables[k] = self.pairs.prefix_counts(self.bytes[k])[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)]
        return self._tables[k]

    def at(self, i: int) -> int:
        """Tokens of the first i characters."""
        if i == 0:
            return 0
        k = int(np.searchsorted(self.start, i, "left")) - 1
        if i - self.start[k] > self.SHORT and self.bytes[k] is not None:
            return int(self.base[k] + self._table(k)[i - self.start[k]])
        low = max(k - 2, 0)
        rest = self.tokenizer.encode(self.chunk[self.start[low] : i], add_special_tokens=False).ids
        return int(self.base[low]) + len(rest)

    def longest(self, budget: int) -> int:
        """The most characters with at most `budget` tokens."""
        top = min(int(np.searchsorted(self.base, budget, "right")) + 1, len(self.start) - 1)
        for k in range(top, -1, -1):
            begin, end = int(self.start[k]), int(self.stop[k])
            far = np.arange(begin + self.SHORT + 1, end + 1) if self.bytes[k] is not None else np.zeros(0, np.int64)
            if len(far):
                fits = far[self.base[k] + self._table(k)[far - begin] <= budget]
                if len(fits):
                    return int(fits[-1])
                end = begin + self.SHORT
            for i in range(end, begin, -1):
                if self.at(i) <= budget:
                    return i
        return 0


class PrefixCounts:
    """Answers for one tokenizer; what is found about a chunk is remembered by the chunk."""

    def __init__(self, encoder: ChunkEncoder):
        self.encoder = encoder
        self.pairs = BytePairs(encoder.tokenizer)
        self._known: dict[str, PieceCounts] = {}

    def chunk_counts(self, chunk: str) -> PieceCounts:
        if chunk not in self._known:
            if len(self._known) >= REMEMBERED_CHUNKS:
                self._known.clear()
            found = PieceCounts(self.encoder.tokenizer, self.pairs, chunk)
            if len(chunk) > LONG_CHUNK:
                return found
            self._known[chunk] = found
        return self._known[chunk]

    def tokens_at(self, text: str, table: bytes, characters: int) -> int:
        """Tokens of `text[:characters]`."""
        ends, counts = unpack_table(table)
        at = int(np.searchsorted(ends, characters, "right"))
        low, base = (int(ends[at - 1]), int(counts[at - 1])) if at else (0, 0)
        if at == len(ends) or low == characters:
            return base
        return base + self.chunk_counts(text[low : int(ends[at])]).at(characters - low)

    def longest_prefix(self, text: str, table: bytes, budget: int) -> int:
        """Most characters i such that `text[:i]` has at most `budget` tokens."""
        ends, counts = unpack_table(table)
        at = int(np.searchsorted(counts, budget, "right"))
        low, base = (int(ends[at - 1]), int(counts[at - 1])) if at else (0, 0)
        if at == len(ends):
            return low
        return low + self.chunk_counts(text[low : int(ends[at])]).longest(budget - base)


def prefix_tables(encoder: ChunkEncoder, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunk ends and the token counts at them for each text."""
    for plain, chunks, ids in encoder.pieces(texts):
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        if plain:
            # The space before a chunk belongs to it; a line end is in it already.
            lengths[1:] += np.fromiter((c[:1] != "\n" for c in chunks[1:]), np.int64, len(chunks) - 1)
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) // encoder.width
        yield np.cumsum(lengths), np.cumsum(counts)


def prefix_token_counts(docs: DataFrame, path: str, limit: int = 1024, with_table: bool = True) -> DataFrame:
    """One row per row of `docs` (doc_id, text): bytes, tokens, whether there are more than `limit`,
    the bytes of the longest prefix within the limit, and the prefix table.

    The tokenizer is a byte-level one. A null text counts as empty (no bytes, no tokens); repeated
    rows and null ids are answered row by row; other columns are left out. Texts of any length are
    counted whole. Nothing is shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(path, True)
        answers = PrefixCounts(encoder)
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            n_bytes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0), np.int64)
            n_tokens, fitting, tables = np.zeros(len(texts), np.int64), n_bytes.copy(), []
            for i, (ends, counts) in enumerate(prefix_tables(encoder, texts)):
                n_tokens[i] = counts[-1] if len(counts) else 0
                over = n_tokens[i] > limit
                packed = pack_table(ends, counts) if over or with_table else None
                if over:
                    fitting[i] = len(texts[i][: answers.longest_prefix(texts[i], packed, limit)].encode())
                tables.append(packed if with_table else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit),
                 pa.array(fitting), pa.array(tables, pa.binary())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "limit_bytes", "prefix_table"],
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(count, COUNTS)
