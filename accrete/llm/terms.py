"""Terms of many texts at once: their places in the bytes of an Arrow column, and 64-bit digests.

A term is a maximal run of certain bytes, A-Z lower-cased. All classes used here hold every byte
beyond ASCII, so runs of bytes are runs of characters. Texts are read where Arrow keeps them; no
Python strings are made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
# Bytes digested at once, each as some numbers of 8 bytes; a term longer than that widens its window.
WINDOW = 1 << 18


def byte_class(*others: range | int) -> np.ndarray:
    """Which bytes stand in terms: all but `others`."""
    inside = np.ones(256, bool)
    for other in others:
        inside[list(other) if isinstance(other, range) else other] = False
    return inside


# Fixed values of the contracts: bytes between terms.
BETWEEN_BLANKS = byte_class(0x20, range(0x09, 0x0E))
LETTERS_AND_DIGITS = byte_class(range(0x00, 0x30), range(0x3A, 0x41), range(0x5B, 0x61), range(0x7B, 0x80))
LETTERS = byte_class(range(0x00, 0x41), range(0x5B, 0x61), range(0x7B, 0x80))


def mixed(digests: np.ndarray) -> np.ndarray:
    """64-bit values spread by a one-to-one function."""
    found = digests ^ (digests >> np.uint64(32))
    found = found * _MIX
    return found ^ (found >> np.uint64(32))


def _running(base: int, size: int) -> np.ndarray:
    """base ** 0, base ** 1, ... modulo 2 ** 64."""
    found = np.full(size, base, np.uint64)
    found[0] = 1
    return np.cumprod(found, dtype=np.uint64)


class _Powers:
    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if size > len(self.up):
            self.up, self.down = (_running(base, size) for base in (_BASE, _INVERSE))
        return self.up, self.down


_powers = _Powers()


def digests(raw: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit digests of the runs raw[start : stop], which are ascending and not empty."""
    found, at = np.empty(len(start), np.uint64), 0
    while at < len(start):
        low = start[at]
        upto = max(int(np.searchsorted(stop, low + WINDOW, "right")), at + 1)
        up, down = _powers.upto(int(stop[upto - 1] - low))
        piece = raw[low : stop[upto - 1]]
        total = np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * up[: len(piece)])
        starts, stops = start[at:upto] - low, stop[at:upto] - low
        sums = total[stops - 1] - np.where(starts > 0, total[starts - 1], np.uint64(0))
        found[at:upto] = mixed(sums * down[starts])
        at = upto
    return found


class Terms:
    """`raw`: the lower-cased bytes of all texts; of the terms in order: `start` and `stop` in `raw`,
    `doc`, the place of the text in the column, and `digest`. A null text has no terms."""

    def __init__(self, texts: pa.Array, inside: np.ndarray):
        if texts.null_count:
            texts = pa.compute.fill_null(texts, "")
        _, places, data = texts.buffers()
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        ends = np.frombuffer(places, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.raw = LOWER[whole[ends[0] : ends[-1]]] if len(ends) else np.zeros(0, np.uint8)
        self.docs, begins = len(texts), ends[:-1] - ends[0]
        held = inside[self.raw]
        fresh = np.zeros(len(held) + 1, bool)  # a text begins here
        fresh[begins] = True
        fresh[-1] = True
        before = np.concatenate([[False], held[:-1]])
        after = np.concatenate([held[1:], [False]])
        self.start = np.flatnonzero(held & (~before | fresh[:-1]))
        self.stop = np.flatnonzero(held & (~after | fresh[1:])) + 1
        # Of texts that begin at one place only the last one has bytes.
        self.doc = np.searchsorted(begins, self.start, "right") - 1
        self.digest = digests(self.raw, self.start, self.stop)

    def strings(self, which: np.ndarray) -> pa.Array:
        """The terms of these places as an Arrow column."""
        sizes = self.stop[which] - self.start[which]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        data = self.raw[spread(self.start[which], sizes)]
        return pa.LargeStringArray.from_buffers(
            len(which), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each start as many as its size says, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


# Masks of the first 0 to 8 bytes of a little-endian number.
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _words(raw: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The first 8 bytes of each run as one number, with zeros where the run is shorter."""
    if len(raw) < 8:
        raw = np.concatenate([raw, np.zeros(8, np.uint8)])
    every = np.ndarray(len(raw) - 7, "<u8", np.ascontiguousarray(raw), strides=(1,))
    read = np.minimum(at, len(raw) - 8)
    return every[read] >> ((at - read) * 8).astype(np.uint64) & _FIRST_BYTES[np.minimum(sizes, 8)]


def same_bytes(
    a: np.ndarray, a_at: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_at: np.ndarray, b_size: np.ndarray,
) -> np.ndarray:
    """Whether the runs a[a_at : a_at + a_size] and b[b_at : b_at + b_size] agree; none is empty.

    Up to 16 bytes are compared as two numbers, which may overlap; longer runs byte by byte."""
    same = a_size == b_size
    like = np.flatnonzero(same)
    if len(like):
        sizes = a_size[like]
        same[like] = _words(a, a_at[like], sizes) == _words(b, b_at[like], sizes)
        like = np.flatnonzero(same & (a_size > 8))
    if len(like):
        last, sizes = a_size[like] - 8, np.full(len(like), 8)
        same[like] = _words(a, a_at[like] + last, sizes) == _words(b, b_at[like] + last, sizes)
        like = np.flatnonzero(same & (a_size > 16))
    if len(like):
        sizes = a_size[like]
        differ = a[spread(a_at[like], sizes)] != b[spread(b_at[like], sizes)]
        same[like] = ~np.logical_or.reduceat(differ, np.cumsum(sizes) - sizes)
    return same


def counted(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sums of `values` over equal `keys` (columns of one length), in key order."""
    if not len(keys[0]):
        return keys, values
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    first = np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])
    at = np.flatnonzero(first)
    return [k[at] for k in keys], [np.add.reduceat(v[order], at) for v in values]


def found_in(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(known, place): whether each wanted key is among the sorted ones, and where."""
    if not len(sorted_keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return sorted_keys[at] == wanted, at


class Summed:
    """Adds up rows of (keys, values) inside a task and lets them out in runs of about `most` rows, so
    that what is shuffled is added up already and what a task holds is bounded."""

    def __init__(self, names: list[str], keys: int, most: int = 2_000_000):
        self.names, self.keys, self.most = names, keys, most
        self.held: list[list[np.ndarray]] = []
        self.size = 0

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(list(columns))
        self.size += len(columns[0])
        if self.size < self.most:
            return
        before = self.size
        self._settle()
        # Far fewer rows after adding up: there is room to go on.
        if self.size > before // 4:
            yield from self._out()

    def _settle(self) -> None:
        """As `counted`, column after column in place: besides what is held there are a few columns more."""
        parts = [list(c) for c in zip(*self.held)]
        self.held = []
        columns = [np.concatenate(parts.pop(0)) for _ in range(len(parts))]
        order = np.lexsort(columns[: self.keys][::-1])
        fresh = np.zeros(len(order), bool)
        fresh[:1] = True
        for i in range(len(columns)):
            columns[i] = columns[i][order]
            if i < self.keys:
                fresh[1:] |= columns[i][1:] != columns[i][:-1]
        at = np.flatnonzero(fresh)
        del order, fresh
        for i in range(len(columns)):
            columns[i] = columns[i][at] if i < self.keys else np.add.reduceat(columns[i], at)
        self.held, self.size = [columns], len(at)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            self._settle()
            yield from self._out()

    def _out(self) -> Iterator[pa.RecordBatch]:
        """Batches of their own: who still has the last one does not hold the whole."""
        columns, self.held, self.size = self.held[0], [], 0
        for at in range(0, len(columns[0]), 100_000):
            piece = [c[at : at + 100_000].copy() for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in piece], self.names)
