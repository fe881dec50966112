"""Token ids of a whole Arrow column: chunks are told apart by their bytes, all at once in numpy.

A text is cut before each run of ASCII white space (or, for vocabularies that drop white space, into
what is between), which are places the tokenizer cuts at, too. Chunks of one digest are compared byte
by byte, so ids never hang on a digest alone. What a worker has not met before goes to the library, each
chunk once. Texts with other white space or separators take the way by `ChunkEncoder`.
"""

from __future__ import annotations

import string
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute

from accrete.llm.terms import LOWER, digests, found_in, same_bytes, spread
from accrete.llm.tokenizing import JOINED, REMEMBERED, TAILS, ChunkEncoder, chunk_encoder

_SPACE = np.zeros(256, bool)
_SPACE[[*range(0x09, 0x0E), 0x20]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[ord(c) for c in string.ascii_letters]] = True
# White space and separators beyond those bytes, as UTF-8.
_OTHER_SPACE = [b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe1\xa0\x8e", b"\xe2\x81\x9f", b"\xe3\x80\x80", b"\xef\xbb\xbf",
                b"\xe2\x80\xa8", b"\xe2\x80\xa9", b"\xe2\x80\xaf", *(b"\xe2\x80" + bytes([x]) for x in range(0x80, 0x8C))]
_FIRST = np.zeros(256, bool)
_FIRST[[s[0] for s in _OTHER_SPACE]] = True
# Marks that may end a chunk where white space is dropped; not those of special strings, nor the one between chunks.
MARKS = frozenset(string.punctuation) - frozenset("<|>")
# Marks cut off the end of one chunk.
MOST_MARKS = 16


def odd_places(raw: np.ndarray) -> np.ndarray:
    """Where a separator stands that is not plain ASCII white space."""
    found = [np.flatnonzero((raw >= 0x1C) & (raw <= 0x1F))]
    first = np.flatnonzero(_FIRST[raw])
    if len(first):
        padded = np.concatenate([raw, np.zeros(2, np.uint8)])
        for s in _OTHER_SPACE:
            found.append(first[np.logical_and.reduce([padded[first + i] == b for i, b in enumerate(s)])])
    return np.concatenate(found)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, place, back): the distinct keys in order, a place of each (any of them, so that no stable sort
    is needed), and which of them stands at each place."""
    order = np.argsort(keys)
    ordered = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    at, back = np.flatnonzero(fresh), np.empty(len(keys), np.int64)
    back[order] = np.cumsum(fresh) - 1
    return ordered[at], order[at], back


class ColumnEncoder:
    """Ids of chunks of one tokenizer, remembered up to a number of chunks; the memory is emptied when full."""

    def __init__(self, encoder: ChunkEncoder):
        self.encoder = encoder
        # Marks that the library keeps apart from any ASCII letter before them: they are chunks of their own.
        self.tails = np.zeros(256, bool)
        for mark in TAILS if encoder.spaced else MARKS:
            self.tails[ord(mark)] = self._apart(mark) and (encoder.spaced or self._apart(mark * 2))
        self._forget()

    def _apart(self, marks: str) -> bool:
        """Whether words that end in each ASCII letter, and `marks` after them, have the ids that they have alone."""
        words = ["a" + c for c in string.ascii_letters]
        own, *found = self.encoder.tokenizer.encode_batch_fast([marks, *words, *(w + marks for w in words)], add_special_tokens=False)
        return all(both.ids == word.ids + own.ids for word, both in zip(found, found[len(words) :]))

    def _forget(self) -> None:
        none = np.zeros(0, np.int64)
        self.key = np.zeros(0, np.uint64)
        # Of each known chunk: its place and size among the ids and among the bytes.
        self.at = self.count = self.begin = self.size = none
        self.ids, self.bytes = np.zeros(0, self.encoder.dtype), np.zeros(0, np.uint8)

    def _learn(self, texts: list[str], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, at, count) of chunks as they stand in a text, white space before them included. `plain` ones
        go to the library many at a time, a mark between them that is one id of its own; the others, and
        those it would not keep apart, alone."""
        mark, mark_id = self.encoder.mark
        between = mark if self.encoder.spaced else f" {mark} "
        whole = np.flatnonzero(plain)
        groups = [whole[i : i + JOINED] for i in range(0, len(whole), JOINED)]
        found = self.encoder.tokenizer.encode_batch_fast(
            [between.join([texts[i] for i in g]) for g in groups], add_special_tokens=False)
        alone, order, counts, ids = [np.flatnonzero(~plain)], [], [], []
        for group, one in zip(groups, found):
            got = np.array(one.ids, self.encoder.dtype)
            marks = got == mark_id
            cuts = np.flatnonzero(marks)
            if len(cuts) != len(group) - 1:
                alone.append(group)
                continue
            order.append(group)
            counts.append(np.diff(np.concatenate([[-1], cuts, [len(got)]])) - 1)
            ids.append(got[~marks])
        left = np.concatenate(alone)
        for i, one in zip(left, self.encoder.tokenizer.encode_batch_fast([texts[i] for i in left], add_special_tokens=False)):
            ids.append(np.array(one.ids, self.encoder.dtype))
            counts.append(np.array([len(ids[-1])]))
        count, place = np.concatenate(counts), np.empty(len(texts), np.int64)
        place[np.concatenate([*order, left])] = np.arange(len(texts))
        return np.concatenate(ids), (np.cumsum(count) - count)[place], count[place]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of all texts one after the other, and where each text's end."""
        if texts.null_count:
            texts = pa.compute.fill_null(texts, "")
        _, places, data = texts.buffers()
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        edges = np.frombuffer(places, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]] if data is not None else np.zeros(0, np.uint8)
        edges = edges - edges[0]
        odd = np.zeros(len(texts), bool)
        odd[np.searchsorted(edges, odd_places(raw), "right") - 1] = True
        start, stop, doc, raw = self._cut(raw, edges, odd)
        taken, wrong = self._places(raw, start, stop)
        if len(wrong):
            odd[doc[wrong]] = True
        counts = self.count[taken]
        per_text = np.bincount(doc, counts, minlength=len(texts)).astype(np.int64)
        ids = self.ids[spread(self.at[taken], counts)]
        if not odd.any():
            return ids, np.cumsum(per_text)
        others = iter(list(self.encoder.ids([t.as_py() for t in texts.filter(pa.array(odd))])))
        pieces = np.split(ids, np.cumsum(per_text)[:-1])
        pieces = [next(others) if o else p for p, o in zip(pieces, odd)]
        return np.concatenate(pieces), np.cumsum([len(p) for p in pieces])

    def _cut(self, raw: np.ndarray, edges: np.ndarray, odd: np.ndarray):
        """(start, stop, text) of the chunks of all texts that are not odd, and the bytes they stand in."""
        fresh = np.zeros(len(raw) + 1, bool)
        fresh[edges] = True
        space = _SPACE[raw]
        before, after = np.concatenate([[False], space[:-1]]), np.concatenate([space[1:], [False]]) | fresh[1:]
        if self.encoder.spaced:
            tail = np.zeros(len(raw) + 1, bool)
            tail[1:-1] = self.tails[raw[1:]] & _LETTER[raw[:-1]] & after[1:] & ~fresh[1:-1]
            start = np.flatnonzero(space & ~before | fresh[:-1] | tail[:-1])
            stop = np.concatenate([start[1:], [len(raw)]]) if len(start) else start
        else:
            start = np.flatnonzero(~space & (before | fresh[:-1]))
            stop = np.flatnonzero(~space & after) + 1
            start, stop = self._cut_marks(raw, start, stop)
            raw = self._lowered(raw, edges)
        doc = np.searchsorted(edges, start, "right") - 1
        if odd.any():
            kept = ~odd[doc]
            start, stop, doc = start[kept], stop[kept], doc[kept]
        return start, stop, doc, raw

    def _cut_marks(self, raw: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chunks with the marks at their ends, after an ASCII letter, as chunks of their own."""
        ending = np.flatnonzero(self.tails[raw[stop - 1]] & (stop - start > 1))
        at, moving = stop[ending] - 1, np.arange(len(ending))
        for _ in range(MOST_MARKS):  # a longer run stays where it is
            moving = moving[self.tails[raw[at[moving] - 1]] & (at[moving] - 1 > start[ending[moving]])]
            at[moving] -= 1
        after = _LETTER[raw[at - 1]]
        ending, at = ending[after], at[after]
        return np.insert(start, ending + 1, at), np.insert(stop, ending, at)

    @staticmethod
    def _lowered(raw: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Texts without special strings with A-Z in lower case, as the tokenizer would have them. A letter
        before a character that may join it to one stays; those from U+00C0 to U+00FF (0xC3) join nothing."""
        found = LOWER[raw]
        joined = np.flatnonzero((raw[1:] >= 0x80) & (raw[1:] != 0xC3))
        found[joined] = raw[joined]
        pairs = np.flatnonzero((raw[:-1] == ord("<")) & (raw[1:] == ord("|")))
        for text in np.unique(np.searchsorted(edges, pairs, "right") - 1):
            found[edges[text] : edges[text + 1]] = raw[edges[text] : edges[text + 1]]
        return found

    def _places(self, raw: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The known chunk of each place, learned if need be, and the places whose digest another chunk has."""
        sizes = stop - start
        own, first, back = _distinct(digests(raw, start, stop))
        wrong = ~same_bytes(raw, start, sizes, raw, start[first][back], sizes[first][back])
        if len(self.key) + len(own) > self.encoder.remembered:
            self._forget()
        seen, _ = found_in(self.key, own)
        new = np.flatnonzero(~seen)
        if len(new):
            self._add(own[new], raw, start[first[new]], sizes[first[new]])
        _, at = found_in(self.key, own)
        wrong |= ~same_bytes(raw, start[first], sizes[first], self.bytes, self.begin[at], self.size[at])[back]
        return at[back], np.flatnonzero(wrong)

    def _add(self, keys: np.ndarray, raw: np.ndarray, start: np.ndarray, sizes: np.ndarray) -> None:
        data = raw[spread(start, sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        strings = pa.LargeStringArray.from_buffers(len(keys), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))).to_pylist()
        if self.encoder.spaced:
            # One space, then something else: all that a chunk after another one is as a rule.
            second = np.minimum(ends[:-1] + 1, len(data) - 1)
            plain = (data[ends[:-1]] == 0x20) & (sizes > 1) & ~_SPACE[data[second]]
        else:
            plain = np.logical_and.reduceat(data != ord(self.encoder.mark[0]), ends[:-1])
        ids, at, counts = self._learn(strings, plain)
        where = np.searchsorted(self.key, keys)
        self.at = np.insert(self.at, where, len(self.ids) + at)
        self.count = np.insert(self.count, where, counts)
        self.begin = np.insert(self.begin, where, len(self.bytes) + ends[:-1])
        self.size = np.insert(self.size, where, sizes)
        self.key = np.insert(self.key, where, keys)
        self.ids = np.concatenate([self.ids, ids])
        self.bytes = np.concatenate([self.bytes, data])


@lru_cache(maxsize=1)
def column_encoder(path: str, spaced: bool, remembered: int = REMEMBERED) -> ColumnEncoder:
    """One encoder for a worker process, kept between tasks."""
    return ColumnEncoder(chunk_encoder(path, spaced, remembered))
