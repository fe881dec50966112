"""Exact token ids of whole texts, a distinct chunk encoded once per worker.

Texts are cut into chunks that the tokenizer treats alone, so that the ids of a text are those
of its chunks joined. Byte-level BPE never joins a non-space character with white space after
it, hence a cut before white space is safe; `word` vocabularies drop white space, hence any cut
at a space is. Chunks repeat, so most are looked up, and the tokenizers library sees the rest.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

# Chunks a worker remembers, of about 200 bytes each, unless told otherwise; the memory is emptied
# when full, which costs time only.
REMEMBERED = 1_200_000
# Chunks encoded in one call of the library.
JOINED = 200
# Characters handled together.
GROUP_CHARS = 1_000_000

# Separators that Python and the tokenizer may class differently: such a text is one chunk.
_UNSURE = re.compile("[\x1c-\x1f\x85᠎​﻿]")
# A plain text has no two white-space characters in a row.
_NOT_PLAIN = re.compile(r"\s\s")
TAILS = frozenset(".,;:!?")
_BEFORE_SPACE = re.compile(r"\s*\S+|\s+")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a .json file, special strings in texts handled as its default."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_padding()
    made.no_truncation()
    return made


def _spaced(before: str, chunk: str) -> str:
    """The chunk with the space that was left out; one that begins with a line end had none."""
    return chunk if chunk[:1] == "\n" else before + chunk


class ChunkEncoder:
    """Ids of chunks as little-endian bytes of `width` bytes an id, remembered by chunk."""

    def __init__(self, path: str, spaced: bool, remembered: int = REMEMBERED):
        self.remembered = remembered
        self.tokenizer = tokenizer(path)
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.width = int(self.dtype[-1])
        # `spaced`: white space counts, and chunk texts after the first carry a space before them.
        self.spaced = spaced
        mark = "\t" if spaced else "|"
        ids = self.tokenizer.encode(mark, add_special_tokens=False).ids
        # A mark of several ids, or none, is found nowhere: all chunks are then encoded alone.
        self.mark = (mark, ids[0] if len(ids) == 1 else -1)
        self._tails: dict[str, bytes] = {}
        self._learn_alone(self._tails, TAILS)
        self._endings: dict[str, bool] = {}
        self._after_space: dict[str, bytes] = {}
        self._whole: dict[str, bytes] = {}

    def chunks(self, text: str) -> tuple[bool, list[str]]:
        """Whether the text is plain, and its chunks. A plain text is cut before each space and line
        end; the space is left out, the line end kept. Without spaces all texts are plain, cut at
        white space, and ASCII texts without special strings come in lower case, as the tokenizer
        would have it."""
        unsure = _UNSURE.search(text)
        if not self.spaced:
            if text.isascii() and "<|" not in text:
                text = text.lower()
            return True, text.split(" ") if unsure else text.split()
        if unsure:
            return False, [text]
        if _NOT_PLAIN.search(text):
            return False, _BEFORE_SPACE.findall(text)
        return True, text.replace("\n", " \n").split(" ")

    def _learn(self, known: dict[str, bytes], need: set[str], before: str) -> None:
        """Encode chunks many at a time, a mark between them that is one id of its own; those it would
        not keep apart are encoded alone."""
        mark, mark_id = self.mark
        alone = [n for n in need if not n or mark in n or n[-1].isspace()]
        together = list(need.difference(alone))
        groups = [together[i : i + JOINED] for i in range(0, len(together), JOINED)]
        # Byte-level: "chunk<tab> chunk"; word ends: "chunk | chunk".
        between = mark if before else f" {mark} "
        joined = self.tokenizer.encode_batch_fast(
            [between.join([_spaced(before, n) for n in g]) for g in groups], add_special_tokens=False)
        for names, found in zip(groups, joined):
            ids = np.array(found.ids, self.dtype)
            cuts = np.flatnonzero(ids == mark_id)
            if len(cuts) != len(names) - 1:
                alone.extend(names)
                continue
            raw, width = ids.tobytes(), self.width
            for name, low, high in zip(names, [0, *(width * (cuts + 1)).tolist()], [*(width * cuts).tolist(), len(raw)]):
                known[name] = raw[low:high]
        self._learn_alone(known, alone, before)

    def _learn_alone(self, known: dict[str, bytes], names: Iterable[str], before: str = "") -> None:
        names = list(names)
        for name, found in zip(names, self.tokenizer.encode_batch_fast(
            [_spaced(before, n) for n in names], add_special_tokens=False)):
            known[name] = np.array(found.ids, self.dtype).tobytes()

    def _fill(self, cuts: list[tuple[bool, list[str]]]) -> None:
        after, whole = set(), set()
        for plain, chunks in cuts:
            if plain and self.spaced:
                after.update(chunks[1:])
                whole.add(chunks[0])
            elif plain:
                after.update(chunks)
            else:
                whole.update(chunks)
        if len(self._after_space) + len(after) > self.remembered:
            self._after_space.clear()
        if len(self._whole) + len(whole) > self.remembered:
            self._whole.clear()
        # Not difference_update, which would walk over all that is known.
        after = after.difference(self._after_space)
        whole = whole.difference(self._whole)
        if after:
            # A mark after most letters is a token of its own: such a chunk is a known one and the mark.
            tailed = [c for c in after if c[-1:] in TAILS and c[-2:-1] < "\u0250" and c[-2:-1].isalpha() and self.apart(c[-2:])]
            after.difference_update(tailed)
            after.update(c[:-1] for c in tailed)
            after = after.difference(self._after_space)
            self._learn(self._after_space, after, " " if self.spaced else "")
            for chunk in tailed:
                self._after_space[chunk] = self._after_space[chunk[:-1]] + self._tails[chunk[-1]]
        if whole:
            self._learn_alone(self._whole, whole)

    def apart(self, ending: str) -> bool:
        """Whether the library keeps a mark apart from the letter before it; asked once per ending. Some
        letters become a letter and a sign in lower case, and the mark joins the sign."""
        if ending not in self._endings:
            whole, word = (self.tokenizer.encode("a" + t, add_special_tokens=False).ids for t in (ending, ending[:-1]))
            tail = np.frombuffer(self._tails[ending[-1]], self.dtype).tolist()
            self._endings[ending] = whole == word + tail
        return self._endings[ending]

    def pieces(self, texts: Iterable[str | None]) -> Iterator[tuple[bool, list[str], list[bytes]]]:
        """Per text whether it is plain, its chunks and their ids; a null text is empty."""
        group, size = [], 0
        for text in texts:
            group.append(self.chunks(text or ""))
            size += len(text or "")
            if size >= GROUP_CHARS:
                yield from self._flush(group)
                group, size = [], 0
        yield from self._flush(group)

    def _flush(self, group):
        self._fill(group)
        after, whole = self._after_space.__getitem__, self._whole.__getitem__
        for plain, chunks in group:
            if plain and self.spaced:
                yield plain, chunks, [whole(chunks[0]), *map(after, chunks[1:])]
            elif plain:
                yield plain, chunks, list(map(after, chunks))
            else:
                yield plain, chunks, list(map(whole, chunks))

    def ids(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids per text."""
        for _, _, found in self.pieces(texts):
            yield np.frombuffer(b"".join(found), self.dtype)


@lru_cache(maxsize=1)
def chunk_encoder(path: str, spaced: bool, remembered: int = REMEMBERED) -> ChunkEncoder:
    """One encoder for a worker process, kept between tasks."""
    return ChunkEncoder(path, spaced, remembered)


def forget_chunks() -> None:
    """Drop what the worker process remembers. Spark reuses workers; operators that do not tokenise
    call this, so that their memory does not add to that of an earlier one."""
    from accrete.llm.chunk_ids import column_encoder

    column_encoder.cache_clear()
    chunk_encoder.cache_clear()
    tokenizer.cache_clear()
