"""Ids of the tokenizers library for pieces of text, in bulk.

A text is cut only where the tokenizer itself always cuts, so that the ids of a text are
the ids of its pieces in a row. The tests hold this against the library on whole texts.
"""

from __future__ import annotations

import os

import numpy as np

from pairloom.llm.blocks import ASCII_SPACE, words
from pairloom.llm.piececache import PieceCache
from pairloom.llm.ship import cleared

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_caches: dict[tuple, PieceCache] = cleared({})

#: Blanks at which a byte-level tokenizer is cut, and first bytes of the other blanks of Unicode.
PLAIN_BLANK = np.zeros(256, bool)
PLAIN_BLANK[[0x20, 0x09, 0x0A, 0x0D]] = True
_PLAIN = frozenset(np.flatnonzero(PLAIN_BLANK).tolist())
#: Pieces that a worker keeps of a byte-level tokenizer, some 60 bytes each: each text's blanks make more of them than there are words.
BYTE_PIECES = 2_000_000
#: Words that a worker keeps, some 70 bytes each: with fewer of them the words of a common stock are encoded again and again.
WORD_PIECES = 2_000_000
#: Words encoded together; the library takes longer for each word of a longer text.
WORDS_TOGETHER = 256
ODD_LEAD = np.zeros(256, bool)
ODD_LEAD[[0x0B, 0x0C, 0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3, 0x3C]] = True


def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class _Found:
    """Ids of pieces as they are encoded, in any order: flat ids, begins and sizes by piece."""

    def __init__(self, n: int):
        self.flat: list[np.ndarray] = []
        self.used = 0
        self.begin, self.size = np.zeros(n, np.int64), np.zeros(n, np.int64)

    def add(self, which: list[int], flat: np.ndarray, sizes: np.ndarray) -> None:
        self.begin[which] = self.used + np.cumsum(sizes) - sizes
        self.size[which] = sizes
        self.flat.append(flat)
        self.used += len(flat)

    def each(self, tokenizer, which: list[int], pieces: list[bytes]) -> None:
        """One by one through the library."""
        if which:
            texts = [pieces[i].decode("utf-8") for i in which]
            ids = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            self.add(which, np.array([x for y in ids for x in y], np.uint32), np.array([len(x) for x in ids], np.int64))

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.concatenate(self.flat) if self.flat else np.zeros(0, np.uint32), self.begin, self.size


def _ids(tokenizer, text: str) -> np.ndarray:
    return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)


def word_cache(path: str) -> PieceCache:
    """For tokenizers that drop blanks and never join what blanks part: pieces are words."""
    if ("word", path) not in _caches:
        tokenizer = _library(path)
        mark = "\x01"  # a word of one id that is put before each of many words encoded together
        marker = _ids(tokenizer, f"a {mark} a")
        sole = len(marker) == 3 and marker[0] == marker[2]

        def encode(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            found, bulk, rest = _Found(len(pieces)), [], []
            for i, p in enumerate(pieces):
                (bulk if sole and b"\x01" not in p and b"<" not in p else rest).append(i)
            for low in range(0, len(bulk), WORDS_TOGETHER):
                some = bulk[low:low + WORDS_TOGETHER]
                text = b"\x01 " + b" \x01 ".join([pieces[i] for i in some])
                ids = _ids(tokenizer, text.decode("utf-8"))
                first = np.flatnonzero(ids == marker[1])
                if len(first) == len(some):
                    found.add(some, np.delete(ids, first), np.diff(np.append(first, len(ids))) - 1)
                else:
                    rest += some
            found.each(tokenizer, rest, pieces)
            return found.result()

        _caches["word", path] = PieceCache(encode, WORD_PIECES)
    return _caches["word", path]


def byte_cache(path: str) -> PieceCache:
    """For byte-level tokenizers: pieces are words with the blanks before them."""
    if ("byte", path) not in _caches:
        tokenizer = _library(path)
        tokens = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]
        # The ids that begin a piece after one blank; no other id of such a piece is among them.
        opens = {b" ": np.array([t.startswith("Ġ") for t in tokens]), b"\n": np.array([t == "Ċ" for t in tokens])}

        def encode(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            found, rest = _Found(len(pieces)), []
            kinds: dict[bytes, list[int]] = {b" ": [], b"\n": []}
            for i, p in enumerate(pieces):
                lone = p[:1] in kinds and len(p) > 1 and p[1] not in _PLAIN and b"<" not in p
                (kinds[p[:1]] if lone else rest).append(i)
            for blank, all_of in kinds.items():
                for low in range(0, len(all_of), 4096):
                    some = all_of[low:low + 4096]
                    ids = _ids(tokenizer, b"".join([pieces[i] for i in some]).decode("utf-8"))
                    first = np.flatnonzero(opens[blank][ids])
                    if len(first) == len(some) and first[0] == 0:
                        found.add(some, ids, np.diff(np.append(first, len(ids))))
                    else:
                        rest += some
            found.each(tokenizer, rest, pieces)
            return found.result()

        _caches["byte", path] = PieceCache(encode, BYTE_PIECES)
    return _caches["byte", path]


def odd_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts with a blank that is not cut at, or with the opening of a special token: they stay whole."""
    at = np.flatnonzero(ODD_LEAD[data])
    if len(at):
        a, b = data[at], np.append(data, [0, 0])[at + 1]
        c = np.append(data, [0, 0])[at + 2]
        odd = (a < 0x20) | ((a == 0x3C) & (b == 0x7C)) | ((a == 0xC2) & ((b == 0x85) | (b == 0xA0)))
        odd |= (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
        odd |= (a == 0xE2) & ((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F))
        at = at[odd]
    out = np.zeros(len(offsets) - 1, bool)
    out[np.searchsorted(offsets, at, "right") - 1] = True
    return out


def blank_led(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray, whole: np.ndarray,
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of blanks and the word after them, a text's last blanks alone; ``whole`` texts are one span.

    The spans of a text cover it. Returns starts, ends and the spans of each text.
    """
    first, last = offsets[:-1], offsets[1:]
    _, ends, counts = words(data, offsets, blank)
    keep = ~np.repeat(whole, counts)
    ends = ends[keep]
    counts = np.where(whole, 0, counts)
    close = np.zeros(len(counts), np.int64)
    at = np.cumsum(counts)
    close[counts > 0] = ends[at[counts > 0] - 1]
    tail = np.where(counts > 0, close < last, last > first)
    ends = np.insert(ends, at[tail], last[tail])
    counts = counts + tail
    starts = np.empty_like(ends)
    starts[1:] = ends[:-1]
    filled = counts > 0
    starts[(np.cumsum(counts) - counts)[filled]] = first[filled]
    return starts, ends, counts


def encode_words(path: str, data: np.ndarray, offsets: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Ids and offsets of whole texts by a tokenizer that drops blanks."""
    starts, ends, counts = words(data, offsets, ASCII_SPACE)
    return word_cache(path).texts(data, starts, ends, counts, end_id)


def encode_bytes(path: str, data: np.ndarray, offsets: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Ids and offsets of whole texts by a byte-level tokenizer."""
    return byte_cache(path).texts(data, *blank_led(data, offsets, PLAIN_BLANK, odd_texts(data, offsets)), end_id)
