"""Tokenizing each distinct piece of text once per worker, and texts as joined pieces."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from pairloom.llm.blocks import byte_hashes, ragged_ranges, sums

Encode = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _with(pool: np.ndarray, used: int, new: np.ndarray) -> np.ndarray:
    """``pool`` with ``new`` behind its first ``used`` values, doubled where it is full."""
    if used + len(new) > len(pool):
        pool = np.concatenate([pool[:used], np.zeros(max(len(new), used), pool.dtype)])
    pool[used:used + len(new)] = new
    return pool


class PieceCache:
    """Token ids (or any numbers) by piece, in flat arrays that are searched by sorted hashes.

    ``encode`` turns new pieces into numbers and tells where those of each begin and how many they are. At
    most ``limit`` pieces are kept; beyond that the cache starts anew. What is kept never
    changes a result: a piece that is not kept is encoded again, and so is one whose bytes are not those
    that were kept under its hash.
    """

    def __init__(self, encode: Encode, limit: int = 500_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin = self.size = np.zeros(0, np.int64)
        self.body_begin = self.body_size = np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0
        self.body, self.body_used = np.zeros(1 << 16, np.uint8), 0

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Put the numbers of the pieces into the pool: where those of each begin, and how many they are."""
        flat, begin, sizes = self.encode(pieces)
        self.pool = _with(self.pool, self.used, flat)
        begin = self.used + begin
        self.used += len(flat)
        return begin, sizes

    def _add(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        begin, sizes = self._encode(pieces)
        self.body = _with(self.body, self.body_used, np.frombuffer(b"".join(pieces), np.uint8))
        lengths = np.array([len(p) for p in pieces], np.int64)
        bodies = self.body_used + np.cumsum(lengths) - lengths
        self.body_used += int(lengths.sum())
        order = np.argsort(keys := np.concatenate([self.keys, hashes]), kind="stable")
        self.keys = keys[order]
        self.begin = np.concatenate([self.begin, begin])[order]
        self.size = np.concatenate([self.size, sizes])[order]
        self.body_begin = np.concatenate([self.body_begin, bodies])[order]
        self.body_size = np.concatenate([self.body_size, lengths])[order]

    def _other(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Spans whose bytes are not those of the kept piece ``at``."""
        same = self.body_size[at] == lengths
        some = np.flatnonzero(same)
        equal = data[ragged_ranges(starts[some], lengths[some])] == self.body[ragged_ranges(self.body_begin[at[some]], lengths[some])]
        if not equal.all():
            same[some] = sums(equal, lengths[some]) == lengths[some]
        return np.flatnonzero(~same)

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the numbers of each span lie in ``pool``, and how many they are."""
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        unique, first, which = np.unique(byte_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(unique) > self.limit:
            self.clear()
        at = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == unique[inside]
        cut = lambda some: [data[a:b].tobytes() for a, b in zip(starts[some].tolist(), ends[some].tolist())]
        if not known.all():
            self._add(unique[~known], cut(first[~known]))
            at = np.searchsorted(self.keys, unique)
        at = at[which]
        begin, size = self.begin[at], self.size[at]
        other = self._other(data, starts, ends - starts, at)
        if len(other):
            begin[other], size[other] = self._encode(cut(other))
        return begin, size

    def texts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray, end_id: int | None,
              ) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of whole texts, each closed by ``end_id``, and their n + 1 offsets.

        ``counts`` tells how many of the spans each text has.
        """
        begin, size = self.find(data, starts, ends)
        ids = self.pool[ragged_ranges(begin, size)]
        ends_of = np.cumsum(size)
        last = np.cumsum(counts)
        upto = np.concatenate([[0], np.where(last > 0, ends_of[np.maximum(last - 1, 0)], 0) if len(size) else 0 * last])
        if end_id is None:
            return ids, upto
        out = np.full(len(ids) + len(counts), end_id, np.uint32)
        place = np.arange(len(ids)) + np.repeat(np.arange(len(counts)), np.diff(upto))
        out[place] = ids
        return out, upto + np.arange(len(upto))
