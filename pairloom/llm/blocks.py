"""Words of many texts at once: numpy spans and 64-bit hashes over one byte buffer.

Texts stay UTF-8 bytes as Arrow delivers them; nothing here makes a Python string per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pairloom.llm.ship import cleared

U64 = np.uint64
SLICE_BYTES = 2 << 20
HASHED_BYTES = 1 << 18

#: ``[\x20\x09-\x0D]``, the only bytes between words.
ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Polynomials are taken modulo this prime, 2**61 - 1. Modulo 2**64 the doubling sequence (a, ab, abba, ...) and its
#: complement have equal polynomials whatever the base.
PRIME = (1 << 61) - 1
_P, _M31, _M30 = U64(PRIME), U64((1 << 31) - 1), U64((1 << 30) - 1)
_BASE = 0x1E3779B97F4A7C15 % PRIME
_powers: dict[str, np.ndarray] = cleared({})
#: Powers that are made at least.
LEAST_POWERS = 1 << 18


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> U64(61))
    return np.where(x >= _P, x - _P, x)


def times(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """a * b modulo the prime, both below it; the halves of 31 bits keep every product within 64."""
    high_a, low_a, high_b, low_b = a >> U64(31), a & _M31, b >> U64(31), b & _M31
    middle = high_a * low_b + low_a * high_b
    return _reduced(high_a * high_b * U64(2) + (middle >> U64(30)) + ((middle & _M30) << U64(31)) + low_a * low_b)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo the prime for i < n."""
    if len(_powers.get("up", ())) < n:
        size = max(1 << (n - 1).bit_length(), LEAST_POWERS)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, PRIME))):
            steps = np.ones(1, np.uint64)
            while len(steps) < size:
                steps = np.concatenate([steps, times(steps, U64(pow(base, len(steps), PRIME)))])
            _powers[name] = steps
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + n + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    if column.null_count:  # the bytes below a null are not defined
        sizes = np.where(np.asarray(column.is_valid()), np.diff(offsets), 0)
        if (sizes != np.diff(offsets)).any():
            return column_bytes(column.fill_null(""))
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together, one text at least."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield low, min(high, n)
        low = min(high, n)


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = ASCII_SPACE,
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the maximal runs of other bytes, and how many each text has."""
    return spans(~space[data], offsets)


def spans(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of marked bytes within a text, and how many each text has."""
    if not body.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(body))]
    before, after = np.zeros(len(body), bool), np.zeros(len(body), bool)
    before[1:], after[:-1] = body[:-1], body[1:]
    before[cuts], after[cuts - 1] = False, False
    starts, ends = np.flatnonzero(body & ~before), np.flatnonzero(body & ~after) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as Arrow strings."""
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)])
    body = data[ragged_ranges(starts, size)]
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body))


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Running polynomial of 64-bit values, for ``span_hash``: the sums of its low 31 and its high 30 bits."""
    up, _ = powers(len(values) + 1)
    terms = times(_reduced(values), up[:-1])
    out = np.zeros((2, len(values) + 1), np.uint64)
    np.cumsum(terms & _M31, out=out[0, 1:])
    np.cumsum(terms >> U64(31), out=out[1, 1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp: the polynomial of each span, wherever it lies, with its length mixed in."""
    _, down = powers(prefix.shape[1])
    low, high = prefix[:, ends] - prefix[:, starts]
    value = _reduced(_reduced(low) + (high >> U64(30)) + ((high & _M30) << U64(31)))
    return mix(times(value, down[starts]) + (ends - starts).astype(np.uint64) * U64(0xD1342543DE82EF95))


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are in order and do not overlap.

    Each byte is mixed with its place in the span, so no arrangement of few letters cancels out.
    """
    size = ends - starts
    upto = np.cumsum(size)
    out = np.zeros(len(size), np.uint64)
    for low, high in slices(np.concatenate([[0], upto]), HASHED_BYTES):  # bounds the memory, not the spans
        some = size[low:high]
        first = np.cumsum(some) - some
        inside = np.arange(int(some.sum()))
        place = (inside - np.repeat(first, some)).astype(np.uint64)
        at = inside + np.repeat(starts[low:high] - first, some)
        running = np.zeros(len(at) + 1, np.uint64)
        np.cumsum(mix((place << U64(8)) + data[at] + U64(0x9E3779B97F4A7C15)), out=running[1:])
        out[low:high] = running[first + some] - running[first]
    return mix(out + size.astype(np.uint64) * U64(0xD1342543DE82EF95))


def window_hashes(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hashes of ``width`` consecutive words of one text: (hashes, first words).

    ``hashes`` are the words of all texts in a row, ``counts`` the words of each text.
    """
    per_text = np.maximum(counts - width + 1, 0)
    total = int(per_text.sum())
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.cumsum(counts) - counts
    starts = np.arange(total) + np.repeat(first - (np.cumsum(per_text) - per_text), per_text)
    return span_hash(prefix_hash(hashes), starts, starts + width), starts


def ragged_ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0]+1, ... for size[0] steps, then begin[1], ..."""
    total = int(size.sum())
    return np.arange(total) + np.repeat(begin - (np.cumsum(size) - size), size)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over consecutive groups of the given counts; an empty group has 0."""
    running = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=running[1:])
    ends = np.cumsum(counts)
    return running[ends] - running[ends - counts]
