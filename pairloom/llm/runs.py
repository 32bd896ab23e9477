"""Periodic runs of words by maximal pairs.

The words of a text are numbered, its suffixes are ordered by doubling, and the lengths of common prefixes of
neighbouring suffixes give the tree of LCP intervals. The tree is walked from the leaves up. An interval of value l
keeps the starts below it in one list for each word on their left; when two children meet, a start of the one and a
start of the other with another word on the left are a maximal pair: l words that are equal and go on neither to the
left nor to the right. If their distance q is at most l, the l + q words from the first start are a run of period q,
maximal as the pair is. Pairs at greater distances are never looked at: the smaller child asks the lists of the larger
one for starts within l.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from pairloom.llm.blocks import U64, column_bytes, mix, slices, strings, window_hashes, words
from pairloom.llm.ship import prepare, tidy

RESULT = ("n_words", "runs", "collapsed")
#: Bytes of text whose words are numbered at a time.
SLICE = 1 << 20


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the suffixes in order, and the common prefix of each with the next one.

    The last number of ``ids``, and every other number that a common prefix must not hold, occurs once.
    """
    n = len(ids)
    _, which, times = np.unique(ids, return_inverse=True, return_counts=True)
    rank = (np.cumsum(times) - times)[which]  # the first place of those that begin alike
    open_ = np.flatnonzero(times[which] > 1)
    levels, width = [rank], 1
    while len(open_):
        old, then = rank[open_], rank[open_ + width]
        order = np.lexsort((then, old))
        open_, old, then = open_[order], old[order], then[order]
        new_old = np.ones(len(open_), bool)
        new_old[1:] = old[1:] != old[:-1]
        new = new_old.copy()
        new[1:] |= then[1:] != then[:-1]
        at = np.arange(len(open_))
        place = old + at - np.maximum.accumulate(np.where(new_old, at, 0))
        first = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[open_] = place[first]
        alone = new.copy()
        alone[:-1] &= new[1:]
        open_ = open_[~alone]
        levels.append(rank)
        width *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    common = np.zeros(max(n - 1, 0), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        equal = np.flatnonzero(levels[k][a] == levels[k][b])
        common[equal] += 1 << k
        a[equal] += 1 << k
        b[equal] += 1 << k
    return suffixes, common


class _Starts:
    """Starts below a node: all in order, and in order for each word on their left."""

    __slots__ = ("every", "classes")

    def __init__(self, start: int, left: int):
        self.every, self.classes = [start], {left: [start]}

    def near(self, start: int, left: int, reach: int) -> Iterator[int]:
        """Starts at most ``reach`` away with another word on the left."""
        low, high = bisect_left(self.every, start - reach), bisect_right(self.every, start + reach)
        if high - low <= len(self.classes):
            own = self.classes.get(left, ())
            for other in self.every[low:high]:
                at = bisect_left(own, other)
                if at == len(own) or own[at] != other:
                    yield other
            return
        for word, some in self.classes.items():
            if word != left:
                yield from some[bisect_left(some, start - reach):bisect_right(some, start + reach)]

    def take(self, other: "_Starts") -> None:
        for word, some in other.classes.items():
            own = self.classes.setdefault(word, [])
            for start in some:
                insort(own, start)
                insort(self.every, start)


def tree_runs(starts: list[int], common: list[int], lefts: list[int], least: int) -> dict[tuple[int, int], int]:
    """(start, length) -> period of the runs whose pairs lie in one tree: neighbouring suffixes with long common prefixes.

    Pairs of a multiple of the period give the same start and length; the smallest distance is the period.
    """
    found: dict[tuple[int, int], int] = {}

    def joined(a: _Starts, b: _Starts, value: int) -> _Starts:
        if len(a.every) < len(b.every):
            a, b = b, a
        for left, some in b.classes.items():
            for start in some:
                for other in a.near(start, left, value):
                    period = abs(start - other)
                    if value + period >= least:
                        key = (min(start, other), value + period)
                        found[key] = min(found.get(key, period), period)
        a.take(b)
        return a

    path: list[list] = []
    pending = _Starts(starts[0], lefts[0])
    for start, left, value in zip([*starts[1:], 0], [*lefts[1:], 0], [*common, -1]):
        while path and path[-1][0] > value:
            above = path.pop()
            pending = joined(above[1], pending, above[0])
        if path and path[-1][0] == value:
            path[-1][1] = joined(path[-1][1], pending, value)
        else:
            path.append([value, pending])
        pending = _Starts(start, left)
    return found


def word_runs(numbers: np.ndarray, counts: np.ndarray, least: int) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, in order; ``numbers`` are the words of all texts in a row."""
    shortest = (least + 1) // 2  # a pair of l words at a distance of at most l covers ``least`` words
    out: list[list[tuple[int, int, int]]] = [[] for _ in counts]
    hashes, at = window_hashes(mix(numbers.astype(np.uint64) + U64(1)), counts, shortest)
    text = np.repeat(np.arange(len(counts)), counts)
    key = hashes ^ mix(text[at].astype(np.uint64) + U64(1))
    order = np.argsort(key, kind="stable")
    again = np.flatnonzero(key[order][1:] == key[order][:-1])
    some = np.unique(text[at[order[again]]])  # no text without a repeated window has a run
    if not len(some):
        return out
    first = np.cumsum(counts) - counts
    own = counts[some]
    begin = np.cumsum(own + 1) - (own + 1)
    # Numbers differ from text to text, and each text is closed by a number of its own.
    width = int(numbers.max()) + 2
    ids = np.empty(int((own + 1).sum()), np.int64)
    for i, (t, b, n) in enumerate(zip(some.tolist(), begin.tolist(), own.tolist())):
        ids[b:b + n] = numbers[first[t]:first[t] + n].astype(np.int64) + i * width
        ids[b + n] = i * width + width - 1
    suffixes, common = suffix_order(ids)
    lefts = np.concatenate([[-1], ids[:-1]])
    deep = np.concatenate([[False], common >= shortest, [False]])
    turns = np.flatnonzero(deep[1:] != deep[:-1])
    owner = np.searchsorted(begin, suffixes, "right") - 1
    for low, high in zip(turns[::2].tolist(), turns[1::2].tolist()):
        starts = suffixes[low:high + 1]
        i = int(owner[low])
        found = tree_runs(starts.tolist(), common[low:high].tolist(), lefts[starts].tolist(), least)
        out[int(some[i])] += [(s - int(begin[i]), length, period) for (s, length), period in found.items()]
    for rows in out:
        rows.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse_runs(docs: DataFrame, least: int = 12, text_col: str = "text") -> DataFrame:
    """``docs`` with (n_words, runs, collapsed): the periodic runs of each whole text, and the text without the repetitions.

    Words are what lies between ASCII blanks, numbered from 0. A run is a stretch of at least ``least`` words, and of two
    periods, in which words ``period`` apart are equal, ``period`` being the smallest such number; neither neighbour goes on
    like that. ``runs`` lists (start, length, period) by start, then period. A word goes if a run has it after its
    first period; ``collapsed`` is the rest, joined by one blank.

    Null and empty texts have no words, no runs and an empty rest; equal rows stay rows of their own; an empty table gives no
    rows; columns of ``docs`` stay, but those named like a result are replaced. One pass without a shuffle. Work and
    memory of a text grow with its length (times its logarithm) and the number of runs.
    """
    if least < 2:
        raise ValueError("a run has at least two words")
    prepare(docs.sparkSession, 8)
    docs = docs.drop(*[c for c in RESULT if c != text_col])
    spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    nested = docs.select(F.struct("*").alias("doc"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("doc", nested.schema["doc"].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))),
        T.StructField("collapsed", T.StringType()),
    ])

    def collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for low, high in slices(offsets, SLICE):
                begin = offsets[low]
                some, edges = data[begin:offsets[high]], offsets[low:high + 1] - begin
                starts, ends, counts = words(some, edges)
                numbers = np.asarray(strings(some, starts, ends).dictionary_encode().indices)
                found = word_runs(numbers, counts, least)
                body, kept, rows = some.tobytes(), [], []
                for a, b, n, runs in zip(edges.tolist(), edges[1:].tolist(), counts.tolist(), found):
                    own = body[a:b].split()
                    if runs:
                        steps = np.zeros(n + 1, np.int64)
                        for start, length, period in runs:
                            steps[start + period] += 1
                            steps[start + length] -= 1
                        own = [own[i] for i in np.flatnonzero(np.cumsum(steps)[:-1] == 0).tolist()]
                    kept.append(b" ".join(own))
                    rows.append([{"start": s, "length": m, "period": p} for s, m, p in runs])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low), pa.array(counts, pa.int64()), pa.array(rows, spans),
                    pa.array(kept, pa.string()),
                ], names=schema.names)

    made = nested.mapInArrow(tidy(collapsed), schema)
    return made.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns if c not in RESULT], *RESULT)
