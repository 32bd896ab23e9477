"""Benchmark passages in documents, found by one Aho-Corasick automaton over words.

Questions and answers are normalised to words; every run of ``width`` words of an item is a
pattern. The automaton's alphabet is words, so a text is scanned once, word by word, and what
is hit is mapped back to the characters of the original.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.blocks import column_bytes, ragged_ranges, slices, words
from pairloom.llm.piececache import PieceCache
from pairloom.llm.ship import cleared, prepare, tidy
from pairloom.session import hand_over, scratch, stage

#: Bytes of words are kept, A-Z in lower case; all others part words: [\x00-\x2F\x3A-\x60\x7B-\x7F].
_WORD = [c for c in range(256) if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80]
FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _WORD else 0x20 for c in range(256))
_FOLD = np.frombuffer(FOLD, np.uint8)
_BLANK = np.zeros(256, bool)
_BLANK[0x20] = True
#: Words that one of the streams reads which a scan goes through side by side.
STREAM = 128

_caches: dict[str, PieceCache] = cleared({})
_HIT = pa.struct([("word", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
_FOUND = "n_words long, hits array<struct<word:int,start:int,end:int>>, item_ids array<string>"


def fold_words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Automaton:
    """All windows of some items as one automaton in flat arrays, with the ids of the items that hold each.

    States are numbered by depth, then by (state before, word). ``edges`` holds these two in one number, sorted, and its
    entry i leads to state i + 1; ``fail`` is the state of the longest shorter suffix, ``last`` the nearest
    state on that way, the state itself included, that ends a window (0: none). That is 16 bytes a state and at most ``width``
    states a word of the items.
    """

    def __init__(self, items: list[tuple[str | None, str]], width: int):
        self.items = sorted({i for i, _ in items if i is not None})
        place = {item: n for n, item in enumerate(self.items)}
        self.numbers: dict[bytes, int] = {}
        texts = [[self.numbers.setdefault(w, len(self.numbers) + 1) for w in fold_words(t.encode())] for _, t in items]
        flat = np.array([n for text in texts for n in text], np.int64)
        counts = np.array([len(text) for text in texts], np.int64)
        longest = np.minimum(counts, width)
        windows = np.where(counts > 0, counts - longest + 1, 0)
        starts = ragged_ranges(np.cumsum(counts) - counts, windows)
        lengths = np.repeat(longest, windows)
        state = np.zeros(len(starts), np.int64)
        levels: list[np.ndarray] = []
        first = [1]
        for depth in range(int(longest.max(initial=0))):
            live = np.flatnonzero(lengths > depth)
            level, which = np.unique(state[live] << 32 | flat[starts[live] + depth], return_inverse=True)
            state[live] = first[-1] + which
            first.append(first[-1] + len(level))
            levels.append(level)
        self.edges = np.concatenate([np.zeros(0, np.int64), *levels])
        self.first = np.array(first, np.int64)
        self.root = np.zeros(len(self.numbers) + 1, np.int32)
        if levels:
            self.root[levels[0]] = np.arange(1, first[1])
        owner = np.repeat(np.array([place.get(i, -1) for i, _ in items], np.int64), windows)
        self.ends = np.unique(state)
        owned = np.unique((state << 32 | owner)[owner >= 0])
        self.owners = (owned & 0xFFFFFFFF).astype(np.int32)
        self.owned = np.searchsorted(owned >> 32, np.append(self.ends, first[-1]))
        self.fail, self.last = np.zeros(first[-1], np.int32), np.zeros(first[-1], np.int32)
        self.last[self.ends] = self.ends
        for depth, (low, high) in enumerate(zip(first, first[1:])):
            if depth:
                before = self.edges[low - 1:high - 1]
                self.fail[low:high] = self.step(self.fail[before >> 32], before & 0xFFFFFFFF)
            none = low + np.flatnonzero(self.last[low:high] == 0)
            self.last[none] = self.last[self.fail[none]]

    def step(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The states behind one more word each; word 0 is in no window."""
        out = self.root[word]
        left = np.flatnonzero((state > 0) & (word > 0))
        state, word = state[left].astype(np.int64), word[left].astype(np.int64)
        while len(left):
            wanted = state << 32 | word
            at = np.minimum(np.searchsorted(self.edges, wanted), len(self.edges) - 1)
            found = self.edges[at] == wanted
            out[left[found]] = at[found] + 1
            state = self.fail[state].astype(np.int64)
            on = ~found & (state > 0)
            left, state, word = left[on], state[on], word[on]
        return out

    def states(self, text: np.ndarray) -> np.ndarray:
        """The state behind each word of a sequence of numbers.

        A state knows no more words than the longest window has. So the sequence is read in many streams
        side by side, each of which starts that many words before its own part.
        """
        reach, streams = len(self.first) - 1, -(-len(text) // STREAM)
        padded = np.zeros(reach + streams * STREAM, np.int32)
        padded[reach:reach + len(text)] = text
        begin = np.arange(streams) * STREAM
        out = np.zeros((streams, STREAM), np.int32)
        state = np.zeros(streams, np.int32)
        for n in range(reach + STREAM):
            state = self.step(state, padded[begin + n])
            if n >= reach:
                out[:, n - reach] = state
        return out.ravel()[:len(text)]

    def occurrences(self, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(first word, behind the last word, state) of every occurrence of a window in a sequence of numbers."""
        state = self.last[self.states(text)]
        at = np.flatnonzero(state)
        state = state[at]
        while len(at):
            yield at + 1 - np.searchsorted(self.first, state, "right"), at + 1, state
            state = self.last[self.fail[state]]
            at, state = at[state > 0], state[state > 0]

    def holders(self, at: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, item) for all items whose window ends with the state found at a place."""
        end = np.searchsorted(self.ends, state)
        size = self.owned[end + 1] - self.owned[end]
        return np.repeat(at, size), self.owners[ragged_ranges(self.owned[end], size)]


def _lists(values: pa.Array, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)


def _scan(automaton: Automaton, cache: PieceCache, data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    """n_words, hits and item_ids of each text."""
    docs = len(offsets) - 1
    folded = _FOLD[data]
    starts, ends, counts = words(folded, offsets, _BLANK)
    begin, _ = cache.find(folded, starts, ends)
    doc = np.repeat(np.arange(docs), counts)
    place = np.arange(len(starts)) + doc                  # a word of no window parts the texts
    text = np.zeros(len(starts) + docs, np.int32)
    text[place] = cache.pool[begin]
    inside = np.zeros(len(text) + 1, np.int64)
    held: list[np.ndarray] = [np.zeros(0, np.int64)]
    text_of = np.repeat(np.arange(docs), counts + 1)
    for low, high, state in automaton.occurrences(text):
        inside += np.bincount(low, minlength=len(inside)) - np.bincount(high, minlength=len(inside))
        at, items = automaton.holders(low, state)
        held.append(np.unique(text_of[at] << 32 | items))
    hit = np.flatnonzero(np.cumsum(inside)[place] > 0)
    char = np.cumsum((data & 0xC0) != 0x80) if len(hit) else np.zeros(1, np.int64)
    base = offsets[doc[hit]]
    before = np.where(base > 0, char[base - 1], 0)
    own = np.unique(np.concatenate(held))
    numbers = (hit - (np.cumsum(counts) - counts)[doc[hit]], char[starts[hit]] - 1 - before, char[ends[hit] - 1] - before)
    return [
        pa.array(counts.astype(np.int64)),
        _lists(pa.StructArray.from_arrays([pa.array(n.astype(np.int32)) for n in numbers], fields=list(_HIT)), np.bincount(doc[hit], minlength=docs)),
        _lists(pa.array(automaton.items, pa.string()).take(pa.array(own & 0xFFFFFFFF)), np.bincount(own >> 32, minlength=docs)),
    ]


def _found(rows: DataFrame, text: str, items: list[tuple[str | None, str]], width: int) -> DataFrame:
    """``rows`` with what one automaton finds in the column ``text``."""
    shared, name = rows.sparkSession.sparkContext.broadcast(Automaton(items, width)), uuid.uuid4().hex
    schema = rows.limit(0).selectExpr("*", *[f"CAST(NULL AS {kind}) {column}" for column, kind in (f.split(" ", 1) for f in _FOUND.split(", "))]).schema
    at = rows.columns.index(text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        if name not in _caches:
            _caches.clear()

            def encode(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
                numbers = np.array([automaton.numbers.get(p, 0) for p in pieces], np.uint32)
                return numbers, np.arange(len(numbers)), np.ones(len(numbers), np.int64)

            _caches[name] = PieceCache(encode, 300_000)
        for batch in batches:
            data, offsets = column_bytes(batch.column(at))
            for low, high in slices(offsets):
                found = _scan(automaton, _caches[name], data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
                yield pa.RecordBatch.from_arrays([*batch.slice(low, high - low).columns, *found], names=schema.names)

    return rows.mapInArrow(tidy(scan), schema)


def find_contamination(docs: DataFrame, items: DataFrame, width: int = 10, block_bytes: int | None = None,
                       id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                       item_text: str = "text", most_bytes: int = 8 << 20) -> DataFrame:
    """(id, text, n_words, hits, item_ids) of every document.

    ``hits`` lists the words inside any occurrence of a window: the word's number and its character
    range in the original text. ``item_ids`` are the ids, as sorted strings, of the items with an occurring
    window; an item of fewer words than ``width``, but not none, is one window.

    One automaton, made by the driver and broadcast, holds the windows of all items, and the documents are scanned once. It takes at most
    16 * ``width`` bytes a word of the items, so item texts of more than ``most_bytes`` are an error. For them, ask for several
    automata, each over items of about ``block_bytes`` (one item at least), with a scan for each: the result is the same.

    Null and empty texts have no words and no hits; a null item text has no window; the windows of an item
    with a null id hit, but are not listed; equal ids are one item; repeated documents stay rows of their own;
    empty tables give no rows or no hits; other columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    wanted = items.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).cast("string").alias("text"))
    wanted = wanted.filter(F.length("text") > 0).distinct()
    total = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if min(total, block_bytes or total) > most_bytes:
        raise ValueError(f"{total} bytes of items in one automaton; give block_bytes or a larger most_bytes")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    blocks = max(1, -(-total // (block_bytes or total or 1)))
    if blocks == 1:
        return _found(rows, "text", [tuple(r) for r in wanted.collect()], width).withColumnsRenamed({"id": id_col, "text": text_col})
    with scratch(spark):
        rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "texts")
        every = None
        for block in range(blocks):
            part = wanted.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()
            found = _found(rows.select("row", "text"), "text", [tuple(r) for r in part], width).drop("text")
            found = stage(found.filter("size(hits) > 0") if block else found, "hits")
            every = found if every is None else every.unionByName(found)
        one_list = lambda name: F.array_sort(F.array_distinct(F.flatten(F.collect_list(name)))).alias(name)  # noqa: E731  # one row a block
        merged = every.groupBy("row").agg(F.max("n_words").alias("n_words"), one_list("hits"), one_list("item_ids"))
        return hand_over(rows.join(merged, "row").select(F.col("id").alias(id_col), F.col("text").alias(text_col), "n_words", "hits", "item_ids"), "contamination")
