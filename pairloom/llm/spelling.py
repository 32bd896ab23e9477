"""Spelling variants by a variable-length gram index.

1. All substrings of 2 to ``LONGEST - 1`` characters are counted over the words. The dictionary keeps the frequent ones;
   they say where a gram must be longer to tell words apart.
2. A word is decomposed from left to right: at each place the gram grows until it is no longer frequent, or has
   the longest length; a gram within an earlier one is left out.
3. One edit changes the grams that hold it, and may swallow the one behind it. The largest number of grams that one edit
   can affect bounds from below how many grams a near word must have too, so only the rarest grams of a word go
   into the index, one more than may be missing. Grams before the edit keep their place from the
   start, grams behind it their place from the end; lists are kept for both.
4. Each list is merged on its own, in blocks, and its pairs are verified there; only near words leave it.

Words of c and c + 1 characters meet in lists of their own, with grams of at most c // 2 characters. So for every word
at least one gram is out of reach of any edit: the first one, or else the last.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.blocks import column_bytes, ragged_ranges, slices, spans, strings, sums
from pairloom.llm.ship import prepare, tidy
from pairloom.session import hand_over, scratch, stage

#: Characters of a gram: at least, and at most.
SHORTEST, LONGEST = 2, 6
#: Words of fewer characters can lose all their grams by one edit.
LEAST_LENGTH = 4
#: Members of a list that are compared with each other in one group of rows.
BLOCK = 1024
#: Pairs that are verified at a time.
PAIRS = 1 << 17
#: Longer words are verified one pair at a time.
WIDE = 64

LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
CAPITAL = np.zeros(256, bool)
CAPITAL[0x41:0x5B] = True
_LEAD = 0xC3  # the first byte of all characters from U+00C0 to U+00FF


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & np.uint32(1), (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


CRC_TABLE = _crc_table()


def crc_after(before: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of what has the CRC ``before``, followed by each span."""
    out = before.astype(np.uint32)
    size = ends - starts
    long = np.flatnonzero(size > WIDE)
    for i in long.tolist():
        out[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes(), int(before[i]))
    order = np.argsort(np.where(size > WIDE, 0, -size), kind="stable")
    active = np.searchsorted(np.where(size > WIDE, 0, -size)[order], 0)
    order = order[:active]
    state, begin, left = out[order] ^ np.uint32(0xFFFFFFFF), starts[order], size[order]
    for step in range(int(left[0]) if active else 0):
        n = int(np.searchsorted(-left, -step))  # the spans that have a byte more
        byte = data[begin[:n] + step]
        state[:n] = CRC_TABLE[(state[:n] ^ byte) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def count_runs(docs: DataFrame, least_length: int = 6, slip_every: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the maximal runs of A-Z, a-z and U+00C0 to U+00FF in all texts, A-Z lower-cased, and how often they occur.

    With ``slip_every``, a run loses the character h % length if that number divides h, the CRC-32 of ``<id>:<run>``: a
    repeatable way to make misspellings. Words of fewer than ``least_length`` characters are left out after that.
    Null and empty texts have no runs; a null id counts as an empty one; other columns are ignored. Equal
    words of an Arrow batch leave it once.
    """
    prepare(docs.sparkSession, 8)
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text"))

    def slipped(word: bytes, h: int) -> str:
        text = word.decode("utf-8")
        return text[:h % len(text)] + text[h % len(text) + 1:]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            before = np.array([zlib.crc32(f"{i}:".encode()) for i in batch.column(0).to_pylist()], np.uint32)
            for low, high in slices(offsets):
                begin = offsets[low]
                some, edges = data[begin:offsets[high]], offsets[low:high + 1] - begin
                some = np.where(CAPITAL[some], some | np.uint8(0x20), some)
                body = LETTER[some] | (some == _LEAD)
                body[1:] |= some[:-1] == _LEAD
                starts, ends, number = spans(body, edges)
                leads = np.concatenate([[0], np.cumsum(some == _LEAD)])
                length = ends - starts - (leads[ends] - leads[starts])
                owner = np.repeat(np.arange(low, high), number)
                keep = length >= least_length
                starts, ends, length, owner = starts[keep], ends[keep], length[keep], owner[keep]
                lost: Counter[str] = Counter()
                if slip_every:
                    h = crc_after(before[owner], some, starts, ends)
                    slips = h % np.uint32(slip_every) == 0
                    for a, b, x in zip(starts[slips].tolist(), ends[slips].tolist(), h[slips].tolist()):
                        lost[slipped(some[a:b].tobytes(), x)] += 1
                    starts, ends = starts[~slips], ends[~slips]
                times = pc.value_counts(strings(some, starts, ends))
                found = [w for w in lost if len(w) >= least_length]
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([times.field(0).cast(pa.string()), pa.array(found, pa.string())]),
                    pa.concat_arrays([times.field(1), pa.array([lost[w] for w in found], pa.int64())]),
                ], names=["word", "n"])

    return rows.mapInArrow(tidy(counted), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def gram_dictionary(words: DataFrame, least_count: int = 200, most_grams: int = 1 << 17) -> dict[str, int]:
    """The grams of fewer than ``LONGEST`` characters that occur more than ``least_count`` times, with their counts.

    If there are more than ``most_grams``, only the more frequent ones; that bounds what is broadcast, and makes grams
    shorter and lists longer, but misses nothing.
    """
    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 10_000):
                found: Counter[str] = Counter()
                for word in batch.column(0).slice(low, 10_000).to_pylist():
                    found.update(word[p:p + q] for q in range(SHORTEST, LONGEST) for p in range(len(word) - q + 1))
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                                                 names=["gram", "n"])

    total = words.select("word").mapInArrow(tidy(grams), "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    # Whole frequencies only: every substring of a gram is at least as frequent, so the dictionary has it too.
    kept = total.filter(F.col("n") > least_count).orderBy(F.desc("n")).limit(most_grams + 1).collect()
    cut = kept[-1]["n"] if len(kept) > most_grams else least_count
    return {r["gram"]: r["n"] for r in kept if r["n"] > cut}


class Decomposition:
    """Variable-length grams of words, by the frequent grams of a dictionary."""

    def __init__(self, frequent: dict[str, int]):
        self.frequent = frequent
        self.tails = {g[1:] for g in frequent}

    def grams(self, word: str, longest: int) -> list[tuple[int, int]]:
        """(start, end) of the grams of a word, none within another one."""
        out, reached, size = [], 0, len(word)
        for start in range(size - SHORTEST + 1):
            end = start + SHORTEST
            while end - start < longest and end < size and word[start:end] in self.frequent:
                end += 1
            if end > reached:
                out.append((start, end))
                reached = end
        return out

    def affected(self, word: str, grams: list[tuple[int, int]], longest: int) -> int:
        """The most grams that one inserted, deleted or replaced character can change or swallow.

        An edit at a character affects the grams that hold it. A gram right behind it is swallowed only by one that begins
        earlier and reaches beyond its end: it must be shorter than the longest, and all but its last character must
        follow some character in a frequent gram. Grams further behind end beyond what a gram across
        the edit can reach, since the gram one place earlier stopped before their end.
        """
        times = [0] * (len(word) + 1)
        for start, end in grams:
            for at in range(start, end):
                times[at] += 1
            if start and end - start < longest and (end - start == SHORTEST or word[start:end - 1] in self.tails):
                times[start - 1] += 1
        return max(times)

    def indexed(self, word: str, longest: int) -> list[tuple[int, int]]:
        """The rarest grams, one more than an edit may leave without a match; equal grams stay together."""
        grams = self.grams(word, longest)
        rarity = sorted((self.frequent.get(word[a:b], 0), word[a:b], a, b) for a, b in grams)
        upto = self.affected(word, grams, longest) + 1
        if upto > len(grams):
            raise AssertionError(f"one edit affects all grams of {word!r}")
        last = rarity[upto - 1][:2]
        return [(a, b) for n, g, a, b in rarity if (n, g) <= last]


def index_entries(words: DataFrame, dictionary: dict[str, int]) -> DataFrame:
    """(key, longer, word, n): a row for each list that a word is in.

    ``longer`` marks the words that are one character longer than their list's class.
    """
    shared = words.sparkSession.sparkContext.broadcast(dictionary)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = Decomposition(shared.value)
        for batch in batches:
            for low in range(0, batch.num_rows, 5000):
                keys, longer, number = [], [], []
                some = batch.slice(low, 5000)
                for i, word in enumerate(some.column(0).to_pylist()):
                    size = len(word)
                    for more in (0, 1):
                        group = size - more
                        if group < LEAST_LENGTH:
                            continue
                        for a, b in parts.indexed(word, min(LONGEST, group // 2)):
                            keys += [f"{group}<{a}<{word[a:b]}", f"{group}>{size - b}>{word[a:b]}"]
                            longer += [more == 1] * 2
                            number += [i] * 2
                at = pa.array(number, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys, pa.string()), pa.array(longer, pa.bool_()), some.column(0).take(at), some.column(1).take(at),
                ], names=["key", "longer", "word", "n"])

    return words.select("word", "n").mapInArrow(tidy(entries), "key string, longer boolean, word string, n long")


def one_edit(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Which pairs of rows of characters, padded with 0 beyond their sizes, differ by exactly one edit; a is not longer.

    Rows of one size differ in one place. A row is one longer if the other equals it up to some place and, moved by one,
    from there on.
    """
    width = np.arange(a.shape[1])
    here = a != b
    out = (size_a == size_b) & (here.sum(axis=1) == 1)
    some = np.flatnonzero(size_b == size_a + 1)
    if len(some):
        inside = width[None, :-1] < size_a[some, None]
        here = here[some, :-1] & inside
        moved = (a[some, :-1] != b[some, 1:]) & inside
        first = np.where(here.any(axis=1), here.argmax(axis=1), size_a[some])
        last = np.where(moved.any(axis=1), moved.shape[1] - 1 - moved[:, ::-1].argmax(axis=1), -1)
        out[some] = first > last
    return out


def _one_edit_of_long(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    at = next((i for i, x in enumerate(a) if x != b[i]), len(a))
    return len(b) == len(a) + 1 and a[at:] == b[at + 1:]


def _characters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The characters of words as rows padded with 0, and their numbers; long words are cut and need another test."""
    texts = words.to_pylist()
    size = np.array([len(t) for t in texts], np.int64)
    shown = np.minimum(size, WIDE)
    flat = np.frombuffer("".join([t[:WIDE] for t in texts]).encode("utf-32-le"), np.uint32)
    if not len(flat) or flat.max() < 256:
        flat = flat.astype(np.uint8)
    out = np.zeros((len(texts), int(shown.max(initial=0)) + 1), flat.dtype)
    out[np.repeat(np.arange(len(texts)), shown), ragged_ranges(np.zeros(len(texts), np.int64), shown)] = flat
    return out, size


def _list_pairs(group: np.ndarray, side: np.ndarray, longer: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of rows of one group, in portions: within a side 0 block, or from side 0 to side 1 of two blocks.

    Rows are in the order of group, side and ``longer``; two longer words belong to another class and are no pair.
    """
    end = np.searchsorted(group, group, "right")
    across = np.searchsorted(group * 2 + side, group * 2 + 1, "left")  # the first row of side 1
    split = across < end
    begin = np.where(split, across, np.arange(len(group)) + 1)
    number = np.where(side == 1, 0, np.where(~split & longer, 0, end - begin))
    for low, high in slices(np.concatenate([[0], np.cumsum(number)]), PAIRS):
        i = np.repeat(np.arange(low, high), number[low:high])
        j = ragged_ranges(begin[low:high], number[low:high])
        fine = ~(longer[i] & longer[j])
        yield i[fine], j[fine]


def near_pairs(entries: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): pairs of words of common lists that differ by one edit, each once.

    A list of more than ``BLOCK`` members is dealt into blocks, and every two blocks meet in a group of their own.
    """
    many = entries.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).filter("blocks > 1")
    dealt = entries.join(many, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    rows = dealt.select(
        "key", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"),
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"), "longer", "word", "n")
    rows = rows.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two", "side", "longer", "word")
    names = ["a", "n_a", "b", "n_b"]

    def verified(table: pa.Table) -> pa.RecordBatch:
        group = _groups(table)
        side, longer = (np.asarray(table.column(c)).astype(np.int64) for c in ("side", "longer"))
        words = table.column("word").combine_chunks()
        chars, size = _characters(words)
        first, second = [], []
        for i, j in _list_pairs(group, side, longer.astype(bool)):
            shorter = size[i] <= size[j]
            i, j = np.where(shorter, i, j), np.where(shorter, j, i)
            wide = size[j] > WIDE
            near = np.zeros(len(i), bool)
            at = np.flatnonzero(~wide)
            near[at] = one_edit(chars[i[at]], chars[j[at]], size[i[at]], size[j[at]])
            for x in np.flatnonzero(wide).tolist():
                near[x] = _one_edit_of_long(words[int(i[x])].as_py(), words[int(j[x])].as_py())
            first.append(i[near])
            second.append(j[near])
        i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (first, second))
        n = table.column("n").combine_chunks()
        return pa.RecordBatch.from_arrays([words.take(pa.array(i)), n.take(pa.array(i)), words.take(pa.array(j)), n.take(pa.array(j))],
                                          names=names)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # the last group of a batch may go on in the next one
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if kept is None else pa.concat_tables([kept, table])
            if not table.num_rows:
                continue
            group = _groups(table)
            whole = int(np.searchsorted(group, group[-1]))
            kept = table.slice(whole)
            if whole:
                yield verified(table.slice(0, whole))
        if kept is not None:
            yield verified(kept)

    found = rows.mapInArrow(tidy(compared), "a string, n_a long, b string, n_b long")
    ordered = F.col("a") < F.col("b")  # words of one size come in either order
    return found.select(
        F.when(ordered, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(ordered, F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
        F.when(ordered, F.col("b")).otherwise(F.col("a")).alias("b"), F.when(ordered, F.col("n_b")).otherwise(F.col("n_a")).alias("n_b"),
    ).distinct()


def _groups(table: pa.Table) -> np.ndarray:
    """Numbers of the runs of rows with equal (key, one, two), ascending."""
    key = np.asarray(table.column("key").combine_chunks().dictionary_encode().indices).astype(np.int64)
    one, two = (np.asarray(table.column(c)).astype(np.int64) for c in ("one", "two"))
    new = np.zeros(len(key), np.int64)
    new[1:] = (key[1:] != key[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    return np.cumsum(new)


def spelling_variants(words: DataFrame, ratio: int = 5, least_count: int = 200, most_grams: int = 1 << 17) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for the counted words (word, n).

    Two words are near if they differ by exactly one inserted, deleted or replaced character. ``form`` is the near word of
    the largest n (ties: the first in code-point order) if that is at least ``ratio`` times the word's n, ``form_n``
    its n, else both are null. ``root`` is where the forms lead from the word, the word itself if it has none.
    ``n_near`` counts near words.

    Words must be distinct and have ``LEAST_LENGTH`` characters at least (shorter or null ones are an error); other columns
    are ignored; an empty table gives no rows. With a ``ratio`` of 1 or less forms could lead in circles: an error.
    """
    if ratio <= 1:
        raise ValueError("the ratio must be above 1")
    spark = words.sparkSession
    prepare(spark, 8)
    with scratch(spark):
        length = F.coalesce(F.length("word"), F.lit(0))
        given = stage(words.select(
            F.when(length >= LEAST_LENGTH, F.col("word")).otherwise(F.raise_error(F.lit("a word is too short"))).alias("word"),
            F.col("n").cast("long").alias("n")), "words")
        entries = stage(index_entries(given, gram_dictionary(given, least_count, most_grams)), "entries")
        pairs = stage(near_pairs(entries), "near")
        both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
            pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
        best = both.groupBy("word").agg(
            F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
        named = given.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
        enough = F.col("near_n") >= ratio * F.col("n")
        named = stage(named.select(
            "word", F.when(enough, F.col("near")).alias("form"), "n", "n_near", F.when(enough, F.col("near_n")).alias("form_n")), "forms")
        return hand_over(named.join(roots(named), "word", "left").select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form; each round doubles how far a word has followed the forms."""
    upto = stage(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        on = upto.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if upto.join(on, "root", "left_semi").isEmpty():
            return upto
        upto = stage(upto.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
