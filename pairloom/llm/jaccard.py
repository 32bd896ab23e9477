"""Exact Jaccard join of word-shingle sets with skipping by set relations.

1. Equal sets fall into one class by their hash; only classes go on.
2. Shingles are ordered by how frequent they are, from a sketch of fixed size over all documents, then by
   hash. Two sets that link share a shingle of their prefixes, so classes meet in the index lists of prefix
   shingles. A list is ordered by size and position; size and position bounds skip what cannot link. Two sets
   that link share many prefix shingles, so a pair with too few common lists is skipped too.
3. Each list (and each run of like sizes in it) has a pivot, with which the others are compared. Sets near to a pivot
   take their answers from it: they are kept as differences from the pivot, and their overlaps with each other follow
   from the differences, not from the sets. A set that is too far from the pivot is too far from what links to it.
   The sets near to one pivot are its family; a large family is dealt into chunks, and every two chunks are compared as two blocks of
   differences, as far as their sets are not connected through the pivot already.
4. Pairs of a list that this leaves open, between different families and components, are compared whole.

The links found are those that components need; copies and near copies are not expanded into all pairs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pairloom.llm.blocks import U64, byte_hashes, column_bytes, mix, prefix_hash, slices, span_hash, sums, words
from pairloom.llm.components import components
from pairloom.llm.packed import pack, unpack
from pairloom.llm.ship import prepare, tidy, tidy_group
from pairloom.session import hand_over, scratch, stage

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
#: Bytes of text that are hashed at a time.
SLICE = 1 << 20
SKETCH_BITS = 22
SKETCH_CHUNK = 1 << 16
#: Members that are compared with one copy of a pivot in one group of rows, and the shingles that they have together.
CHUNK = 256
CHUNK_SHINGLES = 1 << 21
#: Parts of the sketch that are summed in one group.
SUMMED = 128
#: A set is compared with a pivot from this share of the hits that a link needs: sets that are near to the pivot, but do not
#: link, take their answers from it too.
STAR_SHARE = 0.5
#: Shingles are stored by their highest bits: a pair of sets of n and m shingles gains one by chance n * m / 2**48 times.
KEPT_BITS = 48


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, in a row, and how many each has.

    A text of fewer words than ``k``, but not none, has its whole sequence as its one shingle.
    """
    data = LOWER[data]
    starts, ends, counts = words(data, offsets)
    number = np.where(counts >= k, counts - k + 1, counts > 0)
    first = np.cumsum(counts) - counts
    begin = np.arange(int(number.sum())) + np.repeat(first - (np.cumsum(number) - number), number)
    hashes = span_hash(prefix_hash(byte_hashes(data, starts, ends)), begin, begin + np.repeat(np.minimum(counts, k), number))
    edges = np.concatenate([[0], np.cumsum(number)]).tolist()
    for a, b in zip(edges, edges[1:]):
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[[a for a, b in zip(edges, edges[1:]) if b > a]] = True
    return hashes[new], sums(new.astype(np.int64), number)


def set_ids(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set; 0 for empty ones."""
    first = np.cumsum(counts) - counts
    running = np.zeros(len(shingles) + 1, np.uint64)
    np.cumsum(mix(shingles), out=running[1:])
    total = running[first + counts] - running[first]
    return np.where(counts > 0, mix(total + counts.astype(np.uint64)), U64(0))


def _sliced(batch: pa.RecordBatch, column: int, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = column_bytes(batch.column(column))
    for low, high in slices(offsets, SLICE):
        begin = offsets[low]
        yield low, high, *shingle_sets(data[begin:offsets[high]], offsets[low:high + 1] - begin, k)


def read_sets(rows: DataFrame, k: int) -> DataFrame:
    """One pass over (id, key, text): a row (id, key, n, set_id) per document, and the parts of the sketch, numbered by task."""
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("key", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("set_id", T.LongType()), T.StructField("task", T.IntegerType()),
        T.StructField("chunk", T.IntegerType()), T.StructField("times", T.BinaryType()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            for low, high, shingles, counts in _sliced(batch, 2, k):
                np.add.at(sketch, (shingles >> U64(64 - SKETCH_BITS)).astype(np.int64), np.uint32(1))
                size = high - low
                names = set_ids(shingles, counts)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, size), batch.column(1).slice(low, size), pa.array(counts),
                    pa.array(names.view(np.int64)), pa.nulls(size, pa.int32()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary()),
                ], names=schema.names)
        parts = [(i, p.astype(np.uint64)) for i, p in enumerate(sketch.reshape(-1, SKETCH_CHUNK)) if p.any()]
        nothing = pa.nulls(len(parts), pa.int64())
        yield pa.RecordBatch.from_arrays([
            *[nothing] * 4, pa.array([TaskContext.get().partitionId()] * len(parts), pa.int32()), pa.array([i for i, _ in parts], pa.int32()), pa.array([pack(p) for _, p in parts], pa.binary()),
        ], names=schema.names)

    return rows.mapInArrow(tidy(read), schema)


def frequency_classes(read: DataFrame) -> np.ndarray:
    """For each cell of the sketch: 0 for what is rare, else the power of two by which it is frequent.

    Rare is what collisions alone explain, and 20 more. The result has a fixed size. The parts of the tasks are summed in a tree, ``SUMMED`` at a time.
    """
    def total(table: pa.Table) -> pa.Table:
        whole = sum(unpack(x, np.uint64) for x in table.column("times").to_pylist())
        return pa.table({"chunk": table.column("chunk")[:1], "task": table.column("task")[:1], "times": pa.array([pack(whole)], pa.binary())})

    parts = read.filter("chunk IS NOT NULL").select("chunk", "task", "times")
    tasks = parts.agg(F.max("task")).first()[0]
    while tasks is not None:
        tasks //= SUMMED
        parts = parts.withColumn("task", F.expr(f"task div {SUMMED}").cast("int")).groupBy("chunk", "task").applyInArrow(
            tidy_group(total), "chunk int, task int, times binary")
        if not tasks:
            break
    cells = np.zeros(1 << SKETCH_BITS, np.float64)
    for row in parts.toArrow().to_pylist():
        cells[row["chunk"] * SKETCH_CHUNK:(row["chunk"] + 1) * SKETCH_CHUNK] = unpack(row["times"], np.uint64)
    limit = cells.mean() + 6 * np.sqrt(cells.mean()) + 20
    return np.where(cells > limit, 1 + np.floor(np.log2(np.maximum(cells, 1) / limit)), 0).astype(np.uint8)


def prefix_length(size: np.ndarray, percent: int) -> np.ndarray:
    """How many of the first shingles a set must show so that no link is missed."""
    return size - (size * percent + 99) // 100 + 1


def least_hits(size_a: str, size_b: str, percent: int) -> Column:
    """The smallest number of common prefix shingles of two sets that link.

    Of the common shingles, those up to the earlier end of the two prefixes are in both; behind it, one set has fewer
    shingles left than it must share.
    """
    rest = lambda s: f"(({s} * {percent} + 99) div 100 - 1)"
    return F.expr(f"ceil(({size_a} + {size_b}) * {percent} / {100 + percent}D - 1e-9) - greatest({rest(size_a)}, {rest(size_b)})")


def enough_marks(size_a: int, marks_a: np.ndarray, size_b: np.ndarray, marks_b: np.ndarray, percent: int) -> np.ndarray:
    """Which of the sets b can have as many prefix shingles in common with a as a link needs.

    A bit that only one of two bitmaps has stands for at least one prefix shingle that the other set lacks.
    """
    only_a = np.bitwise_count(marks_a[None, :] & ~marks_b).sum(axis=1)
    only_b = np.bitwise_count(marks_b & ~marks_a[None, :]).sum(axis=1)
    most = np.minimum(prefix_length(np.int64(size_a), percent) - only_a, prefix_length(size_b, percent) - only_b)
    return most >= needed_hits(size_a, size_b, percent)


def needed_hits(size_a: int, size_b: np.ndarray, percent: int) -> np.ndarray:
    """``least_hits`` of arrays."""
    rest = np.maximum((size_a * percent + 99) // 100, (size_b * percent + 99) // 100) - 1
    return least_overlap(np.int64(size_a), size_b, percent) - rest


def least_overlap(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The smallest intersection of two sets of these sizes that link."""
    return -(-(a + b) * percent // (100 + percent))


def may_link(size_a, place_a, size_b, place_b, percent: int) -> np.ndarray:
    """Bounds by sizes and by the places of a common shingle in the two ordered sets."""
    low, high = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    most = np.minimum(place_a, place_b) + np.minimum(size_a - place_a, size_b - place_b)
    return (100 * low >= percent * high) & (most >= least_overlap(size_a, size_b, percent))


ENTRY = (("tokens", np.uint64), ("doc", np.uint32), ("place", np.uint32), ("sets", np.int64), ("sizes", np.uint32))


def index_lists(rows: DataFrame, k: int, percent: int, buckets: int, classes: np.ndarray) -> DataFrame:
    """Lists of sets that share a prefix shingle: pairs (pivot, other, sizes, hits) of each range, and the lists.

    A list keeps the members that may link with another of its members. Entries travel packed, by ranges of the shingle's hash; sets that occur again in a batch travel once.
    """
    shared = rows.sparkSession.sparkContext.broadcast(classes)
    names = ["bucket", *[n for n, _ in ENTRY]]

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared.value
        for batch in batches:
            kept = {name: [] for name in ("tokens", "doc", "place", "sets", "sizes")}
            base = 0
            seen: set[int] = set()
            for _, _, shingles, counts in _sliced(batch, 2, k):
                ids = set_ids(shingles, counts).view(np.int64)
                new = np.zeros(len(ids), bool)
                for i, x in enumerate(ids.tolist()):
                    if counts[i] and x not in seen:
                        seen.add(x)
                        new[i] = True
                shingles = shingles[np.repeat(new, counts)]
                ids, size = ids[new], counts[new]
                doc, place, tokens = in_order(shingles, size, level)
                front = place < np.repeat(prefix_length(size, percent), size)
                kept["tokens"].append(tokens[front])
                kept["doc"].append(doc[front] + base)
                kept["place"].append(place[front])
                kept["sets"].append(ids)
                kept["sizes"].append(size)
                base += len(size)
            if not base:
                continue
            tokens, doc, place, sets, sizes = (np.concatenate(kept[n]) for n in ("tokens", "doc", "place", "sets", "sizes"))
            order = np.argsort(tokens, kind="stable")
            tokens, doc, place = tokens[order], doc[order], place[order]
            bucket = ((tokens >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            out = []
            for b in np.flatnonzero(np.diff(edges)).tolist():
                s = slice(edges[b], edges[b + 1])
                used, local = np.unique(doc[s], return_inverse=True)
                out.append((b, pack(np.diff(tokens[s], prepend=U64(0))), pack(local.astype(np.uint32)), pack(place[s].astype(np.uint32)),
                            pack(sets[used]), pack(sizes[used].astype(np.uint32))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*out))], names=names)

    kinds = [("pivot", pa.int64()), ("other", pa.int64()), ("pivot_size", pa.int32()), ("other_size", pa.int32()),
             ("hits", pa.int32()), ("list", pa.int64()),
             ("members", pa.list_(pa.struct([("set", pa.int64()), ("size", pa.int32()), ("place", pa.int32()), ("pivot", pa.int64())])))]

    def lists(table: pa.Table) -> pa.Table:
        parts = []
        for row in table.to_pylist():
            p = {name: unpack(row[name], kind) for name, kind in ENTRY}
            parts.append((np.cumsum(p["tokens"], dtype=np.uint64), p["sets"][p["doc"]], p["sizes"][p["doc"]].astype(np.int64),
                          p["place"].astype(np.int64)))
        tokens, sets, sizes, places = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((sets, places, sizes, tokens))
        tokens, sets, sizes, places = tokens[order], sets[order], sizes[order], places[order]
        new = np.ones(len(tokens), bool)  # a set that came from several batches
        new[1:] = (tokens[1:] != tokens[:-1]) | (sets[1:] != sets[:-1])
        tokens, sets, sizes, places = tokens[new], sets[new], sizes[new], places[new]
        first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        length = np.diff(np.append(first, len(tokens)))
        pairs: Counter[tuple[int, int, int, int]] = Counter()
        rows = []
        for a, n in zip(first[length > 1].tolist(), length[length > 1].tolist()):
            live = _live(sizes[a:a + n], places[a:a + n], percent)
            some, size, place = sets[a:a + n][live], sizes[a:a + n][live], places[a:a + n][live]
            if len(some) < 2:
                continue
            pivots = _pivots(some, size, percent)
            at = np.array([np.flatnonzero(some == p)[0] for p in np.unique(pivots).tolist()])
            own = {int(some[i]): i for i in at.tolist()}
            mine = np.array([own[p] for p in pivots.tolist()])
            near = may_link(size, place, size[mine], place[mine], percent) & (some != pivots)
            pairs.update(zip(pivots[near].tolist(), some[near].tolist(), size[mine][near].tolist(), size[near].tolist()))
            at.sort()
            for i, j in zip(at.tolist(), at[1:].tolist()):  # pivots of neighbouring sizes
                if may_link(size[i], place[i], size[j], place[j], percent):
                    i, j = (i, j) if some[i] < some[j] else (j, i)
                    pairs[int(some[i]), int(some[j]), int(size[i]), int(size[j])] += 1
            rows.append((int(tokens[a:a + 1].view(np.int64)[0]), [
                {"set": s, "size": z, "place": q, "pivot": p}
                for s, z, q, p in zip(some.tolist(), size.tolist(), place.tolist(), pivots.tolist())]))
        left = sorted(pairs)
        nothing = [None] * len(rows)
        columns = [[k[i] for k in left] + nothing for i in range(4)] + [[pairs[k] for k in left] + nothing]
        columns += [[None] * len(left) + [r[i] for r in rows] for i in range(2)]
        return pa.table({name: pa.array(c, kind) for (name, kind), c in zip(kinds, columns)})

    wire = "bucket int, " + ", ".join(f"{n} binary" for n in names[1:])
    made = "pivot long, other long, pivot_size int, other_size int, hits int, list long, members array<struct<set:long,size:int,place:int,pivot:long>>"
    return rows.mapInArrow(tidy(entries), wire).groupBy("bucket").applyInArrow(tidy_group(lists), made)


def _live(size: np.ndarray, place: np.ndarray, percent: int) -> np.ndarray:
    """Which entries of a list, ordered by size, may link with another one.

    The next entry is tried first, then all in blocks of like sizes; a block whose bounds exclude it is skipped.
    """
    live = np.zeros(len(size), bool)
    near = may_link(size[:-1], place[:-1], size[1:], place[1:], percent)
    live[:-1] |= near
    live[1:] |= near
    for i in np.flatnonzero(~live).tolist():
        low = int(np.searchsorted(size, -(-size[i] * percent // 100)))
        high = int(np.searchsorted(size, size[i] * 100 // percent, "right"))
        for at in range(low, high, 256):
            block = np.arange(at, min(at + 256, high))
            most = np.minimum(place[i], place[block].max()) + np.minimum(size[i] - place[i], (size[block] - place[block]).max())
            if most < least_overlap(size[i], size[block[0]], percent):
                continue
            found = may_link(size[i], place[i], size[block], place[block], percent) & (block != i)
            if found.any():
                live[i] = True
                live[block[found]] = True
                break
    return live


def _pivots(sets: np.ndarray, size: np.ndarray, percent: int) -> np.ndarray:
    """The pivot of each entry of a list that is ordered by size: the least set id of a run of like sizes."""
    out = np.empty_like(sets)
    low = 0
    while low < len(sets):
        high = int(np.searchsorted(size, size[low] * 100 // percent, "right"))
        out[low:high] = sets[low:high].min()
        low = high
    return out


def few(narrow: DataFrame, most: int = 500_000) -> DataFrame:
    """A stored table of a few numbers a row, to be broadcast if it has at most ``most`` rows; else joins shuffle."""
    return F.broadcast(narrow) if narrow.count() <= most else narrow


#: 64-bit words of the bitmap of a prefix; the share of the needed lists, 1 in so many, that give an open pair.
MARKS, FIRST_LISTS = 8, 4


def prefix_marks(shingles: np.ndarray, counts: np.ndarray, percent: int, level: np.ndarray) -> np.ndarray:
    """A bitmap of the prefix of each set, one row each: every prefix shingle sets a bit by its hash."""
    doc, place, tokens = in_order(shingles, counts, level)
    front = place < np.repeat(prefix_length(counts, percent), counts)
    bit = (mix(tokens[front]) >> U64(32)).astype(np.int64) % (64 * MARKS)
    marks = np.zeros((len(counts), MARKS), np.uint64)
    np.bitwise_or.at(marks, (doc[front], bit // 64), U64(1) << (bit % 64).astype(np.uint64))
    return marks


def in_order(shingles: np.ndarray, counts: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set, place, shingle) of all shingles, those of a set by class and hash."""
    rank = level[(shingles >> U64(64 - SKETCH_BITS)).astype(np.int64)]
    doc = np.repeat(np.arange(len(counts)), counts)
    # Hashes of a text are sorted already, so a stable sort by (text, class) gives the order.
    order = np.argsort(doc * 64 + rank, kind="stable")
    return doc, np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts), shingles[order]


def stored_sets(rows: DataFrame, wanted: DataFrame, k: int, percent: int, classes: np.ndarray) -> DataFrame:
    """(set, tokens, marks) of the wanted documents (id, key): the shingles, and the bitmap of the prefix."""
    shared = rows.sparkSession.sparkContext.broadcast(classes)
    wanted = few(wanted)
    picked = rows.join(wanted, rows["id"].eqNullSafe(wanted["w_id"]) & (rows["key"] == wanted["w_key"])).select("id", "key", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, shingles, counts in _sliced(batch, 2, k):
                ids = set_ids(shingles, counts).view(np.int64)
                edges = np.concatenate([[0], np.cumsum(counts)]).tolist()
                short = shingles >> U64(64 - KEPT_BITS)
                blobs = [pack(np.diff(short[a:b], prepend=U64(0))) for a, b in zip(edges, edges[1:])]
                marks = [m.tobytes() for m in prefix_marks(shingles, counts, percent, shared.value)]
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(blobs, pa.binary()), pa.array(marks, pa.binary())],
                                                 names=["set", "tokens", "marks"])

    return picked.mapInArrow(tidy(sets), "set long, tokens binary, marks binary")


def reach_of(percent: int) -> float:
    return 2 * (1 - percent / 100) + 1e-9


def _tokens(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, np.uint64), dtype=np.uint64)


#: A chunk of a family: names, whether connected with the pivot, numbers and values of what was lost and gained.
BLOCK = (("names", np.int64), ("free", np.uint8), ("lost_size", np.int64), ("gained_size", np.int64), ("lost", np.int64), ("gained", np.uint64))

Side = tuple[np.ndarray, np.ndarray]


def linked_by_differences(width: int, lost_a: Side, gained_a: Side, lost_b: Side, gained_b: Side, percent: int) -> np.ndarray:
    """Which sets of two blocks link: |a & b| = |p| - |lost by a| - |lost by b| + |lost by both| + |gained by both|.

    A side holds the values of all sets in a row, and how many each has.
    """
    overlap = width - (lost_a[1][:, None] + lost_b[1][None, :]).astype(np.float64)
    for (flat_a, size_a), (flat_b, size_b) in ((lost_a, lost_b), (gained_a, gained_b)):
        common = np.intersect1d(flat_a, flat_b)
        owner_a, owner_b = (np.repeat(np.arange(len(s)), s) for s in (size_a, size_b))
        for low in range(0, len(common), 2048):
            some = common[low:low + 2048]
            has = []
            for flat, owner, n in ((flat_a, owner_a, len(size_a)), (flat_b, owner_b, len(size_b))):
                at = np.minimum(np.searchsorted(some, flat), len(some) - 1)
                inside = some[at] == flat
                held = np.zeros((n, len(some)), np.float32)
                held[owner[inside], at[inside]] = 1
                has.append(held)
            overlap += has[0] @ has[1].T
    total = (width - lost_a[1] + gained_a[1])[:, None] + (width - lost_b[1] + gained_b[1])[None, :]
    return 100 * overlap >= percent * (total - overlap)


def cross_links(pivot: int, a: dict, b: dict, percent: int) -> list[tuple[int, int]]:
    """Links that connect what links between two chunks of a family: one at most for each member, and for the pivot.

    Members that are connected with the pivot bear its name from the start.
    """
    read = [{n: unpack(x[n], kind) for n, kind in BLOCK} for x in (a, b)]
    sides = [((x["lost"], x["lost_size"]), (x["gained"], x["gained_size"])) for x in read]
    linked = linked_by_differences(a["width"], *sides[0], *sides[1], percent)
    names = [x["names"] for x in read]
    free = [x["free"].astype(bool) for x in read]
    label = [np.where(f, n, pivot) for n, f in zip(names, free)]
    most, home = np.iinfo(np.int64).max, pivot
    while True:
        before = [x.copy() for x in label]
        label[0] = np.minimum(label[0], np.where(linked, label[1][None, :], most).min(axis=1, initial=most))
        label[1] = np.minimum(label[1], np.where(linked, label[0][:, None], most).min(axis=0, initial=most))
        home = min(home, *(int(x[~f].min(initial=most)) for x, f in zip(label, free)))
        label = [np.where((x == pivot) | ~f, home, x) for x, f in zip(label, free)]
        if all((x == y).all() for x, y in zip(before, label)):
            break
    links = [(int(n), int(x)) for i in (0, 1) for n, x in zip(names[i][free[i]], label[i][free[i]]) if n != x]
    return links + ([(pivot, home)] if home != pivot else [])


class _Family:
    """A pivot's members as differences from it, and the answers that follow from them.

    ``reach`` is twice the distance of a link: beyond it, a set is too far from all that links to the pivot.
    """

    def __init__(self, name: int, pivot: np.ndarray, percent: int):
        self.name, self.pivot, self.percent = name, pivot, percent
        self.reach = reach_of(percent)
        self.rows: list[list] = []
        self.free = np.zeros(0, bool)   # members that nothing connects with the pivot so far
        self.members: list[int] = []
        self.lost: list[np.ndarray] = []
        self.gained: list[np.ndarray] = []

    def add(self, member: int, tokens: np.ndarray) -> None:
        at = np.minimum(np.searchsorted(self.pivot, tokens), len(self.pivot) - 1)
        common = self.pivot[at] == tokens
        overlap = int(common.sum())
        union = len(tokens) + len(self.pivot) - overlap
        distance = 1 - overlap / union
        if distance <= self.reach:
            self.members.append(len(self.rows))
            self.lost.append(np.delete(np.arange(len(self.pivot)), at[common]))
            self.gained.append(tokens[~common])
        self.rows.append([member, distance, 100 * overlap >= self.percent * union, None])

    def block(self) -> dict[str, bytes | int]:
        """The members within reach, for a comparison with those of another chunk."""
        sizes = [np.array([len(x) for x in side], np.int64) for side in (self.lost, self.gained)]
        flat = [np.concatenate([np.zeros(0, np.int64), *self.lost]), np.concatenate([np.zeros(0, np.uint64), *self.gained])]
        names = np.array([self.rows[i][0] for i in self.members], np.int64)
        arrays = (names, self.free.astype(np.uint8), sizes[0], sizes[1], flat[0], flat[1])
        return {"width": len(self.pivot), **{n: pack(a) for (n, _), a in zip(BLOCK, arrays)}}

    def _linked(self) -> np.ndarray:
        """Which members within reach link, the pivot as the first."""
        lost, gained = [np.zeros(0, np.int64), *self.lost], [np.zeros(0, np.uint64), *self.gained]
        sides = [(np.concatenate(x), np.array([len(y) for y in x], np.int64)) for x in (lost, gained)]
        linked = linked_by_differences(len(self.pivot), *sides, *sides, self.percent)
        np.fill_diagonal(linked, True)
        return linked

    def answers(self) -> list[list]:
        """Rows (member, distance, near, link): ``link`` is the least set of the member's component within reach."""
        if self.members:
            names = np.array([self.name, *(self.rows[i][0] for i in self.members)], np.int64)
            label, linked = names, self._linked()
            while True:
                least = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1)
                if (least == label).all():
                    break
                label = least
            self.free = label[1:] != label[0]
            for i, own, found in zip(self.members, names[1:].tolist(), label[1:].tolist()):
                self.rows[i][3] = found if found != own else None
            # The pivot itself, so that its component is named too.
            if label[0] != self.name:
                self.rows.append([self.name, 0.0, True, int(label[0])])
        return self.rows


def compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(pivot, other, chunk, distance, near, link, chunks, block) for distinct pairs (pivot, other), in groups of a pivot.

    A pivot with many others is split over chunks; pivots are counted first, and only those with more than
    one chunk take part in that join. Each chunk of such a pivot adds a row with nothing but its block, for ``cross``.
    """
    share = F.greatest(F.ceil(F.count(F.lit(1)) / CHUNK), F.ceil(F.sum("other_size") / CHUNK_SHINGLES))
    sizes = pairs.groupBy("pivot").agg(share.cast("int").alias("chunks")).filter("chunks > 1")
    chunked = stage(pairs.join(sizes, "pivot", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))).select(
        "pivot", "other", "chunks", F.pmod(F.xxhash64("other"), "chunks").cast("int").alias("chunk")), "chunked")
    members = few(chunked).join(sets.withColumnRenamed("set", "other"), "other").select(
        "pivot", "chunk", F.lit(1).alias("role"), F.col("other").alias("set"), "tokens", "chunks")
    heads = few(stage(chunked.select("pivot", "chunk", "chunks").distinct(), "heads")).join(sets.withColumnRenamed("set", "pivot"), "pivot").select(
        "pivot", "chunk", F.lit(0).alias("role"), F.col("pivot").alias("set"), "tokens", "chunks")
    rows = members.unionByName(heads).repartition("pivot", "chunk").sortWithinPartitions("pivot", "chunk", "role", "set")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, family, last = None, None, None
        out: list[tuple] = []
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.bool_(), pa.int64(), pa.int32(),
                 pa.struct([("width", pa.int64()), *[(n, pa.binary()) for n, _ in BLOCK]]))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[]] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              names=["pivot", "other", "chunk", "distance", "near", "link", "chunks", "block"])

        def close() -> None:
            if family is not None:
                out.extend((group[0], r[0], group[1], r[1], r[2], r[3], None, None) for r in family.answers())
                if group[2] > 1 and family.members:
                    out.append((group[0], None, group[1], None, None, None, group[2], family.block()))

        for batch in batches:
            for pivot, chunk, role, member, blob, chunks in zip(*[c.to_pylist() for c in batch.columns]):
                if (pivot, chunk, chunks) != group:
                    close()
                    group, family, last = (pivot, chunk, chunks), None, None
                if member == last:  # a document that the table holds twice
                    continue
                last = member
                if role == 0:
                    family, last = _Family(pivot, _tokens(blob), percent), None
                else:
                    family.add(member, _tokens(blob))
                if len(out) > 10_000:
                    yield flush()
                    out.clear()
        close()
        yield flush()

    block = ", ".join(f"{n}: binary" for n, _ in BLOCK)
    return rows.mapInArrow(tidy(compared), "pivot long, other long, chunk int, distance double, near boolean, link long, "
                                           f"chunks int, block struct<width: long, {block}>")


def cross(compared: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the chunks of each family: one row for every two chunks, none for a pair of sets.

    A family whose members are all connected with the pivot needs no comparison, and two chunks of such members neither.
    """
    blocks = compared.filter("block IS NOT NULL").select("pivot", "chunk", "chunks", "block")
    other = F.explode(F.expr("filter(sequence(0, chunks - 1), c -> c <> chunk)")).alias("other")
    rows = blocks.select("pivot", "chunk", "block", other).select(
        "pivot", F.least("chunk", "other").alias("one"), F.greatest("chunk", "other").alias("two"), "chunk", "block")
    rows = rows.repartition("pivot", "one", "two").sortWithinPartitions("pivot", "one", "two", "chunk")

    def crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            links = []
            for i in range(batch.num_rows):  # one block at a time in Python
                pivot, one, two, _, block = (c[i].as_py() for c in batch.columns)
                if held is not None and held[0] == (pivot, one, two):
                    if any(unpack(x["free"], np.uint8).any() for x in (held[1], block)):
                        links += cross_links(pivot, held[1], block, percent)
                held = ((pivot, one, two), block)
            yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in links], pa.int64()) for n in (0, 1)], names=["a", "b"])

    return rows.mapInArrow(tidy(crossed), "a long, b long")


def links_of(compared: DataFrame) -> DataFrame:
    """Links that connect what links within each family."""
    return compared.filter("link IS NOT NULL").select(F.col("other").alias("a"), F.col("link").alias("b"))


def homes(compared: DataFrame, percent: int) -> DataFrame:
    """(set, home): the least pivot in whose reach a set is. All sets of a home are compared with each other."""
    own = compared.select(F.col("pivot").alias("set"), F.col("pivot").alias("home"))
    inside = compared.filter((F.col("distance") <= reach_of(percent)) & (F.col("pivot") != F.col("other"))).select(
        F.col("other").alias("set"), F.col("pivot").alias("home"))
    return own.unionByName(inside).groupBy("set").agg(F.min("home").alias("home"))


def open_pairs(lists: DataFrame, compared: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (pivot, other) that may link, are in different components and families, and are not
    excluded by what is known of their pivot.

    The bitmaps of the prefixes tell that two sets cannot share enough lists, so a list that many unlike sets
    are in gives few pairs. Of the lists that two sets share only those give the pair which may be among the first k of them, in the order
    of both, since what they have in common beyond these lies behind their places; a link shows in k such lists. k is a quarter of
    the common prefix shingles that a link needs: with fewer lists pairs are given less often, with more they are told apart better.
    """
    members = lists.select("list", F.explode("members").alias("m")).select("list", "m.set", "m.size", "m.place", "m.pivot")
    members = members.join(roots.select(F.col("id").alias("set"), "root"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    mixed = members.groupBy("list").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high").select("list")
    known = compared.filter("pivot <> other").select("pivot", F.col("other").alias("set"), "distance")
    members = members.join(mixed, "list", "left_semi").join(known, ["pivot", "set"], "left").join(homes(compared, percent), "set", "left")
    members = members.join(sets.select("set", "marks").dropDuplicates(["set"]), "set")
    rows = members.groupBy("list").agg(F.collect_list(F.struct(
        "set", "size", "place", "pivot", "root", "distance", F.col("home").alias("family"), "marks")).alias("m"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gap = 1 - percent / 100 + 1e-9
        for batch in batches:
            found: Counter[tuple[int, int, int, int]] = Counter()
            for rows_ in (x for low in range(0, batch.num_rows, 256) for x in batch.slice(low, 256).column(1).to_pylist()):
                rows_.sort(key=lambda r: (r["size"], r["place"], r["set"]))
                col = {n: np.array([r[n] for r in rows_]) for n in ("set", "size", "place", "pivot", "root")}
                homed = np.array([r["family"] is not None for r in rows_])
                family = np.array([r["family"] or 0 for r in rows_])
                is_pivot = col["set"] == col["pivot"]
                distance = np.where(is_pivot, 0.0, np.array([np.nan if r["distance"] is None else r["distance"] for r in rows_], float))
                ends = np.searchsorted(col["size"], col["size"] * 100 // percent, "right")
                marks = np.frombuffer(b"".join([r["marks"] for r in rows_]), np.uint64).reshape(len(rows_), MARKS)
                for i in range(len(rows_) - 1):
                    j = slice(i + 1, int(ends[i]))
                    keep = (col["root"][j] != col["root"][i]) & may_link(
                        col["size"][i], col["place"][i], col["size"][j], col["place"][j], percent)
                    with np.errstate(invalid="ignore"):  # an unknown distance excludes nothing
                        keep &= ~((col["pivot"][j] == col["pivot"][i]) & (np.abs(distance[j] - distance[i]) > gap))
                    keep &= ~(homed[j] & homed[i] & (family[j] == family[i]))
                    near = np.flatnonzero(keep)
                    other = col["size"][j][near]
                    behind = np.minimum(col["size"][i] - col["place"][i], other - col["place"][j][near])
                    first = np.maximum(needed_hits(col["size"][i], other, percent) // FIRST_LISTS, 1)
                    near = near[behind >= least_overlap(col["size"][i], other, percent) - first + 1]
                    near = near[enough_marks(col["size"][i], marks[i], col["size"][j][near], marks[j][near], percent)]
                    for x in near.tolist():
                        a, b = (i, i + 1 + x) if col["set"][i] < col["set"][i + 1 + x] else (i + 1 + x, i)
                        found[int(col["set"][a]), int(col["set"][b]), int(col["size"][a]), int(col["size"][b])] += 1
            left = sorted(found)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([k[n] for k in left], kind) for n, kind in enumerate(kinds)], pa.array([found[k] for k in left], pa.int32())],
                names=["pivot", "other", "pivot_size", "other_size", "hits"])

    made = rows.mapInArrow(tidy(pairs), "pivot long, other long, pivot_size int, other_size int, hits int")
    total = made.groupBy("pivot", "other", "pivot_size", "other_size").agg(F.sum("hits").alias("hits"))
    first = F.greatest(F.floor(least_hits("pivot_size", "other_size", percent) / FIRST_LISTS), F.lit(1))
    return total.filter(F.col("hits") >= first).select("pivot", "other", "other_size")


def strong(pairs: DataFrame, percent: int, share: float = 1.0) -> DataFrame:
    """Pairs (pivot, other, other_size) with as many hits as two sets that link must have, or a share of that number."""
    total = pairs.groupBy("pivot", "other", "pivot_size", "other_size").agg(F.sum("hits").alias("hits"))
    return total.filter(F.col("hits") >= F.lit(share) * least_hits("pivot_size", "other_size", percent)).select("pivot", "other", "other_size").distinct()


def similarity_classes(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                       buckets: int | None = None) -> DataFrame:
    """(id, key, n_shingles, component_id) for every row of ``docs``.

    Words are runs of other bytes than ASCII blanks, with A-Z in lower case; a document's set holds its distinct
    shingles of ``k`` words. Two documents link when 100 * intersection >= percent * union; ``component_id`` is the smallest
    id that links reach, itself included. ``key`` is ``xxhash64`` of the text and tells rows with equal ids
    apart. ``buckets`` (default: twice the shuffle partitions) are the ranges of shingle hashes.

    Null, empty and blank texts have 0 shingles, link with nothing and are their own component. Rows with a null
    id link like others, but never name a component (its id is null if no row has one). Repeated rows stay; an
    empty table gives no rows; other columns are ignored. Sets are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    prepare(spark, 8)
    buckets = buckets or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.col(text_col).cast("string")
    with scratch(spark):
        return hand_over(_classes(docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("key"), text.alias("text")),
                                  k, percent, buckets), "similarity")


def _classes(rows: DataFrame, k: int, percent: int, buckets: int) -> DataFrame:
    """``similarity_classes`` of (id, key, text), over tables that the caller's scratch block owns."""
    read = stage(read_sets(rows, k), "sets-read")
    known = read.filter("chunk IS NULL")
    classes = frequency_classes(read)
    lists = stage(index_lists(rows, k, percent, buckets, classes), "lists")
    # A pivot that several lists do not agree on may have lost hits here; then the pair is left open, and the lists decide.
    pairs = stage(strong(lists.filter("list IS NULL"), percent, STAR_SHARE), "pairs")
    in_lists = lists.filter("list IS NOT NULL").select(F.explode("members.set").alias("set")).distinct()
    first = known.filter("n > 0").groupBy(F.col("set_id").alias("set")).agg(F.min(F.struct("id", "key")).alias("doc"))
    wanted = stage(first.join(in_lists, "set", "left_semi").select(F.col("doc.id").alias("w_id"), F.col("doc.key").alias("w_key")), "wanted")
    sets = stage(stored_sets(rows, wanted, k, percent, classes), "sets")
    compared = stage(compare(pairs, sets, percent), "compared")
    links = stage(links_of(compared).unionByName(cross(compared, percent)), "family-links")
    roots = stage(components(links), "roots")
    rest = stage(open_pairs(lists.filter("list IS NOT NULL"), compared, roots, sets, percent), "open")
    if not rest.isEmpty():
        roots = stage(components(links.unionByName(links_of(compare(rest, sets, percent)))), "roots")
    return with_components(known, roots, "set_id").select("id", "key", F.col("n").alias("n_shingles"), "component_id")


def with_components(rows: DataFrame, roots: DataFrame, node: str) -> DataFrame:
    """``rows`` (with ``id``) and the smallest id of the component of their node; empty sets stay alone."""
    own = rows.select(node, "id", "n").filter("n > 0").groupBy(F.col(node).alias("node")).agg(F.min("id").alias("least"))
    rooted = own.join(roots.withColumnRenamed("id", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = stage(rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("node", "component_id"), "named")
    joined = rows.join(named, rows[node] == named["node"], "left")
    return joined.withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")))


def one_of_each(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id names their component in ``found``: one document of each group.

    Rows with equal ids count as one document, of which one row stays. Rows with a null id stay if no row of their
    component has an id.
    """
    keyed = docs.select(F.struct("*").alias("doc"), F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("key"))
    first = found.filter("id = component_id").groupBy("id").agg(F.min("key").alias("key"))
    named = keyed.join(first, ["id", "key"], "left_semi").dropDuplicates(["id", "key"])
    nameless = found.filter("id IS NULL AND component_id IS NULL").select("key").distinct()
    others = keyed.filter("id IS NULL").join(nameless, "key", "left_semi")
    return named.select("doc.*").unionByName(others.select("doc.*"))
