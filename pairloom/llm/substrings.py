"""Repeated passages: Rabin-Karp hashes of every window of words, counted in Spark.

1. Each map task hashes all windows of its batch and keeps, for each hash, the occurrences in the
   smallest document id. Occurrences in larger ids of the same batch are already known as repeats. So a
   passage that a third of all documents share leaves a batch once, whatever the number of its copies.
2. What is kept travels by ranges of the hash, sorted and packed: about nine bytes per window. Each range
   finds the smallest id of every hash and sends the windows of larger ids to their documents.
3. The windows of a document merge into maximal intervals, and their words go.

Hashes are polynomials modulo 2**61 - 1; among n windows a false repeat is expected about n * n / 2**62 times.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pairloom.llm.blocks import byte_hashes, column_bytes, mix, slices, window_hashes, words
from pairloom.llm.packed import pack, unpack
from pairloom.llm.ship import prepare, tidy, tidy_group

#: Bytes of text whose windows meet in one range of hashes, about; nine bytes a word travel, some fifty are held while a range is sorted.
RANGE_BYTES = 8 << 20
RESULT = ("kept", "n_words", "n_removed", "removed")


PARTS = (("hashes", np.uint64), ("doc", np.uint32), ("place", np.uint32), ("ids", np.int64), ("keys", np.int32))


def _message(bucket: int, hashes: np.ndarray, doc: np.ndarray, place: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> dict:
    """Windows in the order of their hashes; documents by number among those that occur."""
    used, doc = np.unique(doc, return_inverse=True)
    steps = np.diff(hashes, prepend=np.uint64(0))
    return {"bucket": bucket, "hashes": pack(steps), "doc": pack(doc.astype(np.uint32)), "place": pack(place.astype(np.uint32)),
            "ids": pack(ids[used]), "keys": pack(keys[used])}


def _batches(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _by_document(ids: np.ndarray, keys: np.ndarray, place: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """The windows of each document, as 32-bit numbers."""
    order = np.lexsort((place, keys, ids))
    ids, keys, place = ids[order], keys[order], place[order].astype("<u4")
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])
    first = np.flatnonzero(new)
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(ids)]):
        yield int(ids[a]), int(keys[a]), place[a:b].tobytes()


def _home(ids: np.ndarray, buckets: int) -> np.ndarray:
    """The group in which a document's windows meet."""
    return (mix(ids.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def repeated_windows(docs: DataFrame, id_: Column, key: Column, text: Column, width: int, buckets: int) -> DataFrame:
    """(id, key, places): first words of the windows that also start in a smaller id, one row for each document."""
    rows = docs.select(id_.cast("long").alias("id"), key.alias("key"), text.alias("text")).filter("id IS NOT NULL")
    wire = pa.schema([("bucket", pa.int32()), ("hashes", pa.binary()), ("doc", pa.binary()), ("place", pa.binary()),
                      ("ids", pa.binary()), ("keys", pa.binary())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0)).astype(np.int64)
            keys = np.asarray(batch.column(1)).astype(np.int32)
            data, offsets = column_bytes(batch.column(2))
            parts = []
            for low, high in slices(offsets, 1 << 20):  # 16 bytes a window stay of each slice
                begin = offsets[low]
                some, edges = data[begin:offsets[high]], offsets[low:high + 1] - begin
                starts, ends, counts = words(some, edges)
                windows, first = window_hashes(byte_hashes(some, starts, ends), counts, width)
                number = np.maximum(counts - width + 1, 0)
                place = first - np.repeat(np.cumsum(counts) - counts, number)
                parts.append((windows, np.repeat(np.arange(low, high, dtype=np.uint32), number), place.astype(np.uint32)))
            if not parts:
                continue
            windows, doc, place = (np.concatenate(x) for x in zip(*parts))
            del parts
            if not len(windows):
                continue
            rank = np.empty(len(ids), np.uint32)  # ids that are equal stay equal
            rank[:] = np.unique(ids, return_inverse=True)[1]
            order = np.lexsort((rank[doc], windows))
            windows, doc, place = windows[order], doc[order], place[order]
            del order
            new = np.ones(len(windows), bool)
            new[1:] = windows[1:] != windows[:-1]
            least = np.repeat(rank[doc[new]], np.diff(np.append(np.flatnonzero(new), len(windows))))
            sent = rank[doc] == least
            del least, new
            out = []
            if not sent.all():
                # Bucket -1 - b passes known repeats through the shuffle.
                known = ~sent
                at = np.flatnonzero(known)
                target = _home(ids[doc[at]], buckets)
                order = np.argsort(target, kind="stable")
                at, target = at[order], target[order]
                edges = np.searchsorted(target, np.arange(buckets + 1))
                for b in np.flatnonzero(np.diff(edges)).tolist():
                    at_b = at[edges[b]:edges[b + 1]]
                    at_b.sort()
                    out.append(_message(-1 - b, np.zeros(len(at_b), np.uint64), doc[at_b], place[at_b], ids, keys))
            windows, doc, place = windows[sent], doc[sent], place[sent]
            # Windows are sorted: the ranges of hashes that begin at b * 2**64 / buckets.
            bounds = np.array([(b << 64) // buckets for b in range(buckets)], np.uint64)
            edges = np.append(np.searchsorted(windows, bounds), len(windows))
            for b in np.flatnonzero(np.diff(edges)).tolist():
                s = slice(edges[b], edges[b + 1])
                out.append(_message(b, windows[s], doc[s], place[s], ids, keys))
            for low in range(0, len(out), 64):
                yield _batches(out[low:low + 64], wire)

    def opened(table: pa.Table) -> list[np.ndarray]:
        whole = []
        for row in table.to_pylist():
            parts = {name: unpack(row[name], kind) for name, kind in PARTS}
            doc = parts["doc"]
            whole.append((np.cumsum(parts["hashes"], dtype=np.uint64), parts["ids"][doc], parts["keys"][doc], parts["place"]))
        return [np.concatenate(x) for x in zip(*whole)]

    def counted(table: pa.Table) -> pa.Table:
        """Windows of one range of hashes; those in a larger id go to the home of their document."""
        hashes, ids, keys, place = opened(table)
        if table.column("bucket")[0].as_py() >= 0:
            order = np.lexsort((ids, hashes))
            hashes, ids, keys, place = hashes[order], ids[order], keys[order], place[order]
            new = np.ones(len(hashes), bool)
            new[1:] = hashes[1:] != hashes[:-1]
            least = np.repeat(ids[new], np.diff(np.append(np.flatnonzero(new), len(hashes))))
            again = ids > least
            ids, keys, place = ids[again], keys[again], place[again]
        order = np.lexsort((place, keys, ids, home := _home(ids, buckets)))
        ids, keys, place, home = ids[order], keys[order], place[order], home[order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])
        doc = np.cumsum(new) - 1
        edges = np.searchsorted(home, np.arange(buckets + 1))
        out = []
        for b in np.flatnonzero(np.diff(edges)).tolist():
            s = slice(edges[b], edges[b + 1])
            out.append(_message(b, np.zeros(s.stop - s.start, np.uint64), doc[s], place[s], ids[new], keys[new]))
        return pa.Table.from_pylist(out, schema=wire)

    found_schema = pa.schema([("id", pa.int64()), ("key", pa.int32()), ("places", pa.binary())])

    def gathered(table: pa.Table) -> pa.Table:
        _, ids, keys, place = opened(table)
        columns = list(zip(*_by_document(ids, keys, place))) or [[], [], []]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, found_schema)], schema=found_schema)

    message = "bucket int, hashes binary, doc binary, place binary, ids binary, keys binary"
    sent = rows.mapInArrow(tidy(hashed), message).groupBy("bucket").applyInArrow(tidy_group(counted), message)
    return sent.groupBy("bucket").applyInArrow(tidy_group(gathered), "id long, key int, places binary")


def remove_repeats(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   keep_unchanged: bool = False, buckets: int | None = None) -> DataFrame:
    """``docs`` with (kept, n_words, n_removed, removed): repeats of smaller ids' windows are cut out.

    A word goes if a window of ``width`` words that covers it also starts in a document with a smaller id; windows
    are judged on the input. ``removed`` lists the maximal intervals of such words, ``kept`` is
    the rest, joined by one blank, or the untouched text where nothing went and ``keep_unchanged`` is
    set. ``buckets`` are the hash ranges, one group of rows each (default: one per ``RANGE_BYTES`` of text, at least the shuffle partitions).

    Null and empty texts have no words and are kept as empty text; a null id neither loses nor takes words; documents
    with equal ids do not take from each other; an empty table gives no rows. Columns of ``docs`` stay, but those named
    like a result column are replaced.
    """
    spark = docs.sparkSession
    prepare(spark, 8)
    docs = docs.drop(*[c for c in RESULT if c not in (id_col, text_col)])
    text = F.col(text_col)
    key, ident = F.hash(text), F.col(id_col).cast("long")
    if buckets is None:
        size = docs.agg(F.sum(F.octet_length(text.cast("string")))).first()[0] or 0
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    places = repeated_windows(docs, ident, key, text, width, buckets)
    left = docs.select(F.struct("*").alias("doc"), ident.alias("id"), key.alias("key"))
    joined = left.join(places, ["id", "key"], "left").select("doc", "places")
    field = docs.columns.index(text_col)

    spans = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    schema = T.StructType([
        T.StructField("doc", joined.schema["doc"].dataType), T.StructField("kept", T.StringType()),
        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("removed", T.ArrayType(T.StructType([
            T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(0).field(field))
            body, edges = data.tobytes(), offsets.tolist()
            kept, total, gone, removed = [], [], [], []
            for a, b, found in zip(edges, edges[1:], batch.column(1).to_pylist()):
                raw = body[a:b]
                some = raw.split()
                total.append(len(some))
                if not found:
                    kept.append(raw if keep_unchanged else b" ".join(some))
                    gone.append(0)
                    removed.append([])
                    continue
                at = np.frombuffer(found, "<u4").astype(np.int64)
                steps = np.zeros(len(some) + 1, np.int64)
                np.add.at(steps, at, 1)
                np.add.at(steps, at + width, -1)
                covered = np.cumsum(steps)[:-1] > 0
                turns = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
                kept.append(b" ".join([some[i] for i in np.flatnonzero(~covered).tolist()]))
                gone.append(int(covered.sum()))
                removed.append([{"first": int(x), "last": int(y) - 1} for x, y in zip(turns[::2], turns[1::2])])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                pa.array(removed, spans),
            ], names=schema.names)

    made = joined.mapInArrow(tidy(cut), schema)
    return made.select("doc.*", *[c for c in RESULT])
