"""Power-of-two packing: every document falls into binary-length pieces, one piece per sequence.

A document of n ids gives n // longest pieces of ``longest`` ids, then one piece for each
set bit of the rest, largest first. Equal lengths form a bucket; a sequence of a bucket is
exactly one piece, so no sequence crosses documents and none needs padding. The work is one pass
without a shuffle, so neither a hot source nor a long document meets others in a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from pairloom.llm import vocab
from pairloom.llm.blocks import column_bytes, slices
from pairloom.llm.ship import prepare, tidy


def piece_lengths(tokens: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the pieces of all documents in a row, and the number of pieces of each."""
    bits = longest.bit_length() - 1
    lengths = np.array([longest] + [1 << b for b in range(bits - 1, -1, -1)], np.int64)
    times = np.empty((len(tokens), len(lengths)), np.int64)
    times[:, 0] = tokens >> bits
    for j in range(1, len(lengths)):
        times[:, j] = (tokens >> (bits - j)) & 1
    return np.repeat(np.tile(lengths, len(tokens)), times.ravel()), times.sum(axis=1)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, longest: int = 2048,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents: (id, start, length, ids, doc_tokens, bucket, sequence_id, offset).

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit integers, ``bucket`` the
    power of two, ``start`` the document's ids before the piece; ``sequence_id`` is unique,
    not dense, and the same in every retry of a task. ``tokenizer`` is a file of the tokenizers library
    whose words are independent of each other (blanks are dropped). Null and empty texts give one piece
    with ``end_id`` alone; rows with equal or null ids are documents of their own; an
    empty table gives no piece; other columns are ignored.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
    ])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for low, high in slices(offsets):
                begin = offsets[low]
                ids, upto = vocab.encode_words(tokenizer, data[begin:offsets[high]], offsets[low:high + 1] - begin, end_id)
                tokens = np.diff(upto)
                lengths, pieces = piece_lengths(tokens, longest)
                edges = np.concatenate([[0], np.cumsum(lengths)])
                which = np.repeat(np.arange(high - low), pieces)
                body = pa.Array.from_buffers(pa.binary(), len(lengths), [
                    None, pa.py_buffer((edges * 4).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(which + low)), pa.array(edges[:-1] - upto[:-1][which]),
                    pa.array(lengths), body, pa.array(tokens[which]),
                ], names=["id", "start", "length", "ids", "doc_tokens"])

    made = rows.mapInArrow(tidy(split), schema)
    return made.select(
        F.col("id").alias(id_col), "start", "length", "ids", "doc_tokens",
        F.log2("length").cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
