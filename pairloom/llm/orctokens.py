"""Token ids in ORC: stripes with integer run-length encoding, row indexes, Bloom filters on document ids.

Files hold the documents in ascending id order, each file one range of ids. A reader takes
stripes in parallel; a search by id skips files and stripes by their statistics and Bloom filters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from pairloom.llm import vocab
from pairloom.llm.blocks import column_bytes, slices
from pairloom.llm.ship import prepare, tidy

ORC_OPTIONS = {
    "compression": "zstd", "orc.stripe.size": str(32 << 20), "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
}


def write_token_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2,
                    id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id`` and write (doc_id, range_no, range_start, n_tokens, ids).

    The texts are dealt by ranges of ids before they are encoded, so each is encoded once. ``range_start``
    counts the ids before the document in its range; ranges are numbered in ascending order.
    Rows with equal ids are documents of their own, ordered by a hash of the text; a null id comes
    first; a null or empty text has the end id alone; an empty table gives an empty file; other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    schema = T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("range_no", T.IntegerType()),
        T.StructField("range_start", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    ])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        range_no, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for low, high in slices(offsets):
                begin = offsets[low]
                ids, upto = vocab.encode_bytes(tokenizer, data[begin:offsets[high]], offsets[low:high + 1] - begin, end_id)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low), pa.array(np.full(high - low, range_no, np.int32)),
                    pa.array(before + upto[:-1]), pa.array(np.diff(upto)),
                    pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(ids.astype(np.int32))),
                ], names=[f.name for f in schema])
                before += int(upto[-1])

    ordered.mapInArrow(tidy(encode), schema).write.options(**ORC_OPTIONS).orc(path)


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ``start`` counts the ids of all documents before.

    The sums of the ranges, one row for each range that was written, are all that is broadcast.
    """
    stored = spark.read.orc(path)
    sizes = stored.groupBy("range_no").agg(F.sum("n_tokens").alias("size"))
    before = F.sum("size").over(Window.orderBy("range_no")) - F.col("size")
    starts = sizes.select("range_no", before.alias("before"))
    joined = stored.join(F.broadcast(starts), "range_no")
    return joined.select("doc_id", (F.col("before") + F.col("range_start")).alias("start"), "n_tokens", "ids")


def find_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Stored rows of a few documents; the filter reaches the scan, where statistics and Bloom filters prune."""
    return spark.read.orc(path).filter(F.col("doc_id").isin(doc_ids)).select("doc_id", "n_tokens", "ids")
