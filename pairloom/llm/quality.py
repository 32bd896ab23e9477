"""Text quality by nearest-neighbour voting in a latent-semantic space.

Labelled texts become weighted counts of hashed byte n-grams and of a few word statistics; a truncated singular
value decomposition of them gives the latent space. The labelled vectors are broadcast; every document is compared
with all of them by exact blocked cosine products, and its nearest neighbours vote by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from pairloom.llm.blocks import byte_hashes, column_bytes, mix, slices, sums, words
from pairloom.llm.ship import prepare, tidy

#: Columns of the count matrix: single bytes, hashed pairs, hashed triples, bins of word statistics.
SINGLES, PAIRS, TRIPLES, BINS = 256, 768, 1024, 16
STATISTICS = 5
FEATURES = SINGLES + PAIRS + TRIPLES + STATISTICS * BINS
#: Texts, and bytes of text, that are counted at a time: a byte takes some 60 bytes while it is.
ROWS, SLICE = 1024, 1 << 19


@dataclass
class Model:
    """Term weights, the latent space, and the labelled vectors in it (unit length)."""

    weights: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    power: float


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of relative feature counts for each text; an empty text has zeros."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    out = np.zeros((n, FEATURES), np.float32)
    left, right = 0, SINGLES
    code = data.astype(np.uint64)
    for length, width in ((1, SINGLES), (2, PAIRS), (3, TRIPLES)):
        right = left + width
        span = len(data) - length + 1
        if span > 0:
            inside = row[:span] == row[length - 1:]
            key = code[:span] if length == 1 else mix(code[:span]) % np.uint64(width)
            flat = (row[:span] * width + key.astype(np.int64))[inside]
            out[:, left:right] = np.bincount(flat, minlength=n * width).reshape(n, width)
        left = right
        if length < 3:
            code = code[:-1] * np.uint64(256) + data[length:].astype(np.uint64) if len(code) > 1 else code[:0]
    out[:, :right] /= np.maximum(size, 1)[:, None]
    starts, ends, number = words(data, offsets)
    if len(starts):
        text = np.repeat(np.arange(n), number)
        hashes = byte_hashes(data, starts, ends)
        order = np.lexsort((hashes, text))
        new = np.ones(len(order), np.int64)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (text[order][1:] != text[order][:-1])
        same = np.zeros(len(order), np.int64)
        same[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
        upper = ((data >= 0x41) & (data <= 0x5A)).astype(np.int64)
        letters = upper + ((data >= 0x61) & (data <= 0x7A)) + (data >= 0x80)
        some = np.maximum(number, 1)
        values = [
            sums(new, number) / some ** 0.8, sums(same, number) / some, sums(ends - starts, number) / some / 20,
            sums(upper, size) / np.maximum(sums(letters, size), 1), np.log1p(number) / 10,
        ]
        for value in values:
            bin_ = np.minimum((np.clip(value, 0, 1) * BINS).astype(np.int64), BINS - 1)
            out[np.arange(n), left + bin_] = (number > 0) / BINS
            left += BINS
    return out


def latent(found: np.ndarray, weights: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Unit vectors in the latent space; zeros stay zeros."""
    terms = np.sqrt(found) * weights
    out = terms @ space
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def fit_space(found: np.ndarray, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and the leading singular directions of the weighted counts, by subspace iteration."""
    share = (found > 0).mean(axis=0)
    weights = (1 + np.log(1 / np.maximum(share, 1 / max(len(found), 1)))).astype(np.float32)
    terms = np.sqrt(found) * weights
    basis = np.random.default_rng(1).standard_normal((FEATURES, dimensions)).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(terms.T @ (terms @ basis))
    return weights, basis


def vote(vectors: np.ndarray, model: Model, block: int = 512) -> np.ndarray:
    """Similarity-weighted share of label 1 among the nearest labelled vectors."""
    out = np.empty(len(vectors))
    k = min(model.neighbours, len(model.labels))
    for low in range(0, len(vectors), block):
        similar = vectors[low:low + block] @ model.vectors.T
        near = np.argpartition(similar, similar.shape[1] - k, axis=1)[:, -k:]
        weight = np.clip(np.take_along_axis(similar, near, axis=1).astype(np.float64), 1e-6, 1) ** model.power
        out[low:low + block] = (weight * model.labels[near]).sum(axis=1) / weight.sum(axis=1)
    return out


def _features(batches: Iterator[pa.RecordBatch], field: int | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of batches and the counts of their texts: the first column, or a field of it."""
    for batch in batches:
        data, offsets = column_bytes(batch.column(0) if field is None else batch.column(0).field(field))
        for first, last in slices(offsets, SLICE):
            for low in range(first, last, ROWS):  # the counts of a text take the same space, however short it is
                high = min(low + ROWS, last)
                begin = offsets[low]
                yield batch.slice(low, high - low), counts(data[begin:offsets[high]], offsets[low:high + 1] - begin)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label",
        max_labelled: int = 8000, dimensions: int = 64, neighbours: int = 61, power: float = 24.0) -> Model:
    """Fit on a sample of about ``max_labelled`` rows of ``labels``, chosen by a hash of the id.

    Labels other than 0 and 1, null ids and labels without a document are left out; null texts count as empty. The
    sampled labels are broadcast to the documents, and their count matrix, ``max_labelled`` rows of
    fixed width, is all that reaches the driver. Without any labelled row every score will be 0.5.
    """
    spark = docs.sparkSession
    prepare(spark)
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("label IN (0, 1)")
    total = known.count()
    if total > max_labelled:
        draw = F.pmod(F.xxhash64(F.lit(17), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        known = known.filter(draw < max_labelled / total)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(known), "id").select("text", "label")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _features(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r in found], pa.binary()), batch.column(1)], names=["counts", "label"])

    sample = rows.mapInArrow(tidy(counted), "counts binary, label int").toArrow()
    labels = sample.column("label").to_numpy().astype(np.float64)
    if not len(labels):
        return Model(np.ones(FEATURES, np.float32), np.zeros((FEATURES, dimensions), np.float32),
                     np.zeros((0, dimensions), np.float32), labels, neighbours, power)
    found = np.frombuffer(b"".join(sample.column("counts").to_pylist()), np.float32).reshape(-1, FEATURES)
    weights, space = fit_space(found, min(dimensions, FEATURES))
    return Model(weights, space, latent(found, weights, space), labels, neighbours, power)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1; higher: label 1 is likelier.

    Null and empty texts score as the empty vector does: all labelled rows are equally near to it, and the
    overall share of label 1 is its score. Equal texts score equally wherever they lie. Other columns stay, one named
    like the score is replaced; an empty table gives no rows. The broadcast holds the model alone, whose size is bounded by ``fit``.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.drop(name) if name != text_col else docs
    shared = spark.sparkContext.broadcast(model)
    rows, field = docs.select(F.struct("*").alias("doc")), docs.columns.index(text_col)
    kept = [F.col("doc").getField(c).alias(c) for c in docs.columns if c != name]
    schema = T.StructType([T.StructField("doc", rows.schema["doc"].dataType), T.StructField("score", T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found_model = shared.value
        share = float(found_model.labels.mean()) if len(found_model.labels) else 0.5
        for batch, found in _features(batches, field):
            vectors = latent(found, found_model.weights, found_model.space)
            empty = ~vectors.any(axis=1)
            scores = vote(vectors, found_model) if len(found_model.labels) else np.full(len(vectors), share)
            scores[empty] = share
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(scores, 0, 1))], names=schema.names)

    return rows.mapInArrow(tidy(scored), schema).select(*kept, F.col("score").alias(name))
