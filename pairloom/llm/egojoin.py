"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with a cosine of at least t are at most sqrt(2 - 2t) = epsilon apart. Vectors are rotated onto their
principal axes and sorted by grid cells of width epsilon on the leading axes (the epsilon grid order). The
sorted sequence is cut into blocks, blocks into ever larger intervals. An interval's box bounds the leading axes and the norm on all others. The join starts with the
whole sequence against itself and goes down the intervals, two at a time, level by level in Spark; a pair of intervals
whose boxes are more than epsilon apart is skipped with all that is below. What is left are pairs of blocks, whose
vectors are compared in double precision, again by intervals of a block. Vectors travel in groups of blocks, as they came.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pairloom.llm.components import components
from pairloom.llm.ship import prepare, tidy
from pairloom.session import hand_over, scratch, stage

#: Leading axes that order the vectors and bound distances, and cells of the grid in an epsilon.
AXES, CELLS = 16, 2
#: Vectors in a block, in an interval of a block, and intervals in the next larger one.
BLOCK, PART, FAN = 512, 64, 16
#: Blocks that travel together, and their bytes at most (one block at least).
SHIPPED, SHIPPED_BYTES = 16, 4 << 20
#: Numbers in a part of the sums that a task sends, and parts that are added at once.
CHUNK, SUMMED = 1 << 18, 16
#: Rounding of the norm on the axes that do not lead, which is the root of a small difference.
SLACK = 1e-6


def vector_classes(vectors: DataFrame, embedding: Column) -> DataFrame:
    """(one, two, unit flag, embedding, n): distinct valid vectors, equal ones counted together before the shuffle.

    A vector is valid if it is neither null, empty nor zero and all its components are finite.
    """
    values = vectors.select(embedding.cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    valid = values.filter(F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(finite, F.lit(False)))
    valid = valid.filter(F.exists("v", lambda x: x != 0))
    return valid.groupBy(*hashes(F.col("v"))).agg(F.count(F.lit(1)).alias("n"), F.first("v").alias("v"))


def hashes(v: Column) -> list[Column]:
    """128 bits by which vectors are told apart."""
    return [F.xxhash64(v).alias("one"), F.xxhash64(F.lit(1), v).alias("two")]


def _raw(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    """Unit vectors, one a row; the components are scaled first, so that no square overflows or vanishes."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _box(unit: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest coordinates on the leading axes, and of the norm on all others.

    The distance of two vectors is at least that of their boxes, since norms differ by at most the norm of the difference.
    """
    lead = unit @ axes[:, :AXES]
    rest = np.sqrt(np.maximum(1 - (lead * lead).sum(axis=1), 0))
    return np.append(lead.min(axis=0), rest.min() - SLACK), np.append(lead.max(axis=0), rest.max() + SLACK)


def principal_axes(classes: DataFrame, width: int) -> np.ndarray:
    """A rotation onto the principal axes, widest first.

    A task sends its sums of products in parts of ``CHUNK`` numbers, which are added in a tree; the driver gets width * width numbers.
    """
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mean, n = np.zeros((width, width)), np.zeros(width), 0
        for batch in batches:
            unit = _unit(_raw(batch.column(0)))
            total += unit.T @ unit
            mean += unit.sum(axis=0)
            n += len(unit)
        if not n:
            return
        values, task = np.concatenate([total.ravel(), mean, [n]]), TaskContext.get().partitionId()
        for chunk, at in enumerate(range(0, len(values), CHUNK)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int32()), pa.array([task], pa.int32()), pa.array([values[at:at + CHUNK].tobytes()], pa.binary())],
                names=["chunk", "task", "sums"])

    def added(table: pa.Table) -> pa.Table:
        whole = sum(np.frombuffer(x, np.float64) for x in table.column("sums").to_pylist())
        return pa.table({"chunk": table.column("chunk")[:1], "task": table.column("task")[:1], "sums": pa.array([whole.tobytes()], pa.binary())})

    kind = "chunk int, task int, sums binary"
    parts = stage(classes.select("v").mapInArrow(tidy(products), kind), "products")
    tasks = parts.agg(F.max("task")).first()[0]
    while True:
        tasks //= SUMMED
        parts = parts.withColumn("task", F.expr(f"task div {SUMMED}").cast("int")).groupBy("chunk", "task").applyInArrow(added, kind)
        if not tasks:
            break
    found = {row["chunk"]: row["sums"] for row in parts.toArrow().to_pylist()}
    values = np.frombuffer(b"".join(found[chunk] for chunk in sorted(found)), np.float64)
    mean = values[width * width:-1] / values[-1]
    _, axes = np.linalg.eigh(values[:width * width].reshape(width, width) / values[-1] - np.outer(mean, mean))
    return axes[:, ::-1].copy()


def ordered_blocks(classes: DataFrame, axes: np.ndarray, epsilon: float, kind: type) -> DataFrame:
    """(block, low, high, ids, sizes, vectors): runs of BLOCK vectors in epsilon grid order, with their boxes.

    ``block`` is range * 2**32 + number, ascending in the order. The vectors are numbers of ``kind``, not yet of unit length.
    """
    lead = min(AXES, axes.shape[0])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.floor(_unit(_raw(batch.column(2))) @ axes[:, :lead] * (CELLS / epsilon)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(pa.array(np.arange(len(cells) + 1, dtype=np.int32) * lead), pa.array(cells.ravel()))],
                names=["id", "n", "v", "cells"])

    rows = classes.select(F.col("id"), "n", "v").mapInArrow(tidy(placed), "id long, n long, v array<double>, cells array<int>")
    rows = rows.repartitionByRange("cells", "id").sortWithinPartitions("cells", "id")
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("low", T.ArrayType(T.DoubleType())),
        T.StructField("high", T.ArrayType(T.DoubleType())), T.StructField("ids", T.BinaryType()),
        T.StructField("sizes", T.BinaryType()), T.StructField("vectors", T.BinaryType()),
    ])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32

        def block(at: int, ids: np.ndarray, sizes: np.ndarray, raw: np.ndarray) -> pa.RecordBatch:
            low, high = _box(_unit(raw), axes)
            values = [[number + at], [low.tolist()], [high.tolist()], [ids.tobytes()], [sizes.tobytes()], [raw.astype(kind).tobytes()]]
            kinds = [pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=schema.names)

        ids, sizes, raw = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, axes.shape[0]))
        done = 0
        for batch in batches:
            ids = np.concatenate([ids, np.asarray(batch.column(0))])
            sizes = np.concatenate([sizes, np.asarray(batch.column(1))])
            raw = np.concatenate([raw, _raw(batch.column(2))])
            low = 0
            for low in range(BLOCK, len(ids) + 1, BLOCK):
                yield block(done, ids[low - BLOCK:low], sizes[low - BLOCK:low], raw[low - BLOCK:low])
                done += 1
            ids, sizes, raw = ids[low:], sizes[low:], raw[low:]
        if len(ids):
            yield block(done, ids, sizes, raw)

    return rows.mapInArrow(tidy(blocks), schema)


def _apart(low_a: str, high_a: str, low_b: str, high_b: str) -> Column:
    """Square of the least distance of two boxes."""
    gaps = f"zip_with(zip_with({low_a}, {high_b}, (x, y) -> x - y), zip_with({low_b}, {high_a}, (x, y) -> x - y), (x, y) -> greatest(x, y, 0D))"
    return F.expr(f"aggregate({gaps}, 0D, (s, g) -> s + g * g)")


def numbered_boxes(blocks: DataFrame) -> DataFrame:
    """(block, low, high, node): ``node`` numbers all blocks in their order, from 0."""
    ranges = blocks.groupBy(F.shiftright("block", 32).alias("range")).agg(F.count(F.lit(1)).alias("n")).collect()
    first, total = [], 0
    for row in sorted(ranges, key=lambda r: r["range"]):  # one row for each partition of the sorted sequence
        first.append((row["range"], total))
        total += row["n"]
    begin = blocks.sparkSession.createDataFrame(first, "range long, first long")
    node = (F.col("first") + F.col("block").bitwiseAND((1 << 32) - 1)).alias("node")
    boxes = blocks.select("block", "low", "high").join(F.broadcast(begin), F.shiftright("block", 32) == F.col("range"))
    return stage(boxes.select("block", "low", "high", node), "boxes")


def block_pairs(level: DataFrame, epsilon: float) -> DataFrame:
    """Pairs (a, b), a <= b, of numbered blocks whose boxes are at most epsilon apart.

    Intervals of FAN blocks, of FAN such intervals and so on are joined from the top: the pairs that are left on a
    level meet the children of their two intervals, by equality of the parent.
    """
    levels = [level]
    lead, nodes = level.agg(F.max(F.size("low")), F.count(F.lit(1))).first()
    while nodes > 1:
        boxes = levels[-1].groupBy(F.floor(F.col("node") / FAN).alias("node")).agg(
            F.array(*[F.min(F.col("low")[i]) for i in range(lead)]).alias("low"),
            F.array(*[F.max(F.col("high")[i]) for i in range(lead)]).alias("high"))
        levels.append(stage(boxes, "boxes"))
        nodes = -(-nodes // FAN)
    pairs = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    limit = F.lit(_limit(epsilon))
    for level in reversed(levels[:-1]):
        child = lambda side: level.select(
            F.floor(F.col("node") / FAN).alias(side), F.col("node").alias(f"{side}_node"), F.col("low").alias(f"{side}_low"),
            F.col("high").alias(f"{side}_high"))
        pairs = pairs.join(child("a"), "a").join(child("b"), "b").filter("a_node <= b_node")
        pairs = pairs.filter(_apart("a_low", "a_high", "b_low", "b_high") <= limit)
        pairs = stage(pairs.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")), "interval-pairs")
    return pairs


class _Block:
    """A block as it came, with its unit vectors and the boxes of its intervals."""

    def __init__(self, block: dict, axes: np.ndarray, kind: type):
        self.ids, self.sizes = np.frombuffer(block["ids"], np.int64), np.frombuffer(block["sizes"], np.int64)
        self.unit = _unit(np.frombuffer(block["vectors"], kind).astype(np.float64).reshape(len(self.ids), -1))
        self.cuts = [slice(i, i + PART) for i in range(0, len(self.ids), PART)]
        self.low, self.high = (np.array(x) for x in zip(*[_box(self.unit[c], axes) for c in self.cuts]))


def _limit(epsilon: float) -> float:
    return epsilon * epsilon * (1 + 1e-9) + 1e-12


def _close_parts(a: _Block, b: _Block, epsilon: float) -> Iterator[tuple[slice, slice]]:
    """Intervals of two blocks that are not provably distant; of one block with itself, each two once."""
    gap = np.maximum(np.maximum(a.low[:, None] - b.high[None], b.low[None] - a.high[:, None]), 0)
    for i, j in np.argwhere((gap * gap).sum(axis=2) <= _limit(epsilon)).tolist():
        if a is not b or i <= j:
            yield a.cuts[i], b.cuts[j]


def _links(a: _Block, b: _Block, least: float, epsilon: float) -> pa.RecordBatch | None:
    """(id, links, root) of the vectors that link in a pair of blocks."""
    alone = a is b
    near = np.zeros((len(a.ids), len(b.ids)), bool)
    for x, y in _close_parts(a, b, epsilon):
        near[x, y] = a.unit[x] @ b.unit[y].T >= least
    if alone:
        near |= near.T
        np.fill_diagonal(near, False)
    if not near.any():
        return None
    both = [a] if alone else [a, b]
    counts = [near @ b.sizes] + ([] if alone else [near.T @ a.sizes])
    label = [x.ids.copy() for x in both]
    top = np.iinfo(np.int64).max
    while True:
        new0 = np.minimum(label[0], np.where(near, label[-1][None, :], top).min(axis=1))
        new1 = new0 if alone else np.minimum(label[1], np.where(near, new0[:, None], top).min(axis=0))
        if (new0 == label[0]).all() and (new1 == label[-1]).all():
            break
        label = [new0] if alone else [new0, new1]
    some = [c > 0 for c in counts]
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([x.ids[m] for x, m in zip(both, some)])),
        pa.array(np.concatenate([c[m] for c, m in zip(counts, some)])),
        pa.array(np.concatenate([x[m] for x, m in zip(label, some)])),
    ], names=["id", "links", "root"])


def linked_pairs(blocks: DataFrame, nodes: DataFrame, pairs: DataFrame, axes: np.ndarray, least: float, epsilon: float, kind: type) -> DataFrame:
    """(id, links, root): for each vector of a pair of blocks its links there, weighted by copies, and the least id
    of its component in that pair. At most two blocks of rows come from a pair, however many links it has.

    Blocks travel in groups, once for each two groups that have a pair, not once for each pair. One group of two is joined
    to the pairs and moved, the other stays; which of them is dealt out evenly.
    """
    together = max(1, min(SHIPPED, SHIPPED_BYTES // (BLOCK * axes.shape[0] * np.dtype(kind).itemsize)))
    groups = -(-nodes.count() // together)
    member = F.struct((F.col("node") % together).cast("int").alias("at"), "ids", "sizes", "vectors")
    grouped = blocks.select("block", "ids", "sizes", "vectors").join(nodes.select("block", "node"), "block").groupBy(
        F.floor(F.col("node") / together).alias("group")).agg(F.collect_list(member).alias("blocks"))   # at most SHIPPED of bounded size
    grouped = stage(grouped, "groups")
    at = lambda c: F.floor(F.col(c) / together)
    inside = (F.col("a") % together * together + F.col("b") % together).cast("int")
    dealt = pairs.groupBy(at("a").alias("x"), at("b").alias("y")).agg(F.collect_list(inside).alias("inside"))   # at most SHIPPED ** 2
    dealt = dealt.withColumn("turned", (F.col("x") + F.col("y")) % 2 == 1).select(
        F.when(F.col("turned"), F.col("y")).otherwise(F.col("x")).alias("a"), F.when(F.col("turned"), F.col("x")).otherwise(F.col("y")).alias("b"),
        "turned", "inside")
    dealt = stage(dealt, "group-pairs")
    named = lambda side: grouped.select(F.col("group").alias(side), F.col("blocks").alias(f"{side}_blocks"))
    tasks = max(1, 4 * groups)
    alone = dealt.filter("a = b").select("b", "turned", "inside").withColumn("a_blocks", F.lit(None).cast(grouped.schema["blocks"].dataType))
    moved = dealt.filter("a != b").join(named("a"), "a").select("b", "turned", "inside", "a_blocks").unionByName(alone)
    rows = moved.repartition(tasks, "b").join(named("b").repartition(tasks, "b").hint("shuffle_hash"), "b").select("turned", "inside", "a_blocks", "b_blocks")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                turned, inside, *sides = (column[n].as_py() for column in batch.columns)
                second = {block["at"]: _Block(block, axes, kind) for block in sides[1]}
                first = second if sides[0] is None else {block["at"]: _Block(block, axes, kind) for block in sides[0]}
                if turned:
                    first, second = second, first
                for pair in inside:
                    found = _links(first[pair // together], second[pair % together], least, epsilon)
                    if found is not None:
                        yield found

    return rows.mapInArrow(tidy(linked), "id long, links long, root long")


def near_duplicates(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", embedding_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) for every row: links are cosines of ``least`` or more in double precision.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id that links reach, itself included.
    Equal vectors are one class, which is compared once. Vectors that are null, empty or zero, or hold null or
    non-finite components, link with nothing. Rows with equal ids are vectors of their own; a null id never
    names a component and is not kept, unless its component has no id, which then is null too. Vectors of another
    width than the most are an error. An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    prepare(spark)
    if not 0 < least <= 1:
        raise ValueError("the least cosine must be above 0 and at most 1")
    with scratch(spark):
        return hand_over(_near_duplicates(vectors, least, id_col, embedding_col), "near-duplicates")


def _near_duplicates(vectors: DataFrame, least: float, id_col: str, embedding_col: str) -> DataFrame:
    """``near_duplicates`` over tables that the caller's scratch block owns."""
    epsilon = float(np.sqrt(max(2 - 2 * least, 1e-12))) * (1 + 1e-9) + 1e-9
    classes = stage(vector_classes(vectors, F.col(embedding_col)).withColumn("id", F.col("one")), "vectors")
    sample = classes.select(F.size("v").alias("width")).first()
    rows = vectors.select(F.col(id_col).cast("long").alias("row_id"), F.col(embedding_col).cast("array<double>").alias("v"))
    rows = rows.select("row_id", *hashes(F.col("v")))
    if sample is None:
        found = classes.select(F.col("one").alias("id"), F.lit(0).cast("long").alias("links"), F.col("one").alias("root"))
    else:
        width = sample["width"]
        checked = classes.withColumn("v", F.when(F.size("v") == width, F.col("v")).otherwise(
            F.raise_error(F.lit("vectors of different widths")).cast("array<double>")))
        axes = principal_axes(checked, width)
        kind = np.float32 if isinstance(vectors.schema[embedding_col].dataType.elementType, T.FloatType) else np.float64
        blocks = stage(ordered_blocks(checked, axes, epsilon, kind), "blocks")
        nodes = numbered_boxes(blocks)
        found = stage(linked_pairs(blocks, nodes, block_pairs(nodes, epsilon), axes, least, epsilon, kind), "links")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    per_class = classes.select("one", "two", "id", "n").join(counts, "id", "left").join(roots, "id", "left").select(
        "one", "two", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "id").alias("root"))
    per_class = stage(per_class, "classes")
    least_ids = rows.groupBy("one", "two").agg(F.min("row_id").alias("least")).join(per_class, ["one", "two"])
    least_ids = least_ids.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage(per_class.join(least_ids, "root").select("one", "two", "n_links", "component_id", F.lit(True).alias("valid")), "named")
    joined = rows.join(named, ["one", "two"], "left")
    component = F.when(F.col("valid"), F.col("component_id")).otherwise(F.col("row_id"))
    return joined.select(
        F.col("row_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("row_id") == component, F.lit(False)).alias("kept"))
