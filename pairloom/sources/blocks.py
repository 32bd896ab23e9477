"""Files whose row ends depend on all that stands before them, read by many tasks.

CSV cells may hold line breaks, and a JSON document is one value. Whether a place is inside quotes, and how deep it is
nested, follows from the whole file before it. So each block of a file is scanned once for both possible starts and
reports what it does to either: where it ends, how the depth changes, how many cuts it has at each depth. These functions
compose; running sums over the blocks of a file, a few numbers each, tell how every block really starts. Then
the blocks are cut, all at once. What a block leaves open at its ends is joined with the pieces from its neighbours.

Both scans run inside one call with the splits held fixed, and the rows are staged, so nothing is numbered twice.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain, groupby

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pairloom.session import stage

#: Rows of a table about blocks that are sent to every task; beyond it the join shuffles.
FEW_BLOCKS = 1_000_000
IN_QUOTES, OUTSIDE = 1, 0

_FIELDS = re.compile(r'(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|),)*+')   # whole fields, each with its comma
_OPEN = re.compile(r'"[^"]*+(?:""[^"]*+)*+\Z')                                   # a quoted field that goes on
_QUOTED = re.compile(r'[^"]*+(?:""[^"]*+)*+')                                    # inside quotes, up to their end
_STRING_END = re.compile(r'[^"\\]*+(?:\\.[^"\\]*+)*+("?)', re.S)
_TOKEN = re.compile(r'"[^"\\]*+(?:\\.[^"\\]*+)*+("?)|[\[\]{},]', re.S)


def place() -> list[Column]:
    """Where a scan finds a row: file, block, and a number that ascends within the block."""
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row")]


def with_blocks(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows with what is known of their block; the narrow side is counted before it is sent to every task."""
    return rows.join(F.broadcast(blocks) if blocks.count() <= FEW_BLOCKS else blocks, ["_file", "_block"])


class Csv:
    """Lines; a cut is the end of a line outside of quotes. A quote within an unquoted cell is a character."""

    separator = "\n"

    @staticmethod
    def limit(begin: Column) -> Column:
        """The deepest level of cuts, by the first sign of the file."""
        return F.lit(0)

    @staticmethod
    def walk(text: str, state: int, depth: int) -> tuple[list[tuple[int, int, int, str]], int, int]:
        """Cuts (place, level, level of the text before it, delimiter), and the state and depth behind the text."""
        if '"' in text:
            at = 0
            if state == IN_QUOTES:
                at = _QUOTED.match(text).end()
                if at < len(text):  # the closing quote, and what else is in the cell
                    state, comma = OUTSIDE, text.find(",", at)
                    at = len(text) if comma < 0 else comma + 1
            if state == OUTSIDE and at < len(text):
                at = _FIELDS.match(text, at).end()
                state = IN_QUOTES if _OPEN.match(text, at) else OUTSIDE
        return ([(len(text), 0, 0, "\n")] if state == OUTSIDE else []), state, 0


class Json:
    """Pieces up to a closing brace; cuts are commas and brackets."""

    separator = "}"

    @staticmethod
    def limit(begin: Column) -> Column:
        return F.when(begin == "[", 1).otherwise(2)

    @staticmethod
    def walk(text: str, state: int, depth: int) -> tuple[list[tuple[int, int, int, str]], int, int]:
        cuts, at = [], 0
        if state == IN_QUOTES:
            end = _STRING_END.match(text)
            if not end.group(1):
                return cuts, state, depth
            at = end.end()
        state = OUTSIDE
        for token in _TOKEN.finditer(text, at):
            sign = token.group()
            if sign in "[{":
                cuts.append((token.start(), depth + 1, depth, sign))
                depth += 1
            elif sign in "]}":
                cuts.append((token.start(), depth, depth, sign))
                depth -= 1
            elif sign == ",":
                cuts.append((token.start(), depth, depth, sign))
            elif not token.group(1):
                state = IN_QUOTES
        return cuts, state, depth


@contextmanager
def _fixed_splits(spark: SparkSession) -> Iterator[None]:
    """The same blocks in both scans, also when executors come or go between them; Arrow batches bounded by bytes."""
    wanted = {
        "spark.sql.files.minPartitionNum": spark.conf.get("spark.sql.files.minPartitionNum", None) or str(spark.sparkContext.defaultParallelism),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of one block after another, as they come: a block lies in one task."""
    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns])

    yield from groupby(rows(), key=lambda r: (r[0], r[1]))


def _with_end(rows: Iterator[tuple]) -> Iterator[tuple | None]:
    """The rows of a block as they come, then None: no task holds all rows of a block."""
    return chain(rows, [None])


def _measure(lines: DataFrame, kind: type) -> DataFrame:
    """What each block does to either start."""
    names = ["_file", "_block", "bytes", "head", "end_0", "end_1", "depth_0", "depth_1", "cuts_0", "cuts_1"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(),
             pa.map_(pa.int64(), pa.int64()), pa.map_(pa.int64(), pa.int64())]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block), rows in _by_block(batches):
            state, depth, cuts, size, head = [OUTSIDE, IN_QUOTES], [0, 0], [Counter(), Counter()], 0, ""
            for _, _, value, length in rows:
                size += length + 1
                head = head or value.lstrip("\ufeff \t\r\n")[:1] or (kind.separator if kind is Json else "")
                text = value + kind.separator if kind is Json else value
                for i in (0, 1):
                    found, state[i], depth[i] = kind.walk(text, state[i], depth[i])
                    cuts[i].update([level for _, level, _, _ in found])
            row = [file, block, size, head, *state, *depth, list(cuts[0].items()), list(cuts[1].items())]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    return lines.select("_file", "_block", "value", F.octet_length("value")).mapInArrow(
        measured, "_file string, _block long, bytes long, head string, end_0 int, end_1 int, depth_0 long, depth_1 long, "
                  "cuts_0 map<bigint,bigint>, cuts_1 map<bigint,bigint>")


def _starts(measured: DataFrame, kind: type) -> DataFrame:
    """How every block starts: state, depth, number of cuts before it; and the file's total size and last depth.

    A block either keeps the state, or swaps it, or ends alike from both; so the state before a block is that after the last block
    of the third sort, swapped as often as since then.
    """
    order = Window.partitionBy("_file").orderBy("_block")
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_file")
    fixed = F.col("end_0") == F.col("end_1")
    rows = measured.withColumn("swaps", F.sum(F.when(~fixed & (F.col("end_0") == 1), 1).otherwise(0)).over(upto))
    last = lambda c: F.coalesce(F.last(F.when(fixed, F.col(c)), ignorenulls=True).over(before), F.lit(0))
    swaps = F.coalesce(F.last("swaps").over(before), F.lit(0)) - last("swaps")
    rows = rows.withColumn("state", ((last("end_0") + swaps) % 2).cast("int"))
    own = lambda c: F.when(F.col("state") == 1, F.col(f"{c}_1")).otherwise(F.col(f"{c}_0"))
    begin = F.first(F.when(F.col("head") != "", F.col("head")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumns({"limit": kind.limit(begin).cast("long"), "own_depth": own("depth"), "own_cuts": own("cuts"), "own_end": own("end")})
    rows = rows.withColumn("depth", F.coalesce(F.sum("own_depth").over(before), F.lit(0)))
    seen = F.expr("""aggregate(map_entries(own_cuts), 0L, (n, e) -> n + IF(e.key + depth <= `limit`, e.value, 0L))""")
    rows = rows.withColumn("seen", seen).withColumn("first", F.coalesce(F.sum("seen").over(before), F.lit(0)))
    return rows.select(
        "_file", "_block", "state", "depth", "first", "limit", F.sum("bytes").over(whole).alias("total"),
        (F.max("_block").over(whole) == F.col("_block")).alias("final"), (F.col("depth") + F.col("own_depth")).alias("last_depth"),
        F.col("own_end").alias("last_state"))


def units(spark: SparkSession, path: str, kind: type, least_size: int = 0) -> tuple[DataFrame, DataFrame]:
    """The texts between the cuts that count: staged (file, row, level, delimiter, text), and the table of blocks.

    ``level`` is the depth of the text, ``delimiter`` the sign that ended it; both are null where the file ended. Only files of more than
    ``least_size`` bytes are read.
    """
    with _fixed_splits(spark):
        lines = spark.read.option("lineSep", kind.separator).text(path).filter(F.col("_metadata.file_size") > least_size).select(
            *place(), "value", F.col("_metadata.file_size").alias("_size"))
        blocks = stage(_starts(_measure(lines, kind), kind), "blocks")
        columns = ["_file", "_block", "value", "_size", "state", "depth", "first", "limit", "total", "final"]
        known = with_blocks(lines, blocks)
        if blocks.count() > FEW_BLOCKS:
            known = known.repartition("_file", "_block").sortWithinPartitions("_file", "_block", "_row")
        schema = pa.schema([("file", pa.string()), ("row", pa.int64()), ("block", pa.int64()), ("level", pa.int64()),
                            ("delimiter", pa.string()), ("text", pa.string()), ("whole", pa.bool_())])

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out: list[tuple] = []
            size = 0

            def flush() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*out)) or [[]] * 7, schema)], schema=schema)

            for (file, block), rows in _by_block(batches):
                parts: list[str] = []
                row = None
                held = None  # a piece is scanned when it is known whether another one follows
                for line in _with_end(rows):
                    if held is not None:
                        _, _, value, file_size, state0, depth0, first, most, total, final = held
                        if row is None:
                            row, state, depth = first, state0, depth0
                        ends = line is None and final and total > file_size - 3 and total not in (file_size, file_size - 3)
                        text = value + kind.separator if kind is Json and not ends else value
                        found, state, depth = kind.walk(text, state, depth)
                        at = 0
                        for place_, level, text_level, sign in found:
                            if level <= most:
                                parts.append(text[at:place_])
                                whole = "".join(parts)
                                out.append((file, row, block, text_level, sign, whole, row > first))
                                size += len(whole)
                                parts, at, row = [], place_ + 1, row + 1
                        if at < len(text) or kind is Csv and state == IN_QUOTES:
                            parts.append(text[at:])
                        if kind is Csv and state == IN_QUOTES:
                            parts.append("\n")
                        if size > 4 << 20 or len(out) > 20_000:
                            yield flush()
                            out, size = [], 0
                    held = line
                if any(parts):
                    out.append((file, row, block, None, None, "".join(parts), False))
            yield flush()

        found = stage(known.select(*columns).mapInArrow(
            cut, "file string, row long, block long, level long, delimiter string, text string, whole boolean"), "pieces")
    pieces = found.filter("NOT whole").groupBy("file", "row").agg(
        F.max("level").alias("level"), F.max("delimiter").alias("delimiter"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "text"))), lambda x: x["text"]), "").alias("text"))
    columns = ["file", "row", "level", "delimiter", "text"]
    return found.filter("whole").select(*columns).unionByName(pieces.select(*columns)), blocks


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, row, text): the records of CSV files, with their line breaks; blank lines are left out."""
    rows, _ = units(spark, path, Csv)
    text = F.regexp_replace("text", "\r$", "")
    return rows.select("file", "row", text.alias("text")).filter(F.trim("text") != "")


def json_elements(spark: SparkSession, path: str, least_size: int = 0) -> DataFrame:
    """(file, place, text): the elements of JSON documents that are a list, or an object whose ``data`` is one.

    The elements are not parsed; what surrounds them is checked, and anything else is an error.
    """
    rows, blocks = units(spark, path, Json, least_size)
    rows = stage(rows, "units")
    closed = blocks.filter("final").select(
        F.col("_file").alias("file"), F.col("limit"), "last_state", "last_depth", F.col("total"))
    sizes = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"), F.col("length"))
    # The last piece was measured with a brace that the file may not have.
    extra = F.when((F.col("total") - F.col("length")).isin(0, -3), 0).otherwise(1)
    torn = closed.join(sizes, "file").filter((F.col("last_state") != 0) | (F.col("last_depth") + extra != 0))
    outer = rows.filter("level IS NULL OR level <= 1").withColumn("text", F.regexp_replace("text", "^\ufeff", ""))
    blank = F.trim(F.translate("text", "\t\r\n", "   ")) == ""
    top = F.coalesce("level", F.lit(0)) == 0
    loose = outer.filter(top & (~blank | (F.col("delimiter") == ",")) | (F.col("level") == 0) & (F.col("row") > 0))
    problem = torn.select("file").unionByName(loose.select("file")).limit(1).collect()
    if problem:
        raise ValueError(f"malformed JSON document: {problem[0]['file']}")
    first = rows.filter("row = 0").select("file", F.col("delimiter").alias("root"))
    named = F.col("text").rlike(r'^\s*"data"\s*:\s*$') & (F.col("delimiter") == "[")
    inside = outer.filter("level = 1").join(first.filter("root = '{'"), "file")
    starts = inside.filter(named).groupBy("file").agg(F.max("row").alias("before"))
    ends = inside.join(starts, "file").filter("row > before").groupBy("file").agg(F.min("row").alias("behind"))
    lists = starts.join(ends, "file").select("file", "before", "behind", F.lit(2).alias("depth"), F.lit("}").alias("close")).unionByName(
        first.filter("root = '['").select("file", F.lit(0).cast("long").alias("before"), F.lit(None).cast("long").alias("behind"),
                                          F.lit(1).alias("depth"), F.lit("]").alias("close")))
    missing = closed.join(lists, "file", "left_anti").limit(1).collect()
    if missing:
        raise ValueError(f"a JSON document must be a list of rows or hold one under data: {missing[0]['file']}")
    # What ends the outermost value, and the list, must match what began them.
    ended = rows.filter("level = 1 AND delimiter IN (']', '}')").join(lists, "file").filter(F.col("delimiter") != F.col("close"))
    wrong = ended.select("file").unionByName(
        rows.filter("level = 2 AND delimiter = '}'").join(lists.filter("depth = 2"), "file").filter(
            "row > before AND row < behind").select("file")).limit(1).collect()
    if wrong:
        raise ValueError(f"malformed JSON document: {wrong[0]['file']}")
    found = rows.join(lists, "file").filter("level = depth AND row > before AND (behind IS NULL OR row < behind)")
    single = found.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    kept = found.join(single, "file").filter(~((F.col("n") == 1) & (F.trim(F.translate("text", "\t\r\n", "   ")) == "")))
    return kept.select("file", (F.col("row") - F.col("before") - 1).alias("place"), "text")
