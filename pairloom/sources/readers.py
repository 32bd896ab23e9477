"""Raw rows from JSONL, a JSON document, CSV or a Parquet table.

JSON readers give (seq, row) with ``row`` a VARIANT, so each row keeps its own keys; CSV
and Parquet give their columns plus ``seq``: the file and the number of the row in it. It does
not depend on how files are split over tasks. Parquet stores row numbers; lines of text and CSV are
numbered once and written, so that later reads cannot number them anew.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pairloom.functions import variants as V
from pairloom.functions.text import strip
from pairloom.session import stage
from pairloom.sources.blocks import csv_records, json_elements, place, with_blocks

#: JSON documents of more bytes are read by many tasks.
WHOLE_BYTES = 64 << 20
SUFFIXES = {".jsonl": "jsonl", ".json": "json", ".csv": "csv", ".parquet": "table"}


def source_kind(path: str, fmt: str = "auto") -> str:
    """The format: as given, else by the suffix."""
    if fmt != "auto":
        if fmt not in SUFFIXES.values():
            raise ValueError(f"no such format: {fmt}")
        return fmt
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix not in SUFFIXES:
        raise ValueError(f"the suffix tells no format: {os.path.basename(path)}")
    return SUFFIXES[suffix]


def read_rows(spark: SparkSession, path: str, fmt: str = "auto", split: str | None = None) -> DataFrame:
    """Raw rows of any supported format."""
    kind = source_kind(path, fmt)
    try:
        if kind == "table":
            return read_table(spark, path, split)
        return {"jsonl": read_jsonl, "json": read_json, "csv": read_csv}[kind](spark, path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from e
        raise


def numbered(rows: DataFrame) -> DataFrame:
    """Rows with the columns of ``place`` get ``seq`` = (file, row number in the file) instead.

    A block lies in one task, so its rows are in a row; the rows of the blocks before it in the file are added. The rows are
    written and read once; the numbers of the blocks come to them, they do not move.
    """
    kept = stage(rows, "numbered")
    blocks = kept.groupBy("_file", "_block").agg(F.min("_row").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("_file").orderBy("_block")) - F.col("n")
    shifts = blocks.select("_file", "_block", (before - F.col("first")).alias("_shift"))
    seq = F.struct(F.col("_file").alias("file"), (F.col("_row") + F.col("_shift")).alias("row")).alias("seq")
    return with_blocks(kept, shifts).select(seq, *[c for c in rows.columns if c not in ("_file", "_block", "_row")])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = numbered(spark.read.text(path).select(*place(), "value"))
    return lines.select("seq", strip("value").alias("line")).filter("line != ''")


def read_jsonl(spark: SparkSession, path: str, lenient: bool = False) -> DataFrame:
    """One JSON value per line; blank lines are skipped. A malformed line is an error,
    or a row with a NULL ``row`` when lenient (see ``bad_lines``)."""
    return _lines(spark, path).select("seq", F.expr(V.strict_json("line", lenient)).alias("row"))


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """The malformed lines of a JSONL source."""
    return _lines(spark, path).filter(F.expr(V.strict_json("line")).isNull())


def read_json(spark: SparkSession, path: str, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """JSON documents: each file a list of rows, or an object whose ``data`` is that list.

    A file of up to ``whole_bytes`` is parsed as one value. Larger ones are cut into their elements by many
    tasks (``sources.blocks``), and each element is parsed on its own. Malformed text is an error either way.
    """
    small = F.col("_metadata.file_size") <= whole_bytes
    whole = spark.read.text(path, wholetext=True).filter(small).select(
        F.col("_metadata.file_path").alias("file"), F.expr(V.strict_json("value", lenient=False)).alias("doc"))
    listed = whole.selectExpr("file", """posexplode(coalesce(
        try_variant_get(doc, '$', 'array<variant>'), try_variant_get(doc, '$.data', 'array<variant>'),
        CAST(raise_error('a JSON document must be a list of rows or hold one under data') AS ARRAY<VARIANT>))) AS (place, row)""")
    rows = listed.selectExpr("struct(file, CAST(place AS BIGINT) AS row) AS seq", "row")
    if spark.read.format("binaryFile").load(path).filter(F.col("length") > whole_bytes).select("path").isEmpty():
        return rows
    parts = json_elements(spark, path, whole_bytes).withColumn("text", strip("text"))
    large = parts.select(F.struct("file", F.col("place").alias("row")).alias("seq"), F.expr(V.strict_json("text", lenient=False)).alias("row"))
    return rows.unionByName(large)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; every column is text and an empty cell is the empty string.

    Cells may hold line breaks. Files are split in any case: where every line is a row, by Spark's own reader; where a
    line may end within quotes, by a scan that knows how each block starts (``sources.blocks``). All files have the same header.
    """
    options = {"quote": '"', "escape": '"', "emptyValue": "", "nullValue": "\u0000", "enforceSchema": "false"}
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    # An odd number of quotes, or a quote inside what may be an unquoted cell.
    unsure = (quotes % 2 == 1) | F.col("value").rlike('(^|,)[^",][^,"]*"')
    if spark.read.text(path).filter(unsure).isEmpty():
        rows = spark.read.csv(path, header=True, **options)
        cells = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in rows.columns]
        return numbered(rows.select(*place(), *cells))
    columns = spark.read.csv(path, header=True, multiLine=True, **options).columns
    schema = ", ".join(f"c{i} string" for i in range(len(columns)))
    records = csv_records(spark, path).withColumn("cells", F.from_csv("text", schema, options | {"multiLine": "true"}))
    heads = records.filter("row = 0").select("file", F.array(*[F.col(f"cells.c{i}") for i in range(len(columns))]).alias("head"))
    other = heads.agg(F.min("head").alias("low"), F.max("head").alias("high")).filter("low <> high").collect()
    if other:
        raise ValueError(f"CSV files with different headers: {other[0]['low']} and {other[0]['high']}")
    seq = F.struct("file", (F.col("row") - 1).alias("row")).alias("seq")
    cells = [F.coalesce(F.col(f"cells.c{i}"), F.lit("")).alias(c) for i, c in enumerate(columns)]
    return records.filter("row > 0").select(seq, *cells)


def read_table(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A Parquet table, optionally one of its splits (a partition column, so other splits are not read)."""
    rows = spark.read.parquet(path)
    if split is not None and "split" in rows.columns:
        rows = rows.filter(F.col("split") == split).drop("split")
    seq = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return rows if "seq" in rows.columns else rows.withColumn("seq", seq)
