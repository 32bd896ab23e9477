"""Stored records: codecs, sinks, and the folder layout of a dataset's artefacts."""

from __future__ import annotations

import os
import re
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from pairloom.functions.text import canonical_id, iso_timestamp, text
from pairloom.functions.verdict import tier
from pairloom.operators.ingest import canonical_pairs, tolerant_pairs
from pairloom.operators.judge import fill_scores
from pairloom.schemas import JUDGMENT, LABEL, PAIR, STATUSES
from pairloom.session import recover_folders, replace_folder
from pairloom.sources.blocks import place
from pairloom.sources.readers import numbered, read_jsonl

# The columns of a CSV export and the timestamp text of stored records.
CSV_COLUMNS = ["id", "instruction", "input", "output", "category"]
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


# ----- codecs -----

def to_json_record(columns: list[str | Column]) -> Column:
    """One JSON object per row, nulls kept, timestamps in ISO-8601."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false", "timestampFormat": ISO_FORMAT})


def pair_records(pairs: DataFrame) -> DataFrame:
    return pairs.select(to_json_record(PAIR.fieldNames()).alias("value"))


def judgment_records(judgments: DataFrame) -> DataFrame:
    """Judgments as JSON, with the derived quality tier (ignored when read back)."""
    graded = judgments.withColumn("quality_tier", tier())
    return graded.select(to_json_record([*JUDGMENT.fieldNames(), "quality_tier"]).alias("value"))


def label_records(labels: DataFrame) -> DataFrame:
    return labels.select(to_json_record(LABEL.fieldNames()).alias("value"))


def _as_text(schema: T.StructType) -> T.StructType:
    """The schema with timestamps read as text, so that every ISO spelling is accepted."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampType) else f.dataType) for f in schema])


# ----- readers of stored records -----

def load_pairs(spark: SparkSession, path: str, tolerant: bool = False) -> DataFrame:
    """Stored pairs from JSONL; with ``tolerant``, records that are not valid pairs are dropped."""
    if tolerant:
        return tolerant_pairs(read_jsonl(spark, path, lenient=True))
    records = spark.read.schema(_as_text(PAIR)).option("mode", "FAILFAST").json(path)
    ordered = numbered(records.select(*place(), *PAIR.fieldNames()))
    return canonical_pairs(ordered.withColumns({c: text(c) for c in ("instruction", "output")}))


def load_pairs_or_empty(spark: SparkSession, path: str) -> DataFrame:
    """Stored pairs, none when the path does not exist."""
    try:
        return load_pairs(spark, path, tolerant=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        seq = T.StructField("seq", T.StructType([
            T.StructField("file", T.StringType()), T.StructField("row", T.LongType())]))
        return spark.createDataFrame([], T.StructType([seq, *PAIR.fields]))


def load_judgments(spark: SparkSession, path: str, dataset: str | None = None) -> DataFrame:
    """Stored judgments from JSONL, one run per file or folder; a malformed line is an error.

    Partial scores are filled and ids made canonical. With ``dataset``, only runs named
    ``<dataset>.<tag>.jsonl`` are read, whether that is a file or the folder a sink wrote, and give the tag.
    """
    records = spark.read.schema(_as_text(JUDGMENT)).option("mode", "FAILFAST").json(path)
    ordered = records.select(*place(), *JUDGMENT.fieldNames())
    if dataset is not None:
        name = rf"/{re.escape(dataset)}\.([^/]+)\.jsonl(/[^/]*)?$"
        ordered = ordered.withColumn("tag", F.regexp_extract("_file", name, 1)).filter("tag != ''")
    read = numbered(ordered).withColumns({
        "pair_id": canonical_id("pair_id"), "judged_at": iso_timestamp("judged_at"),
        "passed": F.coalesce("passed", F.lit(False)),
        "judge_model": text("judge_model"), "judgment_reasoning": text("judgment_reasoning"),
    })
    return fill_scores(read)


def load_labels(spark: SparkSession, path: str) -> DataFrame:
    """The label log from JSONL; malformed lines are skipped, ids canonical on both sides of joins."""
    records = spark.read.schema(_as_text(LABEL)).option("mode", "PERMISSIVE").json(path)
    ordered = numbered(records.select(*place(), *LABEL.fieldNames()))
    read = ordered.withColumns({"pair_id": canonical_id("pair_id"), "labeled_at": iso_timestamp("labeled_at"),
                                "labeler": F.coalesce("labeler", F.lit("user"))})
    return read.filter("pair_id IS NOT NULL AND status IS NOT NULL")


# ----- sinks -----

def write_pairs(pairs: DataFrame, path: str, fmt: str = "jsonl") -> None:
    """Pairs as a folder of JSONL, JSON, CSV or Parquet files; one sub-folder per split if there are splits."""
    split = ["split"] if "split" in pairs.columns else []
    if fmt in ("jsonl", "json"):
        out = pairs.select(*split, to_json_record(PAIR.fieldNames()).alias("value"))
        writer = lambda w, to: w.option("compression", "none").text(to)
    elif fmt == "csv":
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in CSV_COLUMNS]
        out = pairs.select(*split, *cells)
        writer = lambda w, to: w.option("header", True).option("escape", '"').option("emptyValue", "").csv(to)
    elif fmt == "parquet":
        out, writer = pairs, lambda w, to: w.parquet(to)
    else:
        raise ValueError(f"no such format: {fmt}")
    sink = out.write.partitionBy(*split) if split else out.write
    replace_folder(pairs.sparkSession, path, lambda to: writer(sink, to))


def append_labels(labels: DataFrame, path: str) -> int:
    """Append to the label log and return how many. An unknown status is an error: the write
    fails as a whole and leaves nothing behind. Rows are checked and counted as they are written."""
    seen = Observation()
    known = F.when(F.col("status").isin(STATUSES), F.col("status"))
    problem = F.raise_error(F.concat(F.lit("not a label status: "), text("status"))).cast("string")
    checked = labels.withColumn("status", F.coalesce(known, problem)).observe(seen, F.count(F.lit(1)).alias("n"))
    try:
        checked.write.mode("append").parquet(path)
    except Exception as e:
        if "not a label status: " in str(e):
            raise ValueError(str(e)[str(e).index("not a label status: "):].splitlines()[0]) from None
        raise
    return seen.get["n"]


SAFE = " !$&'()+,;@~"   # besides letters, digits and _.-, in a folder's name
TEXT_PARTS = ("dataset", "tag", "run", "cache_rubric", "cache_backend", "cache_model")


# Texts of a row that mostly repeat each other (a seed, what was asked of it and what was answered) lie in one column,
# side by side, where compression sees the repeats; reading gives them back as columns of their own.
TOGETHER = {"cycle_pairs": ("instruction", "output", "source_seed")}
TEXTS = "_texts"


def _together(df: DataFrame, kind: str) -> DataFrame:
    names = TOGETHER.get(kind, ())
    return df.select(*[c for c in df.columns if c not in names], F.array(*names).alias(TEXTS)) if names else df


def _apart(df: DataFrame, kind: str) -> DataFrame:
    """The columns as they were; the texts come last."""
    if TEXTS not in df.columns:
        return df
    return df.select(*[c for c in df.columns if c != TEXTS], *[F.col(TEXTS)[i].alias(n) for i, n in enumerate(TOGETHER[kind])])


class DatasetStore:
    """Parquet artefacts under one shared folder:

    pairs/dataset=…, meta/dataset=…, reports/dataset=…, judgments/dataset=…/tag=…, labels/dataset=…,
    judgment_cache/cache_rubric=…/cache_version=…/cache_backend=…/cache_model=…,
    cycle_pairs/loop_run=…/cycle_id=…, cycle_judgments/…, training/…. Reading one dataset, tag or cycle
    prunes the others; writing one replaces that partition only, once the new one is complete.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        recover_folders(spark, self.root)

    def path(self, kind: str, **parts) -> str:
        return os.path.join(self.root, kind, *[f"{k}={quote(str(v), safe=SAFE)}" for k, v in parts.items()])

    def put(self, df: DataFrame, kind: str, mode: str = "overwrite", **parts) -> DataFrame:
        """Write one partition and read it back. Texts are most of it, and zstd makes them a third smaller than snappy.

        Row groups of 32 MB, since a task that reads takes whole ones: with the default of 128 MB few tasks get them all.
        """
        path = self.path(kind, **parts)
        out = _together(df.drop(*parts), kind)
        writer = out.write.option("compression", "zstd").option("parquet.block.size", 32 << 20)
        if mode == "overwrite":
            replace_folder(self.spark, path, writer.parquet)
        else:
            writer.mode(mode).parquet(path)
        values = [F.lit(v).alias(k) for k, v in parts.items()]
        return _apart(self.spark.read.schema(out.schema).parquet(path).select("*", *values), kind)

    def get(self, kind: str, **parts) -> DataFrame:
        """One partition, with its partition values as columns. Names stay text even if they look like numbers or dates."""
        read = lambda reader: reader.option("basePath", self.path(kind)).parquet(self.path(kind, **parts))
        df = read(self.spark.read)
        named = {f.name: f.dataType for f in df.schema if f.name in TEXT_PARTS}
        if all(isinstance(t, T.StringType) for t in named.values()):
            return _apart(df, kind)
        fields = [T.StructField(f.name, T.StringType()) if f.name in named else f for f in df.schema]
        return _apart(read(self.spark.read.schema(T.StructType(fields))), kind)

    def find(self, kind: str, **parts) -> DataFrame | None:
        """Like ``get``, None when it was never written."""
        try:
            return self.get(kind, **parts)
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def cycles(self, kind: str, upto: int | None = None, loop_run: int | None = None) -> DataFrame | None:
        """All cycles of a run of the loop (the newest by default), optionally up to one."""
        loop_run = self.last_run() if loop_run is None else loop_run
        table = self.find(kind)
        table = table if table is None else table.filter(F.col("loop_run") == loop_run)
        return table if table is None or upto is None else table.filter(F.col("cycle_id") <= upto)

    def last_run(self) -> int:
        """The newest run of the loop, 0 when none has begun."""
        runs = self.find("loop_runs")
        return 0 if runs is None else (runs.agg(F.max("loop_run")).first()[0] or 0)

    def begin_run(self) -> int:
        """The number of a new run, which leaves what older runs stored alone."""
        number = self.last_run() + 1
        self.put(self.spark.range(1), "loop_runs", loop_run=number)
        return number

    def last_cycle(self, loop_run: int | None = None) -> int:
        """The newest cycle of a run with metrics, 0 when there is none."""
        metrics = self.cycles("cycle_metrics", loop_run=loop_run)
        return 0 if metrics is None else (metrics.agg(F.max("cycle_id")).first()[0] or 0)
