"""Evaluation of judgments and datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions.stats import count_where, ratio
from pairloom.functions.text import strip
from pairloom.schemas import CRITERIA


def exact_match(predictions: DataFrame, references: DataFrame, key: str) -> DataFrame:
    """Share of equal texts, ignoring case and outer whitespace; 0 when a side lacks a key or both are empty."""
    shape = lambda c: F.lower(strip(c))
    left = predictions.select(key, shape("prediction").alias("p"), F.lit(True).alias("has_p"))
    right = references.select(key, shape("reference").alias("r"), F.lit(True).alias("has_r"))
    both = left.join(right, key, "full_outer")
    one_sided = count_where(F.col("has_p").isNull() | F.col("has_r").isNull())
    n, equal = F.count(F.lit(1)), count_where(F.col("p") == F.col("r"))
    return both.agg(F.when((n == 0) | (one_sided > 0), 0.0).otherwise(ratio(equal, n)).alias("exact_match"))


def judgment_metrics(judgments: DataFrame, by: list[str] | None = None) -> DataFrame:
    """total, passed, failed, pass_rate and the mean of each score; zeros when there are none."""
    total, passed = F.count(F.lit(1)), count_where(F.col("passed"))
    means = [F.coalesce(F.avg(f"scores.{n}"), F.lit(0.0)).alias(f"avg_{n}") for n in CRITERIA]
    return judgments.groupBy(*(by or [])).agg(
        total.alias("total"), passed.alias("passed"), (total - passed).alias("failed"),
        ratio(passed, total).alias("pass_rate"), *means,
    )


def category_name(missing: str) -> Column:
    """The category, with one name for a missing or empty one."""
    return F.coalesce(F.nullif(F.col("category"), F.lit("")), F.lit(missing))


def category_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(category_name("unknown").alias("category")).agg(F.count(F.lit(1)).alias("n"))


def evaluate_dataset(pairs: DataFrame, judgments: DataFrame | None = None) -> DataFrame:
    """Long form (section, key, value): size, categories and, if given, judgment metrics.
    An empty dataset gives the single row ('error', 'Empty dataset', NULL)."""
    counts = category_counts(pairs)
    row = lambda section, key, value: [F.lit(section).alias("section"), key.alias("key"), value.cast("double").alias("value")]
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    empty = F.col("n") == 0
    head = total.select(F.when(empty, "error").otherwise("dataset").alias("section"),
                        F.when(empty, "Empty dataset").otherwise("total_samples").alias("key"),
                        F.when(~empty, F.col("n")).cast("double").alias("value"))
    out = head.unionByName(counts.select(*row("category", F.col("category"), F.col("n"))))
    if judgments is None:
        return out
    metrics = judgment_metrics(judgments).filter("total > 0")
    names = metrics.columns
    long = metrics.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("key"), F.col(n).cast("double").alias("value")) for n in names])).alias("m"))
    return out.unionByName(long.select(F.lit("judgments").alias("section"), "m.key", "m.value"))


def list_datasets(meta: DataFrame) -> DataFrame:
    """name, pairs, source and tags of every dataset, sorted by name; unreadable rows are skipped."""
    return meta.filter(F.col("name").isNotNull()).select(
        "name", F.col("row_count").alias("pairs"), "source", F.array_join("tags", ",").alias("tags")).orderBy("name")


def inventory(name: str, stages: dict[str, DataFrame | None], judgments: DataFrame | None = None) -> DataFrame:
    """Which stages of a dataset exist: (dataset, artifact, status, sets)."""
    out = None
    for artifact, df in stages.items():
        n = df.limit(1).agg(F.count(F.lit(1)).alias("n")) if df is not None else None
        status = F.when(F.col("n") > 0, "present").otherwise("missing") if n is not None else None
        row = n.select(F.lit(artifact).alias("artifact"), status.alias("status"), F.lit(None).cast("bigint").alias("sets")) \
            if n is not None else None
        if row is None:
            anchor = next(d for d in [*stages.values(), judgments] if d is not None).sparkSession.range(1)
            row = anchor.select(F.lit(artifact).alias("artifact"), F.lit("missing").alias("status"), F.lit(None).cast("bigint").alias("sets"))
        out = row if out is None else out.unionByName(row)
    if judgments is not None:
        sets = judgments.agg(F.count_distinct("tag").alias("sets"))
        out = out.unionByName(sets.select(
            F.lit("judgments").alias("artifact"), F.when(F.col("sets") > 0, "present").otherwise("missing").alias("status"), "sets"))
    return out.select(F.lit(name).alias("dataset"), "artifact", "status", "sets")
