"""Judges compared with each other and with labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.functions.stats import (cohens_kappa, confusion, count_where, kappa_label, pearson, prf, ratio)
from pairloom.session import stage


def align_runs(judgments: DataFrame, tag_a: str | Column, tag_b: str | Column, order: str = "seq") -> DataFrame:
    """Pairs judged in both runs, with the last verdict of each: one aggregation, no join."""
    picked = {}
    for side, tag in (("a", tag_a), ("b", tag_b)):
        of_run = F.col("tag") == tag
        verdict = F.struct("passed", F.col("scores.overall").alias("overall"))
        picked[side] = F.max_by(F.when(of_run, verdict), F.when(of_run, F.col(order))).alias(side)
    runs = judgments.filter((F.col("tag") == tag_a) | (F.col("tag") == tag_b))
    both = runs.groupBy("pair_id").agg(*picked.values()).filter("a IS NOT NULL AND b IS NOT NULL")
    return both.select("pair_id", F.col("a.passed").alias("a_pass"), F.col("b.passed").alias("b_pass"),
                       F.col("a.overall").alias("a_score"), F.col("b.overall").alias("b_score"))


def compare_runs(judgments: DataFrame, tag_a: str, tag_b: str, order: str = "seq") -> DataFrame:
    """One row: agreement, kappa with its label, correlation, passed counts and means.
    Without common pairs n_common is 0 and the rates are 0; callers treat that as an error."""
    both = align_runs(judgments, tag_a, tag_b, order)
    a, b = F.col("a_pass"), F.col("b_pass")
    base = both.agg(
        F.count(F.lit(1)).alias("n_common"), *[c.alias(k) for k, c in confusion(a, b).items()],
        pearson(F.col("a_score"), F.col("b_score")).alias("score_pearson"),
        count_where(a).alias("a_passed"), count_where(b).alias("b_passed"),
        F.coalesce(F.avg("a_score"), F.lit(0.0)).alias("a_mean"), F.coalesce(F.avg("b_score"), F.lit(0.0)).alias("b_mean"),
    )
    counts = [F.col(k) for k in ("tp", "fp", "tn", "fn")]
    kappa = cohens_kappa(*counts)
    return base.select(
        F.lit(tag_a).alias("tag_a"), F.lit(tag_b).alias("tag_b"), "n_common",
        ratio(F.col("tp") + F.col("tn"), F.col("n_common")).alias("pass_agreement"),
        kappa.alias("cohens_kappa"), kappa_label(kappa).alias("kappa_label"),
        "score_pearson", "a_passed", "b_passed", "a_mean", "b_mean",
    )


def confusion_report(rows: DataFrame, pred: str = "pred", truth: str = "truth") -> DataFrame:
    """One row: n, the four counts, precision, recall, F1 and accuracy."""
    counts = rows.agg(F.count(F.lit(1)).alias("n_evaluated"),
                      *[c.alias(k) for k, c in confusion(F.col(pred), F.col(truth)).items()])
    shares = prf(*[F.col(k) for k in ("tp", "fp", "tn", "fn")])
    return counts.select("*", *[c.alias(k) for k, c in shares.items()])


def labels_as_of(judgments: DataFrame, log: DataFrame, order: str = "seq") -> DataFrame:
    """``judgments`` with ``known``: (status, labeler, labeled_at) of the pair's last label not later than ``judged_at``, or null.

    Among labels of one time the later line of the log counts. Verdicts and labels meet in one table sorted by pair and time, whose ranges split
    the history of a hot pair; within a range the last label is carried along, and from range to range it
    is carried by one row for each range that a pair has. A verdict or label without a time knows, or tells, nothing.
    """
    label = F.struct("status", "labeler", "labeled_at")
    place = log.schema[order].dataType
    told = log.filter("labeled_at IS NOT NULL").select(
        "pair_id", F.col("labeled_at").alias("_at"), F.lit(0).alias("_kind"), F.col(order).alias("_place"), label.alias("_label"),
        F.lit(None).cast(judgments.schema).alias("_verdict"))
    asked = judgments.select(
        "pair_id", F.col("judged_at").alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(place).alias("_place"),
        F.lit(None).cast(told.schema["_label"].dataType).alias("_label"), F.struct("*").alias("_verdict"))
    history = stage(told.unionByName(asked).repartitionByRange("pair_id", "_at", "_kind", "_place").withColumn(
        "_part", F.spark_partition_id()), "history")
    inside = Window.partitionBy("_part", "pair_id").orderBy("_at", "_kind", "_place").rowsBetween(Window.unboundedPreceding, 0)
    rows = history.withColumn("known", F.last("_label", ignorenulls=True).over(inside)).filter("_kind = 1")
    ends = history.groupBy("pair_id", "_part").agg(F.max_by("_label", F.when(F.col("_kind") == 0, F.struct("_at", "_place"))).alias("end"))
    earlier = Window.partitionBy("pair_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_before", F.last("end", ignorenulls=True).over(earlier)).filter("_before IS NOT NULL").drop("end")
    found = rows.join(carried, ["pair_id", "_part"], "left").withColumn(
        "known", F.when(F.col("_at").isNotNull(), F.coalesce("known", "_before")))
    return found.select("_verdict.*", "known")


def calibrate_as_of(judgments: DataFrame, log: DataFrame, approved_is: str = "approved", order: str = "seq") -> DataFrame:
    """Verdicts against what was known when they were made; verdicts before the first label of their pair do not count."""
    known = labels_as_of(judgments, log, order).filter("known IS NOT NULL")
    return confusion_report(known.select(
        F.col("passed").alias("pred"), F.coalesce(F.col("known.status") == approved_is, F.lit(False)).alias("truth")))


def calibrate(judgments: DataFrame, labels: DataFrame, approved_is: str = "approved",
              labeler: str | None = None) -> DataFrame:
    """Verdicts against labels (one row per pair_id on each side); every other status is negative."""
    truth = labels.filter(F.col("labeler") == labeler) if labeler else labels
    common = judgments.select("pair_id", F.col("passed").alias("pred")).join(
        truth.select("pair_id", F.coalesce(F.col("status") == approved_is, F.lit(False)).alias("truth")), "pair_id")
    return confusion_report(common)
