"""Cycles: failure seeds, metrics, summaries and reports over normalised cycle tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from pairloom.functions.stats import ratio
from pairloom.operators.evaluate import judgment_metrics

# How many failures seed the next cycle, the stop limit, the report classes.
FAILURE_SEEDS = 10
STOP_BELOW = 0.1
HIGH_FROM, MEDIUM_FROM = 70, 40


def failure_seeds(pairs: DataFrame, judgments: DataFrame, n: int = FAILURE_SEEDS, order: str = "seq") -> DataFrame:
    """The instructions of the first n failed judgments whose pair has one: (seq, seed).

    Only ids and places are joined. No more than n judgments of one pair can be among the
    first n, so the others go before the shuffle; the texts are read for the n rows found.
    """
    in_pair = Window.partitionBy("pair_id").orderBy("_at")
    failed = judgments.filter(~F.col("passed")).select("pair_id", F.col(order).alias("_at")) \
        .withColumn("_nth", F.row_number().over(in_pair)).filter(F.col("_nth") <= n).drop("_nth")
    first = pairs.groupBy(F.col("id").alias("pair_id")).agg(
        F.min(order).alias("_pair"), F.min_by(F.col("instruction") != "", order).alias("_said"))
    found = failed.join(first.filter("_said"), "pair_id").orderBy("_at").limit(n)
    texts = pairs.select(F.col(order).alias("_pair"), F.col("instruction").alias("seed"))
    return texts.join(F.broadcast(found), "_pair").select(F.col("_at").alias("seq"), "seed")   # n rows


def next_seeds(base: DataFrame, failures: DataFrame | None) -> DataFrame:
    """Base seeds, then the failures of the cycle before; equal seeds stay twice.

    ``seq`` of the base may be any orderable column; one that is not a whole number becomes (late, at, nth).
    """
    base = base.select("seq", "seed")
    numeric = isinstance(base.schema["seq"].dataType, T.IntegralType)
    if not numeric:   # any other order: the base seeds in theirs, then the failures
        base = base.withColumn("seq", F.struct(F.lit(0).alias("late"), F.col("seq").alias("at"), F.lit(0).cast("bigint").alias("nth")))
    if failures is None:
        return base
    # A fixed number of rows; they follow the last base seed in their own order.
    if not numeric:
        at = F.lit(None).cast(base.schema["seq"].dataType["at"].dataType)
        after = failures.agg(F.sort_array(F.collect_list(F.struct("seq", "seed"))).alias("f")) \
            .select(F.posexplode("f").alias("i", "s")) \
            .select(F.struct(F.lit(1).alias("late"), at.alias("at"), F.col("i").cast("bigint").alias("nth")).alias("seq"), F.col("s.seed").alias("seed"))
        return base.unionByName(after)
    last = base.agg(F.coalesce(F.max("seq"), F.lit(-1))).scalar()
    listed = failures.agg(F.sort_array(F.collect_list(F.struct("seq", "seed"))).alias("f"))
    after = listed.select(F.posexplode("f").alias("i", "s")).select((last + 1 + F.col("i")).alias("seq"), F.col("s.seed").alias("seed"))
    return base.select("seq", "seed").unionByName(after)


def cycle_metrics(pairs: DataFrame, judgments: DataFrame, order: str = "seq") -> DataFrame:
    """One row per cycle: generated, passed, failed, pass_rate, avg_quality and the mean of each score.

    A pair has passed when its last judgment in the cycle has. Pairs are counted per id before they
    meet the judgments, so an id with many rows is one row, and neither side multiplies the other.
    """
    last = judgments.groupBy("cycle_id", F.col("pair_id").alias("id")).agg(F.max_by("passed", order).alias("ok"))
    ids = pairs.groupBy("cycle_id", "id").agg(F.count(F.lit(1)).alias("n"))
    n, ok = F.sum("n"), F.sum(F.when(F.col("ok"), F.col("n")).otherwise(0))
    made = ids.join(last, ["cycle_id", "id"], "left").groupBy("cycle_id").agg(
        n.alias("generated"), ok.alias("passed"), (n - ok).alias("failed"), ratio(ok, n).alias("pass_rate"))
    judged = judgment_metrics(judgments, ["cycle_id"]).drop("total", "passed", "failed", "pass_rate")
    both = made.join(judged, "cycle_id", "full_outer")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("generated", "passed", "failed")} \
        | {c: F.coalesce(F.col(c), F.lit(0.0)) for c in both.columns if c.startswith("avg_") or c == "pass_rate"}
    return both.withColumns(zero).withColumn("avg_quality", F.col("avg_overall"))


def loop_summary(metrics: DataFrame) -> DataFrame:
    """One row: cycles, passed pairs and the plain mean of the pass rates."""
    return metrics.agg(F.count(F.lit(1)).alias("total_cycles"), F.coalesce(F.sum("passed"), F.lit(0)).alias("total_passed_pairs"),
                       F.coalesce(F.avg("pass_rate"), F.lit(0.0)).alias("avg_pass_rate"))


def report_totals(metrics: DataFrame) -> DataFrame:
    """One row: totals, mean rates and the best cycle, the first one on ties."""
    best = F.max_by("cycle_id", F.struct("pass_rate", -F.col("cycle_id")))
    return metrics.agg(
        F.count(F.lit(1)).alias("total_cycles"), F.sum("generated").alias("total_generated"),
        F.sum("passed").alias("total_passed"), F.sum("failed").alias("total_failed"),
        (F.avg("pass_rate") * 100).alias("avg_pass_rate_pct"), F.avg("avg_quality").alias("avg_quality"), best.alias("best_cycle"),
    )


def report_cycles(metrics: DataFrame) -> DataFrame:
    """Per cycle: pass rate in percent with its class, quality and the mean of each score."""
    pct = F.col("pass_rate") * 100
    grade = F.when(pct >= HIGH_FROM, "high").when(pct >= MEDIUM_FROM, "medium").otherwise("low")
    return metrics.select(
        "cycle_id", pct.alias("pass_rate_pct"), grade.alias("pass_rate_class"), "avg_quality",
        *[F.col(f"avg_{c}").alias(c) for c in ("coherence", "accuracy", "helpfulness", "overall")])


def json_report(metrics: DataFrame) -> DataFrame:
    """One JSON document per row: the summary, then each cycle in order."""
    summary = metrics.agg(
        F.count(F.lit(1)).alias("total_cycles"), F.coalesce(F.sum("passed"), F.lit(0)).alias("total_passed_pairs"),
        F.coalesce(F.avg("pass_rate"), F.lit(0.0)).alias("avg_pass_rate"), F.coalesce(F.avg("avg_quality"), F.lit(0.0)).alias("avg_quality_score"))
    shape = lambda df, section, place: df.select(
        F.lit(section).alias("section"), place.cast("int").alias("position"), F.to_json(F.struct(*df.columns)).alias("document"))
    return shape(summary, "summary", F.lit(0)).unionByName(shape(metrics, "cycle", F.col("cycle_id")))
