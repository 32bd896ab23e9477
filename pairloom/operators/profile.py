"""The numbers behind the charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions.stats import count_where
from pairloom.functions.text import text
from pairloom.operators.compare import align_runs
from pairloom.operators.evaluate import category_name
from pairloom.schemas import CRITERIA, STATUSES


def pass_fail_counts(judgments: DataFrame) -> DataFrame:
    """Two rows, passed and failed, over all runs."""
    n = judgments.agg(count_where(F.col("passed")).alias("p"), count_where(~F.col("passed")).alias("f"))
    return n.select(F.explode(F.array(_bar(F.lit("passed"), F.col("p")), _bar(F.lit("failed"), F.col("f")))).alias("b")).select("b.*")


def _bar(name: Column, n: Column) -> Column:
    return F.struct(name.alias("outcome"), n.alias("n"))


def score_histogram(judgments: DataFrame) -> DataFrame:
    """(bin, n) for the ten unit bins of the overall score, the last one closed; empty bins too."""
    overall = F.col("scores.overall")
    inside = judgments.filter(overall.between(0, 10))
    counts = inside.agg(*[
        F.count_if(F.least(F.floor(overall), F.lit(9)) == i).alias(str(i)) for i in range(10)])
    bins = F.array(*[F.struct(F.lit(i).cast("bigint").alias("bin"), F.col(f"`{i}`").alias("n")) for i in range(10)])
    return counts.select(F.explode(bins).alias("b")).select("b.*")


def criterion_means(judgments: DataFrame) -> DataFrame:
    """(criterion, mean) over all judgments; no rows without judgments."""
    means = judgments.agg(*[F.avg(f"scores.{c}").alias(c) for c in CRITERIA])
    return means.unpivot([], CRITERIA, "criterion", "mean").filter("mean IS NOT NULL")


def top_categories(pairs: DataFrame, n: int = 20, order: str = "seq") -> DataFrame:
    """The n most frequent categories; equal counts by first appearance."""
    counts = pairs.groupBy(category_name("(uncategorized)").alias("category")).agg(
        F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    return counts.orderBy(F.desc("n"), "first").limit(n).select("category", "n")


def length_histograms(pairs: DataFrame, bins: int = 20) -> DataFrame:
    """(field, bin, n, lo, hi): equal bins between the shortest and longest text of each field, empty ones too.

    One pass counts the rows per length; the bins are made from those few rows. A value on
    an edge belongs to the upper bin, except at the very end; equal lengths give one unit around them.
    """
    lengths = F.array(*[F.struct(F.lit(f).alias("field"), F.length(text(f)).alias("length")) for f in ("instruction", "output")])
    counts = pairs.select(F.explode(lengths).alias("l")).groupBy("l.field", "l.length").agg(F.count(F.lit(1)).alias("m"))
    ends = counts.groupBy("field").agg(F.min("length").alias("a"), F.max("length").alias("z"))
    flat = F.col("a") == F.col("z")
    ends = ends.select("field", (F.col("a") - F.when(flat, 0.5).otherwise(0.0)).alias("lo"),
                       (F.col("z") + F.when(flat, 0.5).otherwise(0.0)).alias("hi"))
    x = F.col("length").cast("double")
    lo, hi, step = F.col("lo"), F.col("hi"), (F.col("hi") - F.col("lo")) / bins
    edge = lambda i: F.when(i == bins, hi).otherwise(lo + i * step)
    every = ends.select("field", "lo", "hi", F.explode(F.expr(f"sequence(0L, {bins - 1}L)")).alias("bin"))
    placed = counts.join(F.broadcast(ends), "field").withColumn(   # two rows
        "guess", F.least(F.floor((x - lo) / (hi - lo) * bins), F.lit(bins - 1)))
    guess = F.col("guess")
    bin_of = guess - F.when(x < edge(guess), 1).otherwise(0) \
        + F.when((x >= edge(guess + 1)) & (guess != bins - 1), 1).otherwise(0)
    filled = placed.groupBy("field", bin_of.cast("bigint").alias("bin")).agg(F.sum("m").alias("n"))
    return every.join(filled, ["field", "bin"], "left").select("field", "bin", F.coalesce("n", F.lit(0)).alias("n"), "lo", "hi")


def label_distribution(latest: DataFrame) -> DataFrame:
    """(status, n, position) of the latest labels: the four statuses in report order, then others."""
    place = F.array_position(F.array(*[F.lit(s) for s in STATUSES]), F.col("status")).cast("bigint")
    counts = latest.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("status", "n", F.when(place > 0, place).otherwise(len(STATUSES) + 1).alias("position"))


def ranked_issues(counts: DataFrame) -> DataFrame:
    """Issue counts per check, most frequent first, without the severity rows."""
    return counts.filter(~F.col("key").startswith("severity:") & (F.col("key") != "total_pairs")) \
        .select(F.col("key").alias("check"), "n").orderBy(F.desc("n"), "check")


def agreement_matrix(judgments: DataFrame, tags: tuple[str, str] | None = None, order: str = "seq") -> DataFrame:
    """Four rows (a_pass, b_pass, n) for two runs, by default the first two tags in order.
    No rows with fewer than two tags or without common pairs."""
    if tags:
        a, b = tags
    else:
        found = [r.tag for r in judgments.select("tag").filter("tag IS NOT NULL").distinct().orderBy("tag").limit(2).collect()]
        a, b = [*found, None, None][:2]   # two names, read once
    both = align_runs(judgments, a, b, order)
    cells = [(True, True), (True, False), (False, True), (False, False)]
    counts = both.agg(*[
        count_where((F.col("a_pass") == x) & (F.col("b_pass") == y)).alias(f"c{i}") for i, (x, y) in enumerate(cells)])
    rows = F.array(*[F.struct(F.lit(x).alias("a_pass"), F.lit(y).alias("b_pass"), F.col(f"c{i}").alias("n"))
                     for i, (x, y) in enumerate(cells)])
    return counts.filter("c0 + c1 + c2 + c3 > 0").select(F.explode(rows).alias("r")).select("r.*")


def overview(pairs: DataFrame, judgments: DataFrame, latest: DataFrame) -> DataFrame:
    """One row: pairs, judgment sets, judgments, labels."""
    part = lambda df, k, c: df.agg(c.alias("n")).select(F.lit(k).alias("k"), F.col("n").cast("bigint").alias("n"))
    n = F.count(F.lit(1))
    parts = part(pairs, "pairs", n).unionByName(part(judgments, "judgment_sets", F.count_distinct("tag"))) \
        .unionByName(part(judgments, "judgments", n)).unionByName(part(latest, "labels", n))
    names = ("pairs", "judgment_sets", "judgments", "labels")
    return parts.agg(*[F.max(F.when(F.col("k") == k, F.col("n"))).alias(k) for k in names])


# ----- approximate statistics that can be stored and merged -----

def sketches(rows: DataFrame, by: list[str], value: str, item: str, k: int = 400) -> DataFrame:
    """(by, n, quantiles, items): for each group the number of values, a KLL sketch of them and a HyperLogLog sketch of ``item``.

    A few KB a group, whatever its size; null values are not counted. The rank error of a quantile is about 2.3 / k**0.9 (under 1.1 % for
    400, with 99 % confidence), that of a count of distinct items about 1.6 %.
    """
    return rows.filter(F.col(value).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("quantiles"),
        F.hll_sketch_agg(item).alias("items"))


def merge_sketches(stored: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of coarser groups from stored ones, without a look at the rows."""
    return stored.groupBy(*by).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("items").alias("items"))


def read_sketches(merged: DataFrame, shares: list[float]) -> DataFrame:
    """(the group's columns, n, distinct, share, value): the estimated quantiles, one row each."""
    keep = [c for c in merged.columns if c not in ("n", "quantiles", "items")]
    listed = F.array(*[F.struct(F.lit(s).alias("share"), F.kll_sketch_get_quantile_double("quantiles", F.lit(s)).alias("value")) for s in shares])
    return merged.select(*keep, "n", F.hll_sketch_estimate("items").alias("distinct"), F.explode(listed).alias("q")).select(
        *keep, "n", "distinct", "q.share", "q.value")
