"""Labels: pair context, bulk and automatic labelling, latest wins, resume, review queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.functions.predicates import predicate
from pairloom.functions.text import first_chars, one_decimal
from pairloom.functions.verdict import REJECT_BELOW
from pairloom.operators.judge import latest_judgments
from pairloom.operators.ordering import first_wins, last_wins
from pairloom.schemas import CRITERIA, STATUSES


def check_status(status: str) -> str:
    if status not in STATUSES:
        raise ValueError(f"not a label status: {status}")
    return status


def invalid_labels(labels: DataFrame) -> DataFrame:
    """Labels whose status is not one of the four."""
    return labels.filter(~F.coalesce(F.col("status").isin(STATUSES), F.lit(False)))


def latest_labels(log: DataFrame, order: str = "seq") -> DataFrame:
    """The last label of each pair; unreadable lines (no pair_id or status) are skipped."""
    readable = log.filter(F.col("pair_id").isNotNull() & F.col("status").isNotNull())
    return last_wins(readable, "pair_id", order)


# What a context and a review show of a judgment.
JUDGED = {"scores": "struct<coherence:double,accuracy:double,helpfulness:double,overall:double>", "passed": "boolean", "judge_model": "string"}
REVIEWED = {"scores": JUDGED["scores"], "passed": "boolean", "judgment_reasoning": "string"}


def _opinions(judgments: DataFrame | None, labels: DataFrame | None, fields: dict[str, str]) -> DataFrame | None:
    """Judgments and labels side by side: id, _judgment, _label. Both have one row per pair_id."""
    sides = []
    if judgments is not None:
        sides.append(judgments.selectExpr("pair_id AS id", f"struct({', '.join(fields)}) AS _judgment"))
    if labels is not None:
        sides.append(labels.selectExpr("pair_id AS id", "struct(status, tag, note) AS _label"))
    if len(sides) == 2:
        return sides[0].join(sides[1], "id", "full_outer")
    return sides[0] if sides else None


def _with_opinions(pairs: DataFrame, judgments: DataFrame | None, labels: DataFrame | None, fields: dict[str, str]) -> DataFrame:
    """Pairs with ``_judgment`` and ``_label``, NULL where there is none.

    The narrow sides meet first, so the pairs take part in a single join, which the adaptive
    planner can split when many rows share an id.
    """
    opinions = _opinions(judgments, labels, fields)
    out = pairs if opinions is None else pairs.join(opinions, "id", "left")
    judged = ",".join(f"{n}:{t}" for n, t in fields.items())
    absent = {"_judgment": f"struct<{judged}>", "_label": "struct<status:string,tag:string,note:string>"}
    return out.withColumns({c: F.lit(None).cast(t) for c, t in absent.items() if c not in out.columns})


def context(pairs: DataFrame, judgments: DataFrame | None = None, labels: DataFrame | None = None) -> DataFrame:
    """Pairs with their judgment and label, for predicates.

    ``judgments`` and ``labels`` have one row per pair_id. Missing judgments read as zero
    scores, not passed and no model; missing labels as NULL fields.
    """
    scores = ", ".join(f"coalesce(_judgment.scores.{n}, 0D) AS {n}" for n in CRITERIA)
    return _with_opinions(pairs, judgments, labels, JUDGED).selectExpr(
        *[f"`{c}`" for c in pairs.columns], f"struct({scores}) AS scores", "coalesce(_judgment.passed, false) AS passed",
        "_judgment.judge_model AS judge_model", "struct(_label.status AS status, _label.tag AS tag, _label.note AS note) AS label")


def bulk_label(pairs: DataFrame, where: Column | str, status: str, judgments: DataFrame | None = None,
               labels: DataFrame | None = None, tag: str | None = None, note: str | None = None,
               labeled_at: str | None = None, labeler: str = "bulk", order: str = "seq") -> DataFrame:
    """One label per id whose first row matches the predicate."""
    check_status(status)
    ctx = context(first_wins(pairs, "id", order), judgments, labels)
    hits = ctx.filter(predicate(ctx, where))
    return hits.select(
        order, F.col("id").alias("pair_id"), F.lit(status).alias("status"), F.lit(tag).cast("string").alias("tag"),
        F.lit(note).cast("string").alias("note"), F.lit(labeler).alias("labeler"),
        F.lit(labeled_at).cast("timestamp").alias("labeled_at"),
    )


def auto_label(judgments: DataFrame, reject_below: float = REJECT_BELOW, approve_if_passed: bool = True,
               labeled_at: str | None = None, order: str = "seq") -> DataFrame:
    """One label per judgment: approved when passed, rejected under the limit, else needs_edit."""
    overall = F.col("scores.overall")
    approved = F.col("passed") & F.lit(approve_if_passed)
    status = F.when(approved, "approved").when(overall < reject_below, "rejected").otherwise("needs_edit")
    return judgments.select(
        order, "pair_id", status.alias("status"), F.concat(F.lit("overall="), one_decimal("scores.overall")).alias("tag"),
        F.lit(None).cast("string").alias("note"), F.lit("auto-from-judge").alias("labeler"),
        F.lit(labeled_at).cast("timestamp").alias("labeled_at"),
    )


def label_sessions(log: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """One row per stretch of work of a labeler: labels without a break of more than ``gap`` between them.

    (labeler, started, ended, n, one count per status, minutes, per_hour, pause_minutes); ``per_hour`` is null for a session of no length,
    ``pause_minutes``, the time since the labeler's session before, for the first one. Lines without a time are left out.
    """
    counts = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    sessions = log.filter("labeled_at IS NOT NULL").groupBy("labeler", F.session_window("labeled_at", gap)).agg(
        F.min("labeled_at").alias("started"), F.max("labeled_at").alias("ended"), F.count(F.lit(1)).alias("n"), *counts)
    minutes = lambda a, b: (F.unix_micros(b) - F.unix_micros(a)) / 6e7
    before = F.lag("ended").over(Window.partitionBy("labeler").orderBy("started"))
    length = minutes(F.col("started"), F.col("ended"))
    return sessions.select(
        "labeler", "started", "ended", "n", *STATUSES, length.alias("minutes"), F.try_divide(60 * F.col("n"), length).alias("per_hour"),
        minutes(before, F.col("started")).alias("pause_minutes"))


def resume_labels(new: DataFrame, current: DataFrame) -> DataFrame:
    """New labels without those whose status and tag are the pair's latest already."""
    cur = current.select("pair_id", F.struct("status", "tag").alias("_cur"))
    same = F.col("_cur.status").eqNullSafe(F.col("status")) & F.col("_cur.tag").eqNullSafe(F.col("tag"))
    return new.join(cur, "pair_id", "left").filter(F.col("_cur").isNull() | ~same).select(*new.columns)


def review_queue(pairs: DataFrame, judgments: DataFrame | None = None, labels: DataFrame | None = None,
                 resume: bool = True, order: str = "seq", output_chars: int | None = None,
                 reasoning_chars: int | None = None) -> DataFrame:
    """What a reviewer sees, in ``order``: the pairs without a label; the widths cut texts for display."""
    cut = lambda c, n: F.col(c) if n is None else first_chars(c, n)
    shown = pairs.select(order, "id", "instruction", cut("output", output_chars).alias("output"))
    waiting = _with_opinions(shown, judgments, labels if resume else None, REVIEWED).filter("_label IS NULL")
    return waiting.select(
        order, "id", "instruction", "output", one_decimal("_judgment.scores.overall").alias("overall"),
        F.col("_judgment.passed").alias("passed"), cut("_judgment.judgment_reasoning", reasoning_chars).alias("reasoning"))
