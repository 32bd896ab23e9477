"""Record schemas. ``seq`` is any orderable, unique column that fixes the row order."""

from __future__ import annotations

from pyspark.sql import types as T

PAIR = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("instruction", T.StringType()),
    T.StructField("input", T.StringType()),
    T.StructField("output", T.StringType()),
    T.StructField("context", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("difficulty", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    T.StructField("source_seed", T.StringType()),
    T.StructField("cycle_id", T.IntegerType()),
    T.StructField("created_at", T.TimestampType()),
])

SCORES = T.StructType([
    T.StructField("coherence", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("helpfulness", T.DoubleType()),
    T.StructField("overall", T.DoubleType()),
])

RUBRIC_REF = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("version", T.IntegerType()),
])

JUDGMENT = T.StructType([
    T.StructField("pair_id", T.StringType()),
    T.StructField("scores", SCORES),
    T.StructField("passed", T.BooleanType()),
    T.StructField("judge_model", T.StringType()),
    T.StructField("judgment_reasoning", T.StringType()),
    T.StructField("judged_at", T.TimestampType()),
    T.StructField("rubric", RUBRIC_REF),
    T.StructField("tag", T.StringType()),
])

LABEL = T.StructType([
    T.StructField("pair_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("tag", T.StringType()),
    T.StructField("note", T.StringType()),
    T.StructField("labeler", T.StringType()),
    T.StructField("labeled_at", T.TimestampType()),
])

# Score criteria in report order.
CRITERIA = ["coherence", "accuracy", "helpfulness", "overall"]
# Label statuses in report order.
STATUSES = ["approved", "needs_edit", "rejected", "skipped"]
