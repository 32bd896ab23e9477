"""Labels and pairs as they arrive, with state: the latest label of each pair, the first of equal pairs.

State lies in the stream's checkpoint and is bounded by a watermark; what leaves it is stored, one folder per
batch, so a batch that is written again after a restart replaces itself.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pairloom.functions.rows import with_values
from pairloom.functions.text import canonical_id, iso_timestamp_sql
from pairloom.operators.ordering import last_wins
from pairloom.streaming.append import appended_lines


def label_lines(spark: SparkSession, folder: str, per_trigger: int | None = None) -> DataFrame:
    """Labels of the files appended to a folder; lines without pair, status or time are left out, as malformed ones are."""
    names = ("pair_id", "status", "tag", "note", "labeler", "labeled_at")
    rows = with_values(appended_lines(spark, folder, per_trigger), {f"_{n}": f"try_variant_get(row, '$.{n}', 'string')" for n in names})
    read = with_values(rows, {"labeled_at": iso_timestamp_sql("_labeled_at")}).select(
        "arrived", canonical_id("_pair_id").alias("pair_id"), *[F.col(f"_{n}").alias(n) for n in ("status", "tag", "note")],
        F.coalesce("_labeler", F.lit("user")).alias("labeler"), "labeled_at")
    return read.filter("pair_id IS NOT NULL AND status IS NOT NULL AND labeled_at IS NOT NULL")


def follow_labels(lines: DataFrame, path: str, checkpoint: str, late: str = "7 days", width: str = "1 day") -> StreamingQuery:
    """Keep the latest label of every pair in a store below ``path``, for everything that has arrived.

    The state holds the latest label of a pair within each span of ``width`` that the watermark, ``late`` behind the newest label, has not
    passed; each batch stores what it changed. Lines later than that are dropped. Repeated lines change nothing.
    """
    latest = F.max(F.struct("labeled_at", "arrived", "status", "tag", "note", "labeler")).alias("last")
    state = lines.withWatermark("labeled_at", late).groupBy(F.window("labeled_at", width), "pair_id").agg(latest)

    def store(batch: DataFrame, number: int) -> None:
        batch.select("pair_id", "last.*").write.mode("overwrite").parquet(f"{path}/batch={number}")

    out = state.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(store)
    return out.trigger(availableNow=True).start()


def followed_labels(spark: SparkSession, path: str) -> DataFrame:
    """The latest label of each pair that ``follow_labels`` has stored: by time, then arrival."""
    rows = spark.read.parquet(path).drop("batch")
    return last_wins(rows.withColumn("seq", F.struct("labeled_at", "arrived", "status", "tag", "note", "labeler")), "pair_id")


def follow_pairs(pairs: DataFrame, path: str, checkpoint: str, late: str = "1 day", arrived: str = "arrived") -> StreamingQuery:
    """Append each pair that has not been seen to a table below ``path``, for everything that has arrived.

    Equal ids that arrive within ``late`` of each other meet in the stream's state; older ones are found among the ids of
    the batches stored before. Of equal pairs that arrive together any one may stay; they have the same id, which is made of their texts.
    """
    spark = pairs.sparkSession
    first = pairs.withWatermark(arrived, late).dropDuplicatesWithinWatermark(["id"])

    def store(batch: DataFrame, number: int) -> None:
        try:
            seen = spark.read.parquet(path).filter(F.col("batch") < number).select("id")
            batch = batch.join(seen, "id", "left_anti")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    out = first.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(store)
    return out.trigger(availableNow=True).start()
