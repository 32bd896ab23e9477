"""Appended raw files, responses and judgments, processed once as they arrive.

The row-level operators (normalise, row checks, verdicts, automatic labels) hold no state, so
the same functions run on a streaming DataFrame. First wins, last wins and copies depend on
the whole table and stay batch reads over what is written here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pairloom.functions import variants as V
from pairloom.functions.rows import with_values
from pairloom.functions.text import strip


def appended_lines(spark: SparkSession, folder: str, per_trigger: int | None = None) -> DataFrame:
    """JSON lines of the files appended to a folder: (arrived, row). Blank and malformed lines are left out.

    Pass ``order="arrived"`` to the operators. Rows of a stream have no running number; reading
    the table they were appended to (``sources.readers.read_table``) gives each row its ``seq``.
    """
    reader = spark.readStream
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    lines = reader.text(folder).select(
        F.col("_metadata.file_modification_time").alias("arrived"), strip("value").alias("line"))
    listed = with_values(lines.filter("line != ''"), {"_list": V.in_list("line")})   # each line is parsed once
    return with_values(listed, {"row": V.sole_value("_list")}).select("arrived", "row").filter("row IS NOT NULL")


def append_to(rows: DataFrame, operator: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Run a stateless operator over everything that has arrived and append to a Parquet table, each row once."""
    out = operator(rows).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return out.outputMode("append").trigger(availableNow=True).start()
