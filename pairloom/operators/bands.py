"""Rows joined with the ranges that hold their value, without a nested loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LOW, HIGH = "_low", "_high"


def band_join(rows: DataFrame, value: str, bands: DataFrame, low: str = "low", high: str = "high") -> DataFrame:
    """Inner join of rows and bands with low <= value < high; a null bound is open. Columns of both, the bands' bounds included.

    The bands of a length between two powers of two form a level and are cut at multiples of the larger power, so a band
    is in at most two pieces, however long; a row asks for one piece of each level that occurs (their number is a
    matter of the lengths' spread, not of the data's size). Rows and pieces meet by equality, which
    hashes, sorts, broadcasts or splits hot pieces as any join does. Null values match nothing; empty bands neither.
    """
    least = rows.agg(F.min(value).cast("double").alias("least")).scalar()
    beyond = rows.agg((F.max(value) + F.abs(F.max(value)) + 1).cast("double").alias("beyond")).scalar()
    # An open end reaches as far as the values do.
    closed = bands.withColumns({LOW: F.coalesce(F.col(low).cast("double"), least), HIGH: F.coalesce(F.col(high).cast("double"), beyond)})
    closed = closed.filter(F.col(LOW) < F.col(HIGH)).withColumn("_level", F.ceil(F.log2(F.col(HIGH) - F.col(LOW))).cast("int"))
    levels = [r["_level"] for r in closed.select("_level").distinct().collect()]   # at most the exponents of a double
    if not levels:
        closed, levels = closed.withColumn("_level", F.lit(0)), [0]
    size = F.pow(F.lit(2.0), F.col("_level"))
    pieces = closed.withColumn("_piece", F.explode(F.array_distinct(F.array(
        F.floor(F.col(LOW) / size), F.floor(F.col(HIGH) / size)))))
    asked = rows.filter(F.col(value).isNotNull()).withColumn("_level", F.explode(F.array(*[F.lit(n) for n in sorted(levels)])))
    asked = asked.withColumn("_piece", F.floor(F.col(value).cast("double") / size))
    inside = (F.col(value) >= F.coalesce(F.col(low), F.col(value))) & (F.col(high).isNull() | (F.col(value) < F.col(high)))
    joined = asked.join(pieces, ["_level", "_piece"]).filter(inside)
    return joined.select(*rows.columns, *bands.columns)


def band_totals(rows: DataFrame, value: str, bands: DataFrame, totals: list[Column], low: str = "low", high: str = "high") -> DataFrame:
    """Rows with totals over the bands that hold their value, without the pairs of rows and bands; rows in no band are left out.

    Rows of one value are in the same bands: each distinct value is joined once, and the rows get its totals. So the work grows with the bands
    and the rows, times the distinct values only.
    """
    values = rows.filter(F.col(value).isNotNull()).select(value).distinct()
    found = band_join(values, value, bands, low, high).groupBy(value).agg(*totals)
    return rows.join(found, value)
