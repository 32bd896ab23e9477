"""First wins, last wins, prefixes and exact-size cuts, none of them through one task.

``order`` is a column that is unique per row and gives the row order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.session import stage

# A key with more rows than this is split over several tasks in ``join_groups``.
# At most (all rows / HOT_ROWS) keys can be that hot; whether they are broadcast is Spark's choice by size.
HOT_ROWS = 1_000_000
# The longest prefix whose order values may meet in one task.
HEAD_ROWS = 100_000


def first_wins(rows: DataFrame, key: Column | str, order: str = "seq") -> DataFrame:
    """The first row of each key.

    Only (key, order) is aggregated, so a hot key shrinks to one row per map task. The
    wide rows then move once, by the unique order column, which cannot be skewed. The
    adaptive planner hashes the narrow side where every part of it is small enough
    (``session.SETTINGS``), which spares sorting the wide one; else the join sorts and spills.
    """
    key = F.col(key) if isinstance(key, str) else key
    firsts = rows.groupBy(key.alias("_key")).agg(F.min(order).alias(order)).select(order)
    return rows.join(firsts, order, "left_semi")


def last_wins(rows: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """The last row of each key, for narrow rows: one shuffle, combined before it.

    Each column is picked on its own, so columns that nobody reads are not even scanned.
    """
    last = {c: F.max_by(c, order) for c in rows.columns if c not in (key, order)} | {order: F.max(order)}
    return rows.groupBy(key).agg(*[a.alias(c) for c, a in last.items()]).select(*rows.columns)


def first_rows(rows: DataFrame, n: int, order: str = "seq") -> DataFrame:
    """The first n rows. Only the order column is ranked; whole rows are filtered in place.

    Up to ``HEAD_ROWS`` values meet in one task. For more, the order values are dealt into sorted
    ranges; the counts of the ranges tell which of them holds the n-th value, and only that value is picked.
    """
    if n <= 0:
        return rows.filter(F.lit(False))
    if n <= HEAD_ROWS:
        head = rows.select(order).orderBy(order).limit(n)
        return rows.filter(F.col(order) <= head.agg(F.max(order)).scalar())
    ranges = stage(rows.select(F.col(order).alias("at")).repartitionByRange("at").sortWithinPartitions("at").select(
        "at", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("nth")))
    counts = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("size"))   # one row per range
    upto = counts.select("part", "size", F.sum("size").over(Window.orderBy("part")).alias("upto"))
    found = upto.filter((F.col("upto") >= n) & (F.col("upto") - F.col("size") < n)).first()
    if found is None:
        return rows
    nth = n - (found["upto"] - found["size"]) - 1
    cut = ranges.filter((F.col("part") == found["part"]) & (F.col("nth") == nth)).agg(F.max("at"))
    return rows.filter(F.col(order) <= cut.scalar())


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, spread: str,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of rows with one group row per key, safe when a few keys hold most rows.

    ``size`` is a column of ``groups`` with the number of rows of the key. Hot keys get
    several salts: their group row is repeated once per salt and their rows are spread
    over the salts by a hash of the ``spread`` column. All other keys have the salt 0.
    """
    salts = F.ceil(F.col(size) / F.lit(hot_rows)).cast("int")
    hot = groups.filter(F.col(size) > hot_rows).select(key, salts.alias("_salts"))
    salted_rows = (
        rows.join(hot, key, "left")
        .withColumn("_salt", F.pmod(F.hash(spread), F.coalesce("_salts", F.lit(1))))
        .drop("_salts")
    )
    salted_groups = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(salts, F.lit(1)) - 1)))
    return salted_rows.join(salted_groups, [key, "_salt"]).drop("_salt")


def shuffle_key(seed: int | str, id_col: str = "id", order: str = "seq") -> Column:
    """Position of a row in the seeded shuffle, as hex text; spread evenly whatever the ids are.

    The first 16 digits depend on seed and id only, so the same pairs fall alike wherever they are stored; the
    rest spreads rows that share an id, by their place.
    """
    own = F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string"))
    return F.concat(F.substring(F.sha2(own, 256), 1, 16),
                    F.substring(F.sha2(F.concat_ws(":", own, F.col(order).cast("string")), 256), 1, 48))


def cut_values(keys: DataFrame, cuts: list[Callable[[Column], Column]]) -> DataFrame:
    """One row with the map ``cuts``: i -> the key at the i-th cut rank (1-based).

    ``keys`` has one column ``key`` of evenly spread hex text; each cut is a function from
    the row count (a Column) to a rank. The rows are counted per 4-digit prefix (at most
    65,536 small rows, summed in order); only the prefixes that hold a cut are counted again, by 20 digits, which
    tell the rows of one id apart, and only the rows that agree in these are ranked one by one. A cut of rank 0 has no entry.
    """
    prefix = F.substring("key", 1, 4)
    counts = keys.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    in_order = Window.orderBy("prefix")
    cumulated = counts.select(
        "prefix",
        F.sum("n").over(in_order).alias("upto"),
        (F.sum("n").over(in_order) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    ranks = F.array(*[
        F.struct(F.lit(i).alias("cut"), make(F.col("total")).cast("bigint").alias("rank"))
        for i, make in enumerate(cuts)
    ])
    wanted = cumulated.select(
        "prefix", "before",
        F.explode(F.filter(ranks, lambda r: (r["rank"] > F.col("before")) & (r["rank"] <= F.col("upto")))).alias("c"),
    ).select("prefix", "c.cut", (F.col("c.rank") - F.col("before")).alias("nth"))
    # At most one row per cut.
    near = keys.select("key", prefix.alias("prefix")).join(F.broadcast(wanted), "prefix")
    fine = F.substring("key", 1, 20)
    inside = Window.partitionBy("cut").orderBy("fine")
    groups = near.groupBy("cut", "nth", fine.alias("fine")).agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(inside))
    held = groups.filter((F.col("nth") <= F.col("upto")) & (F.col("nth") > F.col("upto") - F.col("n"))).select(
        "cut", "fine", (F.col("nth") - F.col("upto") + F.col("n")).alias("nth"))
    near = near.select("cut", "key", fine.alias("fine")).join(F.broadcast(held), ["cut", "fine"])   # at most one row per cut
    ranked = near.withColumn("rn", F.row_number().over(Window.partitionBy("cut").orderBy("key")))
    found = ranked.filter(F.col("rn") == F.col("nth")).select("cut", "key")
    entries = F.collect_list(F.struct("cut", "key"))
    return found.agg(F.map_from_entries(entries).alias("cuts"))
