"""Filtered, exactly sized, seeded exports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions.predicates import predicate
from pairloom.functions.rows import quoted
from pairloom.operators.labels import context
from pairloom.operators.ordering import cut_values, shuffle_key


def parse_split(spec: str | None) -> dict[str, float]:
    """``'train=0.9,val=0.1'`` to a dict; the ratios must sum to 1."""
    if not spec:
        return {}
    out = {k.strip(): float(v) for k, v in (part.split("=") for part in spec.split(","))}
    return check_ratios(out)


def check_ratios(ratios: dict[str, float]) -> dict[str, float]:
    if ratios and abs(sum(ratios.values()) - 1.0) > 0.01:
        raise ValueError("the shares of a split must add up to 1")
    return ratios


def filter_pairs(pairs: DataFrame, where: Column | str | None, judgments: DataFrame | None = None,
                 labels: DataFrame | None = None) -> DataFrame:
    """Pairs whose context matches the predicate, with the pair columns only."""
    if where is None:
        return pairs
    ctx = context(pairs, judgments, labels)
    return ctx.filter(predicate(ctx, where)).select(*pairs.columns)


def _assign(pairs: DataFrame, names: list[str], sizes: list[Callable[[Column], Column]], seed: int, order: str,
            stage: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """Split names by rank in the seeded shuffle; the last name takes what is left.

    Only the keys are counted and ranked. Each row then compares its own key with the cut
    keys, so the wide rows are never shuffled or sorted.
    """
    if len(names) == 1:
        return pairs.withColumn("split", F.lit(names[0]))
    key = shuffle_key(seed, order=order)
    keys = pairs.select(key.alias("key"))
    upto = [lambda n, i=i: _sum([s(n) for s in sizes[: i + 1]]) for i in range(len(sizes))]
    cuts = cut_values(stage(keys) if stage else keys, upto).scalar()
    branches = " ".join(f"WHEN _key <= _cuts[{i}] THEN {quoted(names[i])}" for i in range(len(sizes)))
    # The key and the cuts are columns of their own, so that each is computed once.
    marked = pairs.select("*", key.alias("_key"), cuts.alias("_cuts"))
    return marked.select(*pairs.columns, F.expr(f"CASE {branches} ELSE {quoted(names[-1])} END AS split"))


def _sum(columns: list[Column]) -> Column:
    total = columns[0]
    for c in columns[1:]:
        total = total + c
    return total


def _share(ratio: float) -> Callable[[Column], Column]:
    return lambda n: (n * F.lit(float(ratio))).cast("bigint")


def ratio_split(pairs: DataFrame, ratios: dict[str, float], seed: int = 42, order: str = "seq",
                stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Add ``split``: each part has int(n * ratio) rows, the last one the rest; no ratios, one unnamed part."""
    check_ratios(ratios)
    if not ratios:
        return pairs.withColumn("split", F.lit(""))
    names = list(ratios)
    return _assign(pairs, names, [_share(ratios[n]) for n in names[:-1]], seed, order, stage)


def train_test_split(pairs: DataFrame, test_size: float = 0.2, val_size: float = 0.1, seed: int = 42,
                     order: str = "seq", stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Add ``split``: int(n * test) rows to test, the next int(n * val) to val, the rest to train."""
    return _assign(pairs, ["test", "val", "train"], [_share(test_size), _share(val_size)], seed, order, stage)


def split_sizes(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def export(pairs: DataFrame, where: Column | str | None = None, judgments: DataFrame | None = None,
           labels: DataFrame | None = None, split: dict[str, float] | str | None = None, seed: int = 42,
           order: str = "seq", stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Filter, then split; the sinks of ``sources`` write the result."""
    ratios = parse_split(split) if isinstance(split, str) else (split or {})
    return ratio_split(filter_pairs(pairs, where, judgments, labels), ratios, seed, order, stage)


MARKS = 32768   # rows in a bitmap of 4 KB


def _rows_of(stored: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of Parquet files with one of the ids. Only ids are shuffled; the rows are told by a bit for each row of a file."""
    file, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    placed = stored.withColumns({"_file": file, "_part": F.floor(row / MARKS), "_bit": (row % MARKS).cast("int")})
    found = placed.select("id", "_file", "_part", "_bit").join(ids, "id", "left_semi")
    marks = found.groupBy("_file", "_part").agg(F.bitmap_construct_agg("_bit").alias("_marks"))
    byte = F.conv(F.hex(F.substring("_marks", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = placed.join(F.broadcast(marks), ["_file", "_part"]).filter(F.getbit(byte, F.col("_bit") % 8) == 1)
    return marked.select(*stored.columns)


def training_set(pairs: DataFrame, judgments: DataFrame, cycle_id: int | None = None, order: str = "seq",
                 stored: bool = False) -> DataFrame:
    """The passing pairs, marked as the train split of their cycle. ``stored``: the pairs are as read from Parquet files."""
    last = judgments.groupBy("pair_id").agg(F.max_by("passed", order).alias("passed"))
    ids = last.filter("passed").select(F.col("pair_id").alias("id"))
    passing = _rows_of(pairs, ids) if stored else pairs.join(ids, "id", "left_semi")
    marked = passing.withColumn("split", F.lit("train"))
    return marked if cycle_id is None else marked.withColumn("cycle_id", F.lit(cycle_id))
