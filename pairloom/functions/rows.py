"""Columns from SQL text, and columns that are computed once per row."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame


def quoted(s: str | None) -> str:
    """A SQL string literal."""
    if s is None:
        return "CAST(NULL AS STRING)"
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_values(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add columns given as SQL text; later expressions refer to their values.

    The optimizer merges stacked projections and pushes filters through them by copying the
    expressions; a long derivation, each step using the one before several times, then grows
    exponentially. A one-element generator is a boundary for both and stays within code generation.
    """
    values = ", ".join(f"{sql} AS `{name}`" for name, sql in columns.items())
    return df.selectExpr("*", f"explode(array(struct({values}))) AS _values") \
        .selectExpr(*[f"`{c}`" for c in df.columns], "_values.*")


def small_batches(limit: int = 1 << 20) -> Callable[[Iterable], Iterator]:
    """A function that cuts Arrow batches into stretches of rows of about ``limit`` bytes, one row at least; workers get it by value."""
    def cut(batches: Iterable) -> Iterator:
        for batch in batches:
            step = max(1, batch.num_rows * limit // max(batch.nbytes, 1))
            for at in range(0, batch.num_rows, step):
                yield batch.slice(at, step)

    return cut
