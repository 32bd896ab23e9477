"""Registered queries by name, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Query], Query]:

    def register(fn: Query) -> Query:
        name = fn.__name__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        COVERS[name] = covers
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def r6(c: Column | str, name: str | None = None) -> Column:
    """A double rounded to six places, so that the order of summation does not matter."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), 6).alias(name or c)


def scores6() -> list[Column]:
    return [r6(F.col(f"scores.{n}"), n) for n in ("coherence", "accuracy", "helpfulness", "overall")]
