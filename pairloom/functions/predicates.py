"""Building blocks for predicates over a pair's context, with the rules of missing values.

A predicate is a boolean Column or SQL text. A row whose predicate is NULL does not match,
so an operation that cannot be carried out (division by zero, ordering against a missing
value, an absent key) should be NULL rather than an error: the functions here are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def predicate(context: DataFrame, where: Column | str) -> Column:
    """The predicate as a Column; anything but a boolean is rejected before the job runs.

    A filter drops NULL by itself. The bare predicate lets its conjuncts reach the scan.
    """
    c = F.expr(where) if isinstance(where, str) else where
    kind = context.select(c).schema[0].dataType
    if not isinstance(kind, T.BooleanType):
        raise ValueError(f"predicate is {kind.simpleString()}, not boolean")
    return c


def equal(a: Column, b: Column | object) -> Column:
    """Equality where a missing value equals only a missing value."""
    return a.eqNullSafe(b)


def not_equal(a: Column, b: Column | object) -> Column:
    """Inequality where a missing value differs from every present one."""
    return ~a.eqNullSafe(b)


def is_in(c: Column, values: list) -> Column:
    """Membership in a list; a missing value is a member only when the list has None."""
    present = [v for v in values if v is not None]
    hit = F.coalesce(c.isin(*present), F.lit(False)) if present else F.lit(False)
    return hit | c.isNull() if None in values else hit


def contains(haystack: Column, needle: str | Column) -> Column:
    """Substring test; NULL when the text is missing."""
    return F.contains(haystack, needle if isinstance(needle, Column) else F.lit(needle))


def has_key(m: Column, key: str) -> Column:
    return F.map_contains_key(m, F.lit(key))


def divide(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def floor_divide(a: Column, b: Column) -> Column:
    """Division rounded down, exact for integers; NULL for a zero divisor or beyond 64 bits."""
    whole = F.typeof(a + b).isin("tinyint", "smallint", "int", "bigint")
    exact = F.try_divide((a.cast("decimal(20,0)") - modulo(a, b).cast("decimal(20,0)")), b.cast("decimal(20,0)"))
    as_long = F.call_function("round", exact).cast("decimal(20,0)")
    return F.when(whole, _try_long(as_long)).otherwise(F.floor(divide(a, b)))


def _try_long(c: Column) -> Column:
    low, high = F.lit(-(2**63)).cast("decimal(20,0)"), F.lit(2**63 - 1).cast("decimal(20,0)")
    return F.when(c.between(low, high), c).cast("bigint")


def modulo(a: Column, b: Column) -> Column:
    """Remainder with the sign of the divisor, exact for integers; NULL for a zero divisor."""
    rest = F.try_mod(a, b)
    return F.when((rest != 0) & ((rest < 0) != (b < 0)), rest + b).otherwise(rest)


def power(a: Column, b: Column) -> Column:
    return F.pow(a, b)


def piece(c: Column, start: int = 0, stop: int | None = None) -> Column:
    """``text[start:stop]`` by code points, negative positions counted from the end."""
    n = F.length(c)
    at = lambda i: F.greatest(n + i, F.lit(0)) if i < 0 else F.least(F.lit(i), n)
    first, last = at(start), (n if stop is None else at(stop))
    return F.substr(c, first + 1, F.greatest(last - first, F.lit(0)))


def truth(c: Column, kind: T.DataType) -> Column:
    """Truth of a value of the given type: non-empty text or collection, non-zero number."""
    if isinstance(kind, T.BooleanType):
        t = c
    elif isinstance(kind, T.StringType):
        t = c != ""
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        t = F.size(c) > 0
    elif isinstance(kind, T.StructType):
        t = c.isNotNull()
    else:
        t = c != 0
    return F.coalesce(t, F.lit(False))
