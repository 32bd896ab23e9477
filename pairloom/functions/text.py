"""Text columns: strip, normalise, hash, ids, timestamps, exact one-decimal text.

Arguments are column names or SQL text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pairloom.functions.rows import quoted

# --- fixed values: results depend on these exact texts ----------------------
# Every character that Python's str.strip() and re's \s treat as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Runs of the same characters, but for the single space.
UNEVEN_SPACE = r"(?U)[\s\x1c-\x1f&&[^ ]][\s\x1c-\x1f]*| [\s\x1c-\x1f]+"
# The URL namespace of RFC 4122, and the prefix of a pair's name in it.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
PAIR_NAME_PREFIX = "sdf::"
# Separates fields inside hashed text.
UNIT = "\x1f"
# -----------------------------------------------------------------------------


def strip(c: str) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.expr(strip_sql(c))


def strip_sql(c: str) -> str:
    return f"btrim({c}, {quoted(WHITESPACE)})"


def text(c: str) -> Column:
    """Column with NULL read as the empty string."""
    return F.expr(f"coalesce({c}, '')")


def normalized(c: str) -> Column:
    """Lower-cased text with every whitespace run as one space and none at the ends."""
    return F.expr(normalized_sql(c))


def normalized_sql(c: str) -> str:
    """Only runs that are not a single space already are replaced: most spaces cost no match."""
    return f"btrim(regexp_replace(lower(coalesce({c}, '')), {quoted(UNEVEN_SPACE)}, ' '))"


def pair_hash(instruction: str, output: str) -> Column:
    """sha1 (hex) of the normalised pair; equal for copies differing in case or spacing."""
    return F.expr(f"sha1(concat({normalized_sql(instruction)}, {quoted(UNIT)}, {normalized_sql(output)}))")


def pair_id(instruction: str, output: str) -> Column:
    """Name-based (version 5) UUID of a pair."""
    return uuid5(f"concat({quoted(PAIR_NAME_PREFIX)}, coalesce({instruction}, ''), '::', coalesce({output}, ''))")


def uuid5(name: str) -> Column:
    """The version 5 UUID of a name in the URL namespace; ``name`` is SQL text."""
    h = f"sha1(concat(unhex('{URL_NAMESPACE}'), encode({name}, 'UTF-8')))"
    variant = f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')"
    return F.expr(
        f"concat(substr({h}, 1, 8), '-', substr({h}, 9, 4), '-5', substr({h}, 14, 3), '-', "
        f"{variant}, substr({h}, 18, 3), '-', substr({h}, 21, 12))")


def canonical_id(c: str) -> Column:
    """UUID text in any accepted spelling becomes lower-case 8-4-4-4-12; other ids stay as they are."""
    digits = f"lower(replace(btrim(regexp_replace({c}, 'urn:|uuid:', ''), '{{}}'), '-', ''))"
    dashed = f"regexp_replace({digits}, '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '$1-$2-$3-$4-$5')"
    return F.expr(f"CASE WHEN {digits} RLIKE '^[0-9a-f]{{32}}$' THEN {dashed} ELSE {c} END")


def iso_timestamp(c: str) -> Column:
    """ISO-8601 text to TIMESTAMP; text without an offset is UTC; unreadable text is NULL."""
    return F.expr(iso_timestamp_sql(c))


def iso_timestamp_sql(c: str) -> str:
    date_only, zone = quoted(r"^\d{4}-\d{2}-\d{2}$"), quoted(r":.*(Z|[+-]\d{2}:?\d{2})$")
    return (f"try_to_timestamp(CASE WHEN {c} RLIKE {date_only} THEN concat({c}, 'T00:00:00Z') "
            f"WHEN {c} RLIKE {zone} THEN {c} ELSE concat({c}, 'Z') END)")


def one_decimal(x: str) -> Column:
    """``'%.1f'`` of a non-negative double, rounding the exact binary value, ties to even.

    Twenty times x is 16x + 4x: both products are exact, and the rounding error of their
    sum is recovered exactly, so comparing with the odd number at the midpoint is exact too.
    """
    a, b = f"({x} * 16D)", f"({x} * 4D)"
    s = f"({a} + {b})"
    err = f"(({a} - ({s} - ({s} - {a}))) + ({b} - ({s} - {a})))"
    low = f"floor({s} / 2D)"
    side = f"(({s} - CAST({low} * 2 + 1 AS DOUBLE)) + {err})"
    tenths = f"({low} + CASE WHEN {side} > 0 OR ({side} = 0 AND {low} % 2 = 1) THEN 1 ELSE 0 END)"
    return F.expr(f"concat(CAST(floor({tenths} / 10) AS STRING), '.', CAST({tenths} % 10 AS STRING))")


def first_chars(c: str, n: int) -> Column:
    """The first n code points."""
    return F.substring(F.col(c), 1, n)
