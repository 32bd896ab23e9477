"""VARIANT values as SQL text: strict parsing, presence-aware lookup, Python-like truth and text."""

from __future__ import annotations

from pairloom.functions.rows import quoted
from pairloom.functions.text import strip_sql

_END = "\x1e"

# --- fixed values: texts that Python's float() accepts ------------------------
_DIGITS = r"\d+(?:_\d+)*"
FLOAT_TEXT = rf"^[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
SPECIAL_FLOAT_TEXT = r"^(?i)[+-]?(?:inf|infinity|nan)$"
# -------------------------------------------------------------------------------


def in_list(c: str) -> str:
    """Text as the first of two elements of a parsed list; see ``strict_json``."""
    return f"try_parse_json(concat('[', {c}, {quoted(f',"\\u{ord(_END):04x}"]')}))"


def sole_value(v: str) -> str:
    """The first of the two elements of ``in_list``, NULL if there is anything else."""
    only = f"try_variant_get({v}, '$[1]', 'string') = {quoted(_END)} AND try_variant_get({v}, '$[2]', 'variant') IS NULL"
    return f"CASE WHEN {only} THEN try_variant_get({v}, '$[0]', 'variant') END"


def strict_json(c: str, lenient: bool = True) -> str:
    """Parse text that must be exactly one JSON value.

    ``parse_json`` stops after the first value and ignores what follows, so the text is
    parsed as the first of two array elements and the second is checked: anything left
    over after the value breaks the array. Unreadable text is NULL, or an error when not lenient.
    """
    value = sole_value(in_list(c))
    if lenient:
        return value
    problem = f"CAST(raise_error(concat('malformed JSON: ', substr({c}, 1, 200))) AS VARIANT)"
    return f"coalesce({value}, CASE WHEN {c} IS NOT NULL THEN {problem} END)"


def member(v: str, name: str) -> str:
    """Field of an object as VARIANT: NULL when absent, a JSON null when present and null."""
    escaped = name.replace("\\", "\\\\").replace("'", "\\'")
    path = f"$['{escaped}']"
    return f"try_variant_get({v}, {quoted(path)}, 'variant')"


def first_present(v: str, names: list[str]) -> str:
    """The first field that is present, even when its value is a JSON null."""
    return f"coalesce({', '.join(member(v, n) for n in names)})"


def kind(v: str) -> str:
    """'STRING', 'BOOLEAN', 'VOID' (JSON null), 'ARRAY', 'OBJECT' or 'NUMBER'; NULL when absent."""
    t = f"schema_of_variant({v})"
    return (f"CASE WHEN {t} LIKE 'ARRAY%' THEN 'ARRAY' WHEN {t} LIKE 'OBJECT%' THEN 'OBJECT' "
            f"WHEN {t} IN ('STRING', 'BOOLEAN', 'VOID') THEN {t} WHEN {t} IS NOT NULL THEN 'NUMBER' END")


def as_text(v: str, k: str | None = None) -> str:
    """``str()`` of a value that is not null; lists and objects are rendered as JSON."""
    k = k or kind(v)
    t = f"try_variant_get({v}, '$', 'string')"
    return f"CASE {k} WHEN 'VOID' THEN NULL WHEN 'BOOLEAN' THEN initcap({t}) ELSE {t} END"


def truthy(v: str, k: str | None = None) -> str:
    """Python truth: absent, null, false, zero, empty text, [] and {} are false."""
    k = k or kind(v)
    t = f"try_variant_get({v}, '$', 'string')"
    return (f"CASE {k} WHEN 'BOOLEAN' THEN {t} = 'true' WHEN 'NUMBER' THEN try_variant_get({v}, '$', 'double') <> 0 "
            f"WHEN 'ARRAY' THEN {t} <> '[]' WHEN 'OBJECT' THEN {t} <> '{{}}' WHEN 'STRING' THEN {t} <> '' ELSE false END")


def float_of(v: str, k: str | None = None) -> str:
    """``float()``: numbers, booleans and numeric text; NULL for everything else."""
    k = k or kind(v)
    t = strip_sql(f"try_variant_get({v}, '$', 'string')")
    special = (f"CASE WHEN lower({t}) LIKE '%nan' THEN double('NaN') WHEN {t} LIKE '-%' THEN double('-Infinity') "
               "ELSE double('Infinity') END")
    from_text = (f"CASE WHEN {t} RLIKE {quoted(FLOAT_TEXT)} THEN try_cast(replace({t}, '_', '') AS DOUBLE) "
                 f"WHEN {t} RLIKE {quoted(SPECIAL_FLOAT_TEXT)} THEN {special} END")
    return (f"CASE {k} WHEN 'STRING' THEN {from_text} WHEN 'NUMBER' THEN try_variant_get({v}, '$', 'double') "
            f"WHEN 'BOOLEAN' THEN try_variant_get({v}, '$', 'double') END")
