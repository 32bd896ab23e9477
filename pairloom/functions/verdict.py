"""Judge responses to scores and verdicts, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions import variants as V
from pairloom.functions.rows import quoted, with_values
from pairloom.functions.text import strip_sql
from pairloom.schemas import CRITERIA

# --- fixed values: thresholds, defaults and texts of a verdict --------------------------
THRESHOLDS = {"overall": 7.0, "coherence": 6.0, "accuracy": 6.0, "helpfulness": 6.0}
DEFAULT_SCORE = 5.0
NO_REASONING = "No reasoning provided"
PARSE_ERROR = "Parse error"
FAILED = "Judgment failed"
FENCE, JSON_FENCE = "```", "```json"
FIRST_OBJECT = r"\{[^}]+\}"
MIN_SCORE, MAX_SCORE = 0.0, 10.0
REJECT_BELOW = 3.5
NOT_A_NUMBER = "float() argument must be a string or a real number, not '{type}'"
NO_GET = "'{type}' object has no attribute 'get'"
TYPE_NAMES = {"VOID": "NoneType", "ARRAY": "list", "OBJECT": "dict", "STRING": "str", "BOOLEAN": "bool",
              "INT": "int", "FLOAT": "float"}
# ------------------------------------------------------------------------------------------


def thresholds(overrides: dict[str, float] | None = None, zero_means_default: bool = False) -> dict[str, float]:
    """The four limits; a limit that is not given (or, if asked, is zero) has its default."""
    given = {k: v for k, v in (overrides or {}).items() if v is not None and (v or not zero_means_default)}
    return THRESHOLDS | given


def meets(limits: dict[str, float], prefix: str = "") -> str:
    """Whether every score reaches its limit, as SQL text over columns named by criterion."""
    return " AND ".join(f"{prefix}{name} >= {float(limits[name])}D" for name in CRITERIA)


def embedded_json(response: str) -> str:
    """The JSON part of a response, as SQL text: inside the first code fence if there is one,
    then from the first ``{`` to the next ``}``; the text itself when there is no such span."""
    fenced = (f"CASE WHEN contains({response}, '{JSON_FENCE}') THEN split_part({response}, '{JSON_FENCE}', 2) "
              f"WHEN contains({response}, '{FENCE}') THEN split_part({response}, '{FENCE}', 2) END")
    inside = f"coalesce(split_part({fenced}, '{FENCE}', 1), {response})"
    span = f"regexp_extract({inside}, {quoted(FIRST_OBJECT)}, 0)"
    return strip_sql(f"CASE WHEN {span} <> '' THEN {span} ELSE {inside} END")


def tier(overall: str = "scores.overall") -> Column:
    """'high' from 8, 'medium' from 6, else 'low'."""
    return F.expr(f"CASE WHEN {overall} >= 8 THEN 'high' WHEN {overall} >= 6 THEN 'medium' ELSE 'low' END")


def parse_responses(rows: DataFrame, response: str = "response",
                    limits: dict[str, float] | None = None) -> DataFrame:
    """Add ``scores``, ``passed`` and ``judgment_reasoning`` to rows with a response text.

    Text that is not JSON, or a score that is text but not a number, gives the default
    scores and "Parse error". A missing response, a value that is not an object, a null or
    structured score, a score outside 0..10 and a reasoning that is not text give a
    failure row: zero scores, not passed, reasoning starting with "Judgment failed:".
    """
    limits = limits or THRESHOLDS
    three = CRITERIA[:3]
    fields = [*CRITERIA, "passed", "reasoning"]
    steps = with_values(rows, {"_json": embedded_json(response)})
    steps = with_values(steps, {"_v": V.strict_json("_json")})
    steps = with_values(steps, {"_kind": V.kind("_v")} | {f"_{n}": V.member("_v", n) for n in fields})
    steps = with_values(steps, {f"_k_{n}": V.kind(f"_{n}") for n in fields})
    steps = with_values(steps, {f"_f_{n}": V.float_of(f"_{n}", f"_k_{n}") for n in CRITERIA})
    steps = with_values(steps, {f"_s_{n}": f"CASE WHEN _k_{n} IS NULL THEN {DEFAULT_SCORE}D ELSE _f_{n} END" for n in three})
    mean = "(_s_coherence + _s_accuracy + _s_helpfulness) / 3"
    steps = with_values(steps, {"_s_overall": f"CASE WHEN _k_overall IS NULL THEN {mean} ELSE _f_overall END"})

    # The first field that cannot be read decides between a failure and a parse error.
    unread = ", ".join(
        f"CASE WHEN _k_{n} IN ('VOID', 'ARRAY', 'OBJECT') THEN {_error('TypeError', NOT_A_NUMBER, f'_k_{n}')} "
        f"WHEN _k_{n} IS NOT NULL AND _f_{n} IS NULL THEN '{PARSE_ERROR}' END" for n in CRITERIA)
    # NaN sorts above every number, so it is outside too.
    outside = " OR ".join(f"_s_{n} < {MIN_SCORE}D OR _s_{n} > {MAX_SCORE}D" for n in CRITERIA)
    number = "CASE WHEN schema_of_variant(_v) = 'BIGINT' THEN 'INT' ELSE 'FLOAT' END"
    steps = with_values(steps, {"_problem": f"""CASE
        WHEN {response} IS NULL THEN '{FAILED}: no response'
        WHEN _v IS NULL THEN '{PARSE_ERROR}'
        WHEN _kind <> 'OBJECT' THEN {_error('AttributeError', NO_GET, f"CASE _kind WHEN 'NUMBER' THEN {number} ELSE _kind END")}
        WHEN coalesce({unread}) IS NOT NULL THEN coalesce({unread})
        WHEN {outside} OR _k_reasoning <> 'STRING' THEN '{FAILED}: ValidationError' END"""})
    fallback = f"CASE WHEN _problem = '{PARSE_ERROR}' THEN {DEFAULT_SCORE}D ELSE 0D END"
    scores = ", ".join(f"CASE WHEN _problem IS NULL THEN _s_{n} ELSE {fallback} END AS {n}" for n in CRITERIA)
    return steps.selectExpr(
        *rows.columns,
        f"struct({scores}) AS scores",
        f"""CASE WHEN _problem IS NOT NULL THEN false WHEN _k_passed IS NULL OR _k_passed = 'VOID' THEN {meets(limits, '_s_')}
            ELSE {V.truthy('_passed', '_k_passed')} END AS passed""",
        f"coalesce(_problem, try_variant_get(_reasoning, '$', 'string'), '{NO_REASONING}') AS judgment_reasoning",
    )


def _error(name: str, message: str, kind: str) -> str:
    """A failure reasoning with the Python name of the value's type in it."""
    names = ", ".join(f"'{k}', '{n}'" for k, n in TYPE_NAMES.items())
    before, after = message.split("{type}")
    return f"concat({quoted(f'{FAILED}: {name}: {before}')}, element_at(map({names}), {kind}), {quoted(after)})"
