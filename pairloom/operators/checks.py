"""Data-quality checks: one scan of the texts, everything else from its narrow result."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pairloom.functions.rows import quoted, small_batches
from pairloom.functions.text import pair_hash
from pairloom.operators.ordering import HOT_ROWS, join_groups

# --- fixed values: patterns of personal data, tried in this order, flagged words, message texts ---
PII_PATTERNS = {
    "email": r"\b[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\b",
    "phone": r"\b(?:\+?\d{1,3}[\s-]?)?(?:\(?\d{3}\)?[\s-]?)?\d{3}[\s-]?\d{4}\b",
    "api_key": r"\b(?:sk-[A-Za-z0-9]{16,}|ghp_[A-Za-z0-9]{16,}|AKIA[0-9A-Z]{16})\b",
}
PHONE_DIGITS = r"(?U)\d{3}[\s-]?\d{4}"
FLAGGED_WORDS = ["badword1", "badword2"]
WORD = r"\p{L}+"
ALL_CHECKS = ["schema", "length", "dedup", "pii", "lang", "profanity"]
DEFAULT_CHECKS = ["schema", "length", "dedup", "pii"]
EMPTY = "{field} is empty"
SHORT = "instruction shorter than {n} chars"
LONG = "output longer than {n} chars"
PERSONAL = "potential {kind} detected"
OTHER_LANGUAGE = "language != {lang}"
FLAGGED = "flagged term detected"
# ---------------------------------------------------------------------------------------------

# Frequent function words per language for the built-in detector; pass your own for others.
FUNCTION_WORDS = {
    "de": ["der", "die", "das", "und", "ist", "nicht", "ein", "eine", "mit", "auf"],
    "en": ["the", "and", "of", "to", "is", "that", "it", "for", "with", "was"],
    "es": ["el", "los", "las", "y", "que", "es", "por", "con", "para", "una"],
    "fr": ["le", "les", "des", "et", "est", "dans", "pour", "qui", "une", "avec"],
}


@dataclass
class Options:
    """Limits and policies of the checks."""

    min_instruction_len: int = 3
    max_output_len: int = 8000
    pii_policy: str = "warn"            # warn, strict or off
    lang: str | None = None             # wanted language; None leaves the check off
    lang_column: str | Column | None = None   # the language by a detector of the caller's; None counts function words
    lang_table: DataFrame | None = None       # the same as rows (id, lang)
    function_words: dict[str, list[str]] = field(default_factory=lambda: FUNCTION_WORDS)
    flagged_words: list[str] | None = None


INSTRUCTION, OUTPUT = "coalesce(instruction, '')", "coalesce(output, '')"


def issue(when: str, check: str, severity: str, message: str, field_name: str | None = None) -> str:
    """SQL text of an issue where the condition holds, else NULL; ``message`` is SQL text too."""
    return (f"CASE WHEN {when} THEN struct({quoted(check)} AS check, {quoted(severity)} AS severity, "
            f"{message} AS message, {quoted(field_name)} AS field) END")


def schema_issues(o: Options) -> list[str]:
    return [issue(f"{sql} = ''", "schema", "error", quoted(EMPTY.format(field=name)), name)
            for name, sql in (("instruction", INSTRUCTION), ("output", OUTPUT))]


def length_issues(o: Options) -> list[str]:
    short, long = SHORT.format(n=o.min_instruction_len), LONG.format(n=o.max_output_len)
    return [
        issue(f"length({INSTRUCTION}) < {o.min_instruction_len}", "length", "warning", quoted(short), "instruction"),
        issue(f"length({OUTPUT}) > {o.max_output_len}", "length", "warning", quoted(long), "output"),
    ]


def pii_kind(blob: str) -> str:
    """SQL text of the first kind of personal data found, or NULL.

    A cheap test that every match passes comes before each pattern: the sign @, the last
    seven digits of a phone number, the first letters of a key.
    """
    has = {k: f"{blob} RLIKE {quoted('(?U)' + p)}" for k, p in PII_PATTERNS.items()}
    key_mark = f"(contains({blob}, 'sk-') OR contains({blob}, 'ghp_') OR contains({blob}, 'AKIA'))"
    digits = f"{blob} RLIKE {quoted(PHONE_DIGITS)}"
    return (f"CASE WHEN contains({blob}, '@') AND {has['email']} THEN 'email' WHEN {digits} AND {has['phone']} THEN 'phone' "
            f"WHEN {key_mark} AND {has['api_key']} THEN 'api_key' END")


def pii_issues(o: Options) -> list[str]:
    if o.pii_policy == "off":
        return []
    severity = "error" if o.pii_policy == "strict" else "warning"
    kind = pii_kind(f"concat({INSTRUCTION}, '\\n', {OUTPUT})")
    before, after = PERSONAL.split("{kind}")
    return [issue(f"{kind} IS NOT NULL", "pii", severity, f"concat({quoted(before)}, {kind}, {quoted(after)})")]


def detect_language(c: str, words: dict[str, list[str]] = FUNCTION_WORDS) -> str:
    """SQL text of the language with the most distinct function words; NULL when none occurs.
    Languages with equal hits are taken in the order of their codes. The text is cut into words once: one-element
    transforms give names to what is used several times."""
    tokens = f"regexp_extract_all(lower({c}), {quoted('(' + WORD + ')')}, 1)"
    scored = []
    for i, (code, ws) in enumerate(sorted(words.items())):
        known = f"array({', '.join(quoted(w) for w in ws)})"
        scored.append(f"struct(size(array_intersect(_words, {known})) AS hits, {-i} AS place, {quoted(code)} AS code)")
    best = f"greatest({', '.join(scored)})" if len(scored) > 1 else scored[0]
    ranked = f"transform(array({tokens}), _words -> {best})"
    return f"transform({ranked}, _best -> CASE WHEN _best.hits > 0 THEN _best.code END)[0]"


def lang_issues(o: Options) -> list[str]:
    if not o.lang:
        return []
    found = f"`{o.lang_column}`" if o.lang_column else f"({detect_language(INSTRUCTION, o.function_words)})"
    return [issue(f"{INSTRUCTION} <> '' AND {found} <> {quoted(o.lang)}", "lang", "warning", quoted(OTHER_LANGUAGE.format(lang=o.lang)))]


def has_flagged_word(blob: str, words: list[str]) -> str:
    """SQL text: whether a run of letters a-z in the lower-cased text is one of the words.
    Words with other characters can never be such a run."""
    letters = sorted({w for w in words if re.fullmatch("[a-z]+", w)})
    if not letters:
        return "false"
    listed = ", ".join(quoted(w) for w in letters)
    return f"arrays_overlap(regexp_extract_all(lower({blob}), '([a-z]+)', 1), array({listed}))"


def profanity_issues(o: Options) -> list[str]:
    hit = has_flagged_word(f"concat({INSTRUCTION}, ' ', {OUTPUT})", o.flagged_words or FLAGGED_WORDS)
    return [issue(hit, "profanity", "warning", quoted(FLAGGED))]


ROW_CHECKS: dict[str, Callable[[Options], list[str]]] = {
    "schema": schema_issues, "length": length_issues, "pii": pii_issues,
    "lang": lang_issues, "profanity": profanity_issues,
}


Check = Callable[[str | None, str | None], Iterable[tuple[str, str, str | None]]]


def custom_issues(pairs: DataFrame, name: str, check: Check, order: str = "seq") -> DataFrame:
    """(order, pair_id, check, severity, message, field): what a check written in Python finds, over Arrow batches.

    The function gets instruction and output of a pair and yields any number of (severity, message, field). If it raises, that is an issue of
    severity error, and what it has yielded before stays. A task holds the texts of about a megabyte of rows as Python text, however
    large its share. It needs nothing of this package.
    """
    rows = pairs.select(order, F.col("id").alias("pair_id"), "instruction", "output")
    schema = T.StructType([rows.schema[order], rows.schema["pair_id"], *[
        T.StructField(c, T.StringType()) for c in ("check", "severity", "message", "field")]])
    small = small_batches()

    def run(batches):
        import pyarrow as arrow

        for batch in small(batches):
            places, told = [], []
            for at, (instruction, output) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                try:
                    for severity, message, place in check(instruction, output):
                        told.append((name, severity, message, place))
                        places.append(at)
                except Exception as e:  # any error of the caller's function is an issue
                    told.append((name, "error", f"{name} failed: {type(e).__name__}: {e}", None))
                    places.append(at)
            if told:
                kept = [batch.column(i).take(arrow.array(places, arrow.int64())) for i in (0, 1)]
                yield arrow.RecordBatch.from_arrays([*kept, *[arrow.array(c, arrow.string()) for c in zip(*told)]], names=schema.names)

    return rows.mapInArrow(run, schema)


def check_facts(pairs: DataFrame, checks: list[str] | None = None, options: Options | None = None, order: str = "seq",
                custom: dict[str, Check] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The only scan of the texts: order, id, the row's issues and the hash of its normalised text.

    Everything below works on these narrow rows. Stage them (``session.stage``) when more
    than one result is wanted from a large dataset. The issues of ``custom`` checks, by name, join the others of
    their row; ``keep`` names columns of the pairs to stay.
    """
    options = options or Options()
    if isinstance(options.lang_column, Column):
        pairs, options = pairs.withColumn("_language", options.lang_column), replace(options, lang_column="_language")
    elif options.lang_table is not None:
        named = options.lang_table.select(F.col("id"), F.col("lang").alias("_language"))
        pairs, options = pairs.join(named, "id", "left"), replace(options, lang_column="_language")
    names = ALL_CHECKS if checks is None else checks
    issues = [c for n in names if n in ROW_CHECKS for c in ROW_CHECKS[n](options)]
    kind = "array<struct<check:string,severity:string,message:string,field:string>>"
    found = F.expr(f"CAST(array({', '.join(issues)}) AS {kind})")   # NULL where a check found nothing
    facts = pairs.select(
        order, "id", found.alias("found"),
        F.unhex(pair_hash("instruction", "output")).alias("hash"),
        F.lit("dedup" in names).alias("dedup"), *keep,
    )
    for name, check in (custom or {}).items():
        told = custom_issues(pairs, name, check, order).groupBy(order).agg(
            F.collect_list(F.struct("check", "severity", "message", "field")).alias("_told"))
        more = F.concat("found", F.coalesce("_told", F.expr(f"CAST(array() AS {kind})")))
        facts = facts.join(told, order, "left").withColumn("found", more).drop("_told")
    return facts


def copies(facts: DataFrame, order: str = "seq", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every row after the first with the same normalised text: order, id, first_id."""
    rows = facts.select(order, "id", "hash")
    groups = rows.groupBy("hash").agg(
        F.min(F.struct(order, "id")).alias("first"), F.count(F.lit(1)).alias("n")
    ).filter(F.col("n") > 1)
    joined = join_groups(rows, groups, "hash", "n", order, hot_rows)
    return joined.filter(F.col(order) > F.col(f"first.{order}")).select(order, "id", F.col("first.id").alias("first_id"))


def issues(facts: DataFrame, order: str = "seq", hot_rows: int = HOT_ROWS) -> DataFrame:
    """The issue table: order, pair_id, check, severity, message, field."""
    per_row = facts.select(order, F.col("id").alias("pair_id"), F.explode_outer("found").alias("i")) \
        .filter(F.col("i").isNotNull()).select(order, "pair_id", "i.*")
    dup = copies(facts.filter("dedup"), order, hot_rows).select(
        order, F.col("id").alias("pair_id"), F.lit("dedup").alias("check"), F.lit("warning").alias("severity"),
        F.concat(F.lit("duplicate of "), F.col("first_id")).alias("message"), F.lit(None).cast("string").alias("field"),
    )
    return per_row.unionByName(dup)


def issue_counts(facts: DataFrame) -> DataFrame:
    """(key, n): issues per check and per ``severity:<s>``, without building the issue table.

    Copies are counted as rows minus first rows per hash, so no join is needed.
    """
    per_row = facts.select(F.explode_outer("found").alias("i")).filter(F.col("i").isNotNull()).groupBy(
        F.col("i.check").alias("check"), F.col("i.severity").alias("severity")
    ).agg(F.count(F.lit(1)).alias("n"))
    dup = facts.filter("dedup").groupBy("hash").agg(F.count(F.lit(1)).alias("m")).agg(
        F.lit("dedup").alias("check"), F.lit("warning").alias("severity"),
        F.coalesce(F.sum(F.col("m") - 1), F.lit(0)).alias("n"),
    )
    each = per_row.unionByName(dup).filter("n > 0")
    keys = F.explode(F.array(F.col("check"), F.concat(F.lit("severity:"), F.col("severity")))).alias("key")
    return each.select(keys, "n").groupBy("key").agg(F.sum("n").alias("n"))


def issue_cube(facts: DataFrame, *dimensions: str) -> DataFrame:
    """(check, severity, the dimensions, level, n): issues of the rows by every subset of these columns, in one pass.

    The issues are counted by all columns first; one expansion of these counts, not of the rows, makes all subtotals.
    ``level`` is the grouping id: a bit for each column that is summed over, the last one lowest. Copies are no issue of a row.
    """
    found = facts.select(F.explode("found").alias("i"), *dimensions).filter("i IS NOT NULL")
    columns = ["check", "severity", *dimensions]
    counts = found.select("i.check", "i.severity", *dimensions).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return counts.cube(*columns).agg(F.grouping_id().alias("level"), F.sum("n").alias("n"))


def report(facts: DataFrame) -> DataFrame:
    """Issue counts plus the row ``total_pairs``."""
    total = facts.agg(F.lit("total_pairs").alias("key"), F.count(F.lit(1)).alias("n"))
    return issue_counts(facts).unionByName(total)


def validate(pairs: DataFrame, checks: list[str] | None = None, options: Options | None = None,
             order: str = "seq", stage: Callable[[DataFrame], DataFrame] | None = None,
             custom: dict[str, Check] | None = None) -> DataFrame:
    """The issue table of a dataset. Unknown check names are ignored."""
    facts = check_facts(pairs, checks, options, order, custom)
    return issues(stage(facts) if stage else facts, order)


def clean_order(facts: DataFrame, drop_severities: tuple[str, ...] = ("error",), drop_copies: bool = True,
                order: str = "seq", hot_rows: int = HOT_ROWS) -> DataFrame:
    """The order values of the rows that stay.

    A row goes when any row with its id has an issue of a dropped severity, or when an
    earlier row that stayed has the same normalised text. Rows are first combined per
    (id, hash), so copies shrink before anything is shuffled.
    """
    dropped = F.array(*[F.lit(s) for s in drop_severities]).cast("array<string>")
    bad = F.coalesce(F.arrays_overlap(F.col("found.severity"), dropped), F.lit(False))
    if drop_copies:
        merged = facts.groupBy("id", "hash").agg(F.min(order).alias(order), F.max(bad).alias("bad"))
    else:
        merged = facts.select("id", order, bad.alias("bad"))
    bad_ids = merged.filter("bad").select("id").distinct()
    if "warning" in drop_severities:
        dup = copies(facts.filter("dedup"), order, hot_rows)
        bad_ids = bad_ids.unionByName(dup.select("id")).distinct()
    kept = merged.join(bad_ids, "id", "left_anti")
    if not drop_copies:
        return kept.select(order)
    return kept.groupBy("hash").agg(F.min(order).alias(order)).select(order)


def clean(pairs: DataFrame, facts: DataFrame, drop_severities: tuple[str, ...] = ("error",),
          drop_copies: bool = True, order: str = "seq") -> DataFrame:
    """The pairs that stay; the wide rows move once, by the unique order column."""
    kept = clean_order(facts, drop_severities, drop_copies, order)
    return pairs.join(kept, order, "left_semi")


def quality_gate(facts: DataFrame, fail_on: str = "never") -> DataFrame:
    """One row: errors, warnings and whether the gate holds for 'error', 'warning' or 'never'."""
    n = lambda s: F.coalesce(F.sum(F.when(F.col("key") == f"severity:{s}", F.col("n"))), F.lit(0))
    counts = issue_counts(facts).agg(n("error").alias("errors"), n("warning").alias("warnings"))
    broken = {"error": F.col("errors") > 0, "warning": (F.col("errors") > 0) | (F.col("warnings") > 0),
              "never": F.lit(False)}
    if fail_on not in broken:
        raise ValueError(f"unknown gate: {fail_on}")
    return counts.select("errors", "warnings", F.lit(fail_on).alias("fail_on"), (~broken[fail_on]).alias("passed"))
