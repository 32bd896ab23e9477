"""Raw rows to typed pairs: field resolution, normalisation, ids, exact dedup, dataset facts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, functions as F, types as T

from pairloom.functions import variants as V
from pairloom.functions.rows import quoted, with_values
from pairloom.functions.text import UNIT, canonical_id, iso_timestamp, iso_timestamp_sql, pair_id, strip_sql, text
from pairloom.operators.ordering import first_rows, first_wins

# --- fixed values: field names accepted for each pair field, in order of preference ---
FIELD_NAMES = {
    "instruction": ["instruction", "prompt", "question", "query"],
    "output": ["output", "completion", "response", "answer"],
    "input": ["input", "context", "passage"],
    "category": ["category", "label", "topic"],
    "difficulty": ["difficulty", "level"],
}
# ----------------------------------------------------------------------------------------
MAIN = ("instruction", "output")
# Text that reads as a whole number.
WHOLE_TEXT = r"^\s*[+-]?\d+(\.0*)?\s*$"


def mapping_from_text(expr: str | None) -> dict[str, str]:
    """``'instruction=prompt,output=answer'`` to a dict; parts without ``=`` are ignored."""
    parts = [p.strip() for p in (expr or "").split(",")]
    pairs = [p.split("=", 1) for p in parts if "=" in p]
    return {k.strip(): v.strip() for k, v in pairs}


def resolve_fields(raw: DataFrame, mapping: dict[str, str] | None = None) -> dict[str, str]:
    """For each pair field, the SQL text of the column that holds it.

    A table with a VARIANT column ``row`` is resolved row by row (rows may have different
    keys); any other table once, by its column names.
    """
    mapping = mapping or {}
    wanted = {f: ([mapping[f]] if mapping.get(f) else []) + names for f, names in FIELD_NAMES.items()}
    if is_variant(raw):
        return {f: V.first_present("row", names) for f, names in wanted.items()}
    found = {f: next((n for n in names if n in raw.columns), None) for f, names in wanted.items()}
    return {f: _plain_text(raw, n, f in MAIN) if n else quoted(None) for f, n in found.items()}


def is_variant(raw: DataFrame) -> bool:
    return "row" in raw.columns and isinstance(raw.schema["row"].dataType, T.VariantType)


def _plain_text(raw: DataFrame, name: str, main: bool) -> str:
    """A typed column as text; for instruction and output zero and false count as missing text."""
    kind = raw.schema[name].dataType
    if isinstance(kind, T.BooleanType):
        return f"CASE WHEN `{name}` THEN 'True'" + ("" if main else f" WHEN NOT `{name}` THEN 'False'") + " END"
    if isinstance(kind, T.NumericType) and main:
        return f"CASE WHEN `{name}` <> 0 THEN CAST(`{name}` AS STRING) END"
    return f"CAST(`{name}` AS STRING)"


def normalize_rows(raw: DataFrame, mapping: dict[str, str] | None = None, tag: str | None = None,
                   created_at: str | None = None, order: str = "seq") -> DataFrame:
    """Raw rows to pairs. Instruction and output are stripped text, falsy values empty;
    the optional fields keep their text as it is."""
    fields = resolve_fields(raw, mapping)
    main, optional = ["instruction", "output"], ["input", "category", "difficulty"]
    if is_variant(raw):
        rows = with_values(raw.select(order, "row"), {f"_{f}": sql for f, sql in fields.items()})
        stripped = {f: f"CASE WHEN {V.truthy(f'_{f}')} THEN {strip_sql(V.as_text(f'_{f}'))} ELSE '' END" for f in main}
        rows = with_values(rows, stripped | {f: V.as_text(f"_{f}") for f in optional})
    else:
        stripped = [f"{strip_sql('coalesce(' + fields[f] + ', ' + quoted('') + ')')} AS {f}" for f in main]
        rows = raw.selectExpr(order, *stripped, *[f"{fields[f]} AS {f}" for f in optional])
    tags = "'source', 'user'" + (f", 'tag', {quoted(tag)}" if tag else "")
    return rows.select(
        order, pair_id("instruction", "output").alias("id"), "instruction", "input", "output",
        F.expr("CAST(NULL AS STRING) AS context"), "category", "difficulty", F.expr(f"map({tags}) AS metadata"),
        F.expr("CAST(NULL AS STRING) AS source_seed"), F.expr("CAST(NULL AS INT) AS cycle_id"),
        F.lit(created_at).cast("timestamp").alias("created_at"),
    )


def drop_empty(pairs: DataFrame) -> DataFrame:
    """Rows with neither instruction nor output are dropped; one of the two is enough to stay."""
    return pairs.filter((F.col("instruction") != "") | (F.col("output") != ""))


def drop_exact_copies(pairs: DataFrame, order: str = "seq") -> DataFrame:
    """The first of the pairs with the same id."""
    return first_wins(pairs, "id", order)


def ingest(raw: DataFrame, mapping: dict[str, str] | None = None, tag: str | None = None,
           limit: int | None = None, created_at: str | None = None, order: str = "seq",
           stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Raw rows to the stored dataset. The limit counts raw rows, before anything is dropped.

    Finding the first copies reads the rows twice. With ``stage`` they are parsed once, and the
    first reading takes only ids and places from the staged table; worth it for text sources.
    """
    rows = raw if limit is None else first_rows(raw, limit, order)
    pairs = drop_empty(normalize_rows(rows, mapping, tag, created_at, order))
    return drop_exact_copies(stage(pairs) if stage else pairs, order)


def fingerprint(pairs: DataFrame) -> DataFrame:
    """Row count and an order-free checksum: the sum of the top 60 bits of each row's sha256."""
    digest = F.sha2(F.concat(F.col("instruction"), F.lit(UNIT), F.col("output")), 256)
    bits = F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(20,0)")
    total = F.coalesce(F.sum(bits), F.lit(0).cast("decimal(30,0)"))
    return pairs.agg(F.count(F.lit(1)).alias("row_count"), total.cast("string").alias("checksum"))


# Values of the sequence checksum: a prime below 2**61 and a base.
SEQUENCE_PRIME, SEQUENCE_BASE = (1 << 61) - 1, 1_000_003


def sequence_fingerprint(pairs: DataFrame, order: str = "seq") -> DataFrame:
    """(row_count, checksum, power) of the rows in their order: equal for any partitioning, different when two rows change places.

    The checksum is a polynomial of the rows' digests modulo a prime. Two stretches of rows are combined from
    (checksum, power) alone, power being the base to the number of rows: that is how sorted ranges, each folded in its own task,
    become one number, and how ``combine_fingerprints`` appends datasets.
    """
    digest = F.sha2(F.concat(F.coalesce("instruction", F.lit("")), F.lit(UNIT), F.coalesce("output", F.lit(""))), 256)
    keyed = pairs.select(F.col(order).alias("at"), F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("bits"))
    prime, base = SEQUENCE_PRIME, SEQUENCE_BASE

    def folded(batches: Iterator) -> Iterator:
        import pyarrow as arrow

        part, n, total, power = None, 0, 0, 1
        for batch in batches:
            for place, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part, n = place, n + 1
                total, power = (total * base + value) % prime, power * base % prime
        if n:
            yield arrow.RecordBatch.from_arrays([arrow.array([v], arrow.int64()) for v in (part, n, total, power)],
                                                names=["place", "row_count", "checksum", "power"])

    ranges = keyed.repartitionByRange("at").sortWithinPartitions("at").select(F.spark_partition_id().cast("long").alias("part"), "bits")
    return combine_fingerprints(ranges.mapInArrow(folded, "place long, row_count long, checksum long, power long"))


def combine_fingerprints(parts: DataFrame) -> DataFrame:
    """One (row_count, checksum, power) from those of consecutive stretches, in the order of ``place``; a few rows."""
    times = lambda a, b: f"CAST((CAST({a} AS DECIMAL(19, 0)) * CAST({b} AS DECIMAL(19, 0))) % {SEQUENCE_PRIME} AS BIGINT)"
    listed = F.sort_array(F.collect_list(F.struct("place", "row_count", "checksum", "power"))).alias("parts")
    start = "named_struct('n', 0L, 'checksum', 0L, 'power', 1L)"
    step = (f"named_struct('n', s.n + p.row_count, 'checksum', ({times('s.checksum', 'p.power')} + p.checksum) % {SEQUENCE_PRIME}, "
            f"'power', {times('s.power', 'p.power')})")
    whole = parts.agg(listed).select(F.expr(f"aggregate(parts, {start}, (s, p) -> {step})").alias("whole"))
    return whole.select(F.col("whole.n").alias("row_count"), F.col("whole.checksum").alias("checksum"), F.col("whole.power").alias("power"))


def dataset_meta(pairs: DataFrame, name: str, source: str, tag: str | None = None,
                 mapping: dict[str, str] | None = None, created_at: str | None = None) -> DataFrame:
    """The one-row description stored beside a dataset."""
    entries = [F.lit(x) for kv in (mapping or {}).items() for x in kv]
    empty_map = F.lit(None).cast("map<string,string>")
    return fingerprint(pairs).select(
        F.lit(name).alias("name"), F.lit(source).alias("source"), "row_count",
        F.lit(created_at).cast("timestamp").alias("created_at"),
        (F.array(F.lit(tag)) if tag else F.array().cast("array<string>")).alias("tags"),
        (F.create_map(*entries) if entries else F.coalesce(empty_map, F.create_map().cast("map<string,string>"))).alias("mapping"),
        "checksum",
    )


def canonical_pairs(pairs: DataFrame) -> DataFrame:
    """Stored text ids and timestamps to their canonical form."""
    created = F.col("created_at") if isinstance(pairs.schema["created_at"].dataType, T.TimestampType) \
        else iso_timestamp("created_at")
    return pairs.withColumns({"id": canonical_id("id"), "created_at": created})


def tolerant_pairs(records: DataFrame, column: str = "row") -> DataFrame:
    """VARIANT records to pairs; a record that is not a valid pair is dropped.

    Valid: an object whose text fields are text (the optional ones may be null), whose
    metadata is an object, cycle_id a whole number (also as text or a truth value) or null, created_at a
    readable timestamp. A cycle_id beyond 32 bits is read as null.
    """
    keep = [c for c in records.columns if c != column]
    texts = ["instruction", "output", "input", "context", "category", "difficulty", "source_seed"]
    names = ["id", *texts, "metadata", "cycle_id", "created_at"]
    fields = with_values(records, {"_kind": V.kind(column)} | {f"_{n}": V.member(column, n) for n in names})
    kinds = with_values(fields, {f"_k_{n}": f"coalesce({V.kind(f'_{n}')}, 'absent')" for n in names})
    got = lambda n, t: f"try_variant_get(_{n}, '$', '{t}')"
    read = with_values(kinds, {f"_t_{n}": got(n, "string") for n in ["id", *texts]} | {
        "_cycle": V.float_of("_cycle_id"), "_created": iso_timestamp_sql(got("created_at", "string")),
        "_metadata_map": got("metadata", "map<string,string>")})
    allowed = {n: ["absent", "STRING"] for n in ("id", "instruction", "output", "created_at")} \
        | {n: ["absent", "STRING", "VOID"] for n in texts[2:]} \
        | {"metadata": ["absent", "OBJECT"], "cycle_id": ["absent", "VOID", "NUMBER", "STRING", "BOOLEAN"]}
    valid = F.col("_kind") == "OBJECT"
    for n, kinds_of in allowed.items():
        valid = valid & F.col(f"_k_{n}").isin(kinds_of)
    whole_number = F.col("_cycle").isNotNull() & ~F.isnan("_cycle") & (F.col("_cycle") == F.rint("_cycle"))
    spelled = (F.col("_k_cycle_id") != "STRING") | F.expr(f"{got('cycle_id', 'string')} RLIKE {quoted(WHOLE_TEXT)}")
    valid = valid & (F.col("_k_cycle_id").isin("absent", "VOID") | (whole_number & spelled))
    valid = valid & ((F.col("_k_created_at") == "absent") | F.col("_created").isNotNull())
    whole = read.filter(valid)
    empty = F.create_map().cast("map<string,string>")
    return whole.select(
        *keep, canonical_id("_t_id").alias("id"), *[text(f"_t_{n}").alias(n) for n in texts[:2]],
        *[F.col(f"_t_{n}").alias(n) for n in texts[2:]], F.coalesce("_metadata_map", empty).alias("metadata"),
        F.expr("try_cast(_cycle AS INT)").alias("cycle_id"), F.col("_created").alias("created_at"),
    )


def preview(raw: DataFrame, order: str = "seq", n: int = 3) -> DataFrame:
    """The first raw rows, for a look before ingesting."""
    return raw.orderBy(order).limit(n)
