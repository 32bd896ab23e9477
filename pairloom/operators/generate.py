"""Generation: seeds to request texts, response texts to pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions import variants as V
from pairloom.functions.rows import quoted, with_values
from pairloom.functions.text import strip, strip_sql, uuid5

# --- fixed values: the request texts per template ---------------------------------------
TEMPLATES = {
    "QA": (
        "Generate a question-answer pair based on this topic:\n\n{seed}\n\n"
        "Respond in JSON format:\n{\n"
        '    "instruction": "The question to ask",\n'
        '    "output": "The detailed answer",\n'
        '    "category": "qa"\n}'
    ),
    "INSTRUCTION": (
        "Generate an instruction-following training example based on this topic:\n\n{seed}\n\n"
        "Respond in JSON format:\n{\n"
        '    "instruction": "The instruction",\n'
        '    "output": "The ideal response",\n'
        '    "category": "instruction"\n}'
    ),
    "REASONING": (
        "Generate a reasoning problem with step-by-step solution based on this topic:\n\n{seed}\n\n"
        "Respond in JSON format:\n{\n"
        '    "instruction": "The problem",\n'
        '    "output": "The step-by-step solution",\n'
        '    "category": "reasoning"\n}'
    ),
    "CREATIVE": (
        "Generate a creative writing task based on this topic:\n\n{seed}\n\n"
        "Respond in JSON format:\n{\n"
        '    "instruction": "The creative task",\n'
        '    "output": "An example response",\n'
        '    "category": "creative"\n}'
    ),
}
DEFAULT_TEMPLATE = "INSTRUCTION"
GENERATION_FAILED = "[Generation failed]"
FENCED = r"(?s)```(?:json)?(.*?)(?:```|\z)"
# ------------------------------------------------------------------------------------------


def seed_list(spark, expr: str) -> DataFrame:
    """Comma-separated seeds, trimmed, without empty ones: seq, seed."""
    listed = spark.range(1).select(F.posexplode(F.split(F.lit(expr), ",")).alias("seq", "seed"))
    return listed.select(F.col("seq").cast("bigint").alias("seq"), strip("seed").alias("seed")).filter("seed != ''")


def template_text(name: Column) -> Column:
    """The template by name, ignoring case; an unknown name gives the default one."""
    chosen = F.lit(TEMPLATES[DEFAULT_TEMPLATE])
    for key, body in TEMPLATES.items():
        chosen = F.when(F.upper(name) == key, F.lit(body)).otherwise(chosen)
    return chosen


def generation_requests(seeds: DataFrame, template: str | Column = DEFAULT_TEMPLATE,
                        system: str | None = None) -> DataFrame:
    """Add the request text ``prompt`` to seeds."""
    name = F.lit(template) if isinstance(template, str) else template
    prompt = F.replace(template_text(name), F.lit("{seed}"), F.col("seed"))
    requests = seeds.withColumn("prompt", prompt)
    return requests.withColumn("system", F.lit(system)) if system else requests


def parse_generated(responses: DataFrame, cycle_id: int | None = None, strip_fences: bool = False,
                    order: str = "seq") -> DataFrame:
    """Rows (seq, seed, response) to pairs.

    A JSON object gives the pair's fields, absent texts being empty. Text that is not JSON
    becomes the output, with the seed as instruction. A missing response, JSON that is not
    an object and a field that is not text give the marker of a failed generation.
    """
    response = strip_sql("response")
    if strip_fences:
        inner = f"regexp_extract({response}, {quoted(FENCED)}, 1)"
        response = f"CASE WHEN contains({response}, '```') THEN {strip_sql(inner)} ELSE {response} END"
    required, optional = ["instruction", "output"], ["context", "category", "difficulty"]
    names = [*required, *optional]
    steps = with_values(responses, {"_v": V.strict_json(response)})
    steps = with_values(steps, {"_kind": V.kind("_v")} | {f"_{n}": V.member("_v", n) for n in names})
    steps = with_values(steps, {f"_k_{n}": f"coalesce({V.kind(f'_{n}')}, 'absent')" for n in names})
    not_text = " OR ".join([f"_k_{n} NOT IN ('absent', 'STRING')" for n in required]
                           + [f"_k_{n} NOT IN ('absent', 'STRING', 'VOID')" for n in optional])
    state = f"""CASE WHEN response IS NULL THEN 'failed' WHEN _v IS NULL THEN 'raw'
        WHEN _kind <> 'OBJECT' OR {not_text} THEN 'failed' ELSE 'pair' END"""
    steps = with_values(steps, {"_state": state})
    value = lambda n: f"CASE WHEN _state = 'pair' THEN try_variant_get(_{n}, '$', 'string') END"
    cycle = "CAST(NULL AS INT)" if cycle_id is None else str(int(cycle_id))
    return steps.select(
        order,
        generated_id(cycle, order).alias("id"),
        F.expr(f"CASE WHEN _state = 'pair' THEN coalesce({value('instruction')}, '') ELSE seed END AS instruction"),
        F.expr("CAST(NULL AS STRING) AS input"),
        F.expr(f"""CASE _state WHEN 'pair' THEN coalesce({value('output')}, '') WHEN 'raw' THEN response
            ELSE {quoted(GENERATION_FAILED)} END AS output"""),
        *[F.expr(f"{value(n)} AS {n}") for n in optional],
        F.expr("CAST(map() AS MAP<STRING, STRING>) AS metadata"),
        F.col("seed").alias("source_seed"),
        F.expr(f"{cycle} AS cycle_id"),
        F.expr("CAST(NULL AS TIMESTAMP) AS created_at"),
    )


def generated_id(cycle: str, order: str, seed: str = "seed") -> Column:
    """Repeatable id of a generated pair: one per cycle and seed position."""
    return uuid5(f"concat_ws('::', 'generated', CAST({cycle} AS STRING), CAST({order} AS STRING), {seed})")


def generated_pairs(seeds: DataFrame, responses: DataFrame, cycle_id: int | None = None,
                    order: str = "seq") -> DataFrame:
    """Every seed as a pair: responses (seq, response) joined to seeds, absent ones as failures."""
    rows = seeds.select(order, "seed").join(responses.select(order, "response"), order, "left")
    return parse_generated(rows, cycle_id, order=order)
