"""Inputs of the registered queries, derived from the given tables by Spark.

The tables hold documents, labels and conversations but no judgments or judge responses, so
scores and response texts follow from the document number by a formula that SQL can repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.functions.verdict import THRESHOLDS, meets
from pairloom.operators.judge import BUILTIN, cache_rows

LOWER = "abcdefghijklmnopqrstuvwxyz"
COPY_OFFSET = 10_000_000
BACKEND, MODEL = "rule", "rule-1"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def raw_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as raw rows: the first line is the prompt, the whole text the completion."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("seq"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("prompt"),
        F.col("text").alias("completion"), F.col("source").alias("topic"), F.col("lang").alias("level"))


def raw_dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Raw rows with empty and too short texts, and with copies that differ in case and spacing."""
    rows = raw_docs(spark, sf)
    where = lambda source, lang: (F.col("topic") == source) & (F.col("level") == lang)
    prompt = F.when(where("src7", "fr"), "").when(where("src3", "de"), "ok").otherwise(F.col("prompt"))
    broken = rows.withColumns({
        "prompt": prompt, "completion": F.when(where("src11", "es"), "").otherwise(F.col("completion"))})
    wide = lambda c: F.replace(F.col(c), F.lit(" "), F.lit("   "))
    # Basic letters only: case mapping of others differs between engines.
    upper = lambda c: F.when(F.col("level") == "en", F.translate(wide(c), LOWER, LOWER.upper())).otherwise(wide(c))
    again = broken.filter(F.col("topic").isin("src5", "src10")).withColumns({
        "seq": F.col("seq") + COPY_OFFSET, "prompt": upper("prompt"), "completion": upper("completion")})
    return broken.unionByName(again)


def as_pairs(raw: DataFrame) -> DataFrame:
    """Raw rows as pairs whose id is the row number."""
    return raw.select(
        "seq", F.col("seq").cast("string").alias("id"), F.col("prompt").alias("instruction"), F.lit(None).cast("string").alias("input"),
        F.col("completion").alias("output"), F.col("topic").alias("category"), F.col("level").alias("difficulty"),
        F.create_map(F.lit("source"), F.lit("user")).alias("metadata"))


def json_lists(items: DataFrame, before: str = '{"data": [', after: str = "]}") -> DataFrame:
    """Lines of JSON documents that list the texts of ``item``: one document per partition, so one per file that is written."""
    def lines(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sign = before
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                texts = batch.column(0).slice(at, 1000).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([(", " if i else sign) + t for i, t in enumerate(texts)], pa.string())], names=["value"])
                sign = ", "
        yield pa.RecordBatch.from_arrays([pa.array([after if sign == ", " else before + after], pa.string())], names=["value"])

    return items.select("item").mapInArrow(lines, "value string")


def doc_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return as_pairs(raw_docs(spark, sf))


def dirty_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return as_pairs(raw_dirty(spark, sf))


def raw_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as raw rows: a user's text and the assistant's answer to it."""
    turns = table(spark, sf, "conversations")
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    given = turns.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return asked.join(given.hint("merge"), ["conv_id", "turn"]).select(   # both sides grow: neither is broadcast
        (F.col("conv_id") * 1000 + F.col("turn")).alias("seq"), "question", "answer")


def turn_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return as_pairs(raw_turns(spark, sf).select(
        "seq", F.col("question").alias("prompt"), F.col("answer").alias("completion"),
        F.lit("conversation").alias("topic"), F.lit(None).cast("string").alias("level")))


# Scores of a document in tenths of a point.
TENTHS = {"coherence": "{d} * 7 % 101", "accuracy": "{d} * 13 % 101", "helpfulness": "{d} * 29 % 101"}


def _judged(docs: DataFrame, doc: str, tag: str) -> DataFrame:
    points = docs.selectExpr("doc_id", *[f"({t.format(d=doc)}) / 1e1D AS {n}" for n, t in TENTHS.items()])
    scored = points.selectExpr("*", "(coherence + accuracy + helpfulness) / 3 AS overall")
    return scored.selectExpr(
        "doc_id AS seq", "CAST(doc_id AS STRING) AS pair_id", "struct(coherence, accuracy, helpfulness, overall) AS scores",
        f"{meets(THRESHOLDS)} AS passed", f"'{MODEL}' AS judge_model", "concat('formula ', CAST(doc_id AS STRING)) AS judgment_reasoning",
        "CAST(NULL AS TIMESTAMP) AS judged_at", "struct('default' AS name, 1 AS version) AS rubric", f"'{tag}' AS tag")


def judge_a(spark: SparkSession, sf: str) -> DataFrame:
    """A run over all documents."""
    return _judged(table(spark, sf, "documents").select("doc_id"), "doc_id", "a")


def judge_b(spark: SparkSession, sf: str) -> DataFrame:
    """A run over the labelled documents only."""
    docs = table(spark, sf, "documents").select("doc_id")
    labelled = table(spark, sf, "labels").select("doc_id").distinct()
    return _judged(docs.join(labelled, "doc_id", "left_semi"), "(doc_id + 37)", "b")


def judge_log(spark: SparkSession, sf: str) -> DataFrame:
    """Both runs as one log: the second comes later, so it wins where it has a verdict."""
    later = judge_b(spark, sf).withColumn("seq", F.col("seq") + COPY_OFFSET)
    return judge_a(spark, sf).unionByName(later)


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """Judge responses in twelve shapes, from clean JSON to text that cannot be read."""
    docs = table(spark, sf, "documents").selectExpr("doc_id", *[f"{t.format(d='doc_id')} AS {n}" for n, t in TENTHS.items()])
    names = [*TENTHS, "overall"]
    whole = docs.selectExpr("*", "(coherence + accuracy + helpfulness) div 3 AS overall")
    texts = whole.selectExpr("doc_id", *[f"concat(CAST({n} div 10 AS STRING), '.', CAST({n} % 10 AS STRING)) AS {n}" for n in names])
    item = lambda n, v=None: f"""'"{n}": ', {v or n}"""
    obj = lambda *parts: "concat('{', " + ", ', ', ".join(parts) + ", '}')"
    three = [item(n) for n in TENTHS]
    passed, reason = item("passed", "'true'"), item("reasoning", """'"formula"'""")
    plain = obj(*three, item("overall"), passed, reason)
    shapes = [
        plain,
        f"concat('Here it is:\\n```json\\n', {plain}, '\\n```\\nDone.')",
        f"concat('```\\n', {plain}, '\\n```')",
        f"concat('My verdict: ', {plain}, ' as asked.')",
        obj(*three, passed),
        obj(*three, item("overall"), reason),
        obj(*[item(n, f"""concat('"', {n}, '"')""") for n in names], reason),
        obj(*three, item("overall"), item("passed", """'"false"'""")),
        obj(item("detail", """'{"a": 1}'"""), *three),
        "concat('Looks fine, score ', overall)",
        obj(three[0], item("accuracy", "'null'"), three[2], item("overall")),
        obj(item("coherence", "'11'"), three[1], three[2], item("overall")),
    ]
    cases = " ".join(f"WHEN {i} THEN {sql}" for i, sql in enumerate(shapes))
    return texts.selectExpr("doc_id AS seq", "CAST(doc_id AS STRING) AS pair_id", f"CASE doc_id % 12 {cases} END AS response")


def label_docs(spark: SparkSession, sf: str) -> DataFrame:
    """The labels table as a label log."""
    status = F.when(F.col("toxic") == 1, "rejected").when(F.col("quality") == 1, "approved").otherwise("needs_edit")
    return table(spark, sf, "labels").select(
        F.col("doc_id").alias("seq"), F.col("doc_id").cast("string").alias("pair_id"), status.alias("status"),
        F.when(F.col("quality") == 1, "good").alias("tag"), F.lit(None).cast("string").alias("note"), F.lit("user").alias("labeler"),
        F.lit(None).cast("timestamp").alias("labeled_at"))


def label_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a label log, many lines per user, in the order of time."""
    kind = F.col("event_type")
    status = F.when(kind == "purchase", "approved").when(kind == "error", "rejected").when(kind == "click", "needs_edit").otherwise("skipped")
    return table(spark, sf, "events").select(
        F.struct("ts", "event_id").alias("seq"), F.col("user_id").cast("string").alias("pair_id"), status.alias("status"),
        kind.alias("tag"), F.lit(None).cast("string").alias("note"), F.lit("user").alias("labeler"),
        F.lit(None).cast("timestamp").alias("labeled_at"))


def seeds(spark: SparkSession, sf: str) -> DataFrame:
    """Every whole document as a seed."""
    return raw_docs(spark, sf).select("seq", F.col("completion").alias("seed"))


def generated_texts(requests: DataFrame) -> DataFrame:
    """An offline generator: JSON for most seeds; for some plain text, a list or nothing."""
    n = F.col("seq") % 7
    said = F.to_json(F.struct(F.concat(F.lit("Explain: "), F.col("seed")).alias("instruction"),
                              F.concat_ws(" ", "seed", "seed").alias("output"), F.lit("echo").alias("category")))
    text = F.when(n == 3, F.concat(F.lit("Sorry: "), F.col("seed"))).when(n == 4, F.lit("[1, 2]")).when(n != 5, said)
    return requests.withColumn("response", text)


def cycle_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents dealt into four cycles."""
    return doc_pairs(spark, sf).withColumn("cycle_id", (F.col("seq") % 4 + 1).cast("int"))


def cycle_judgments(spark: SparkSession, sf: str) -> DataFrame:
    return judge_a(spark, sf).withColumn("cycle_id", (F.col("seq") % 4 + 1).cast("int"))


def cache(spark: SparkSession, sf: str) -> DataFrame:
    """Stored judgments of the labelled documents, by cache key."""
    return cache_rows(judge_b(spark, sf), BUILTIN, BACKEND, MODEL)


def predictions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Predictions for the benchmark: right but for case in three of four items."""
    items = table(spark, sf, "benchmark")
    wrong = F.concat(F.col("text"), F.lit(" x"))
    made = items.select("item_id", F.when(F.col("item_id") % 4 != 0, F.concat(F.lit(" "), F.translate("text", LOWER, LOWER.upper()))).otherwise(wrong).alias("prediction"))
    return made, items.select("item_id", F.col("text").alias("reference"))
