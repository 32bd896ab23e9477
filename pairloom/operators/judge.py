"""Judging: requests, scorers, verdicts, incremental runs, summaries."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pairloom.functions.rows import quoted, small_batches
from pairloom.functions.text import UNIT
from pairloom.functions.verdict import FAILED, parse_responses, tier
from pairloom.operators.ordering import cut_values, first_rows, last_wins, shuffle_key
from pairloom.schemas import JUDGMENT
from pairloom.session import stage

Scorer = Callable[[DataFrame], DataFrame]

# --- fixed values: request texts of the shipped rubrics -------------------------------------------
BUILTIN_PROMPT = (
    "Evaluate this instruction-response pair:\n\n"
    "INSTRUCTION:\n{instruction}\n\n"
    "RESPONSE:\n{output}\n\n"
    "Rate 0-10 on coherence, accuracy, helpfulness. Return JSON:\n"
    '{"coherence": X, "accuracy": X, "helpfulness": X, "overall": X, "passed": true/false, '
    '"reasoning": "brief explanation"}'
)
DEFAULT_PROMPT = (
    "Evaluate this instruction-response pair.\n\n"
    "INSTRUCTION:\n{instruction}\n\n"
    "RESPONSE:\n{output}\n\n"
    "Rate 0-10 on coherence, accuracy, helpfulness. Return JSON:\n"
    '{"coherence": X, "accuracy": X, "helpfulness": X, "overall": X,\n'
    ' "passed": true, "reasoning": "brief"}'
)
FACTUALITY_PROMPT = (
    "You are a fact-checking judge. Evaluate whether the RESPONSE is factually\n"
    "correct and directly addresses the INSTRUCTION. Penalize hallucinations\n"
    "harshly; reward citations of verifiable facts.\n\n"
    "INSTRUCTION:\n{instruction}\n\n"
    "RESPONSE:\n{output}\n\n"
    "Return JSON only:\n"
    '{"coherence": X, "accuracy": X, "helpfulness": X, "overall": X,\n'
    ' "passed": true, "reasoning": "brief — cite any factual errors"}'
)
# -------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rubric:
    """What a judge is asked. ``{instruction}`` and ``{output}`` stand for the pair's texts."""

    name: str = "default"
    version: int = 1
    prompt: str = BUILTIN_PROMPT
    temperature: float | None = 0.3
    pass_condition: str | None = None   # optional SQL over the four scores; None: thresholds only
    output_chars: int | None = None     # how much of the output is quoted; None: all of it


BUILTIN = Rubric()
DEFAULT = Rubric(prompt=DEFAULT_PROMPT)
FACTUALITY = Rubric("factuality", 1, FACTUALITY_PROMPT, 0.2)


def render_prompt(rubric: Rubric) -> Column:
    """The request text of a pair. The template is cut at its placeholders, so braces inside
    the pair's own texts are never read as placeholders."""
    before, rest = rubric.prompt.split("{instruction}", 1)
    between, after = rest.split("{output}", 1)
    output = "coalesce(output, '')"
    if rubric.output_chars is not None:
        output = f"substring({output}, 1, {int(rubric.output_chars)})"
    parts = [quoted(before), "coalesce(instruction, '')", quoted(between), output, quoted(after)]
    return F.expr(f"concat({', '.join(parts)})")


def judge_requests(pairs: DataFrame, rubric: Rubric = BUILTIN, order: str = "seq") -> DataFrame:
    """(order, pair_id, prompt, temperature): one request per pair."""
    return pairs.select(order, F.col("id").alias("pair_id"), render_prompt(rubric).alias("prompt"),
                        F.lit(rubric.temperature).cast("double").alias("temperature"))


def sample_pairs(pairs: DataFrame, fraction: float | None = None, max_pairs: int | None = None,
                 seed: int = 42, order: str = "seq") -> DataFrame:
    """Exactly max(1, int(n * fraction)) pairs, then at most max_pairs of them.

    The sample are the pairs with the smallest shuffle keys; a prefix of the sample is
    therefore the same with a smaller size. Without a fraction, max_pairs is a prefix of the rows.
    """
    if fraction is None or not 0 < fraction < 1:
        return pairs if max_pairs is None else first_rows(pairs, max_pairs, order)
    if max_pairs is not None and max_pairs <= 0:
        return pairs.filter(F.lit(False))
    key = shuffle_key(seed, order=order)

    def size(n: Column) -> Column:
        k = F.greatest(F.lit(1).cast("bigint"), (n * F.lit(float(fraction))).cast("bigint"))
        return k if max_pairs is None else F.least(k, F.lit(max_pairs).cast("bigint"))

    cut = cut_values(pairs.select(key.alias("key")), [size]).scalar()
    return pairs.filter(key <= cut[0])


def cache_key(rubric: Rubric, backend: str, model: str, pair_id: Column | str = "pair_id") -> Column:
    """sha256 (hex) of everything a judgment depends on."""
    pair_id = F.col(pair_id) if isinstance(pair_id, str) else pair_id
    rest = [rubric.name, str(rubric.version), backend, model]
    return F.sha2(F.concat_ws(UNIT, pair_id, *[F.lit(x) for x in rest]), 256)


def judge(pairs: DataFrame, scorer: Scorer, rubric: Rubric = BUILTIN, limits: dict[str, float] | None = None,
          tag: str | None = None, model: str = "", judged_at: str | None = None, order: str = "seq") -> DataFrame:
    """Ask the scorer about every pair and parse what it answers; no answer is a failure row.

    A scorer adds the column ``response`` to the requests and returns every one of them, with NULL where it has
    no answer; a column ``error`` may say why. Every request is asked once only if what it returns is stored.
    """
    answers = scorer(judge_requests(pairs, rubric, order))
    missing = {order, "pair_id", "response"} - set(answers.columns)
    if missing:
        raise ValueError(f"the scorer lost the columns {sorted(missing)}")
    if "error" not in answers.columns:
        return verdicts(answers.select(order, "pair_id", "response"), rubric, limits, tag, model, judged_at)
    judged = verdicts(answers.select(order, "pair_id", "response", "error"), rubric, limits, tag, model, judged_at)
    told = F.when(F.col("error").isNotNull(), F.concat(F.lit(f"{FAILED}: "), F.col("error")))
    return judged.withColumn("judgment_reasoning", F.coalesce(told, "judgment_reasoning")).drop("error")


def verdicts(responses: DataFrame, rubric: Rubric = BUILTIN, limits: dict[str, float] | None = None,
             tag: str | None = None, model: str = "", judged_at: str | None = None) -> DataFrame:
    """Response texts to judgment records."""
    parsed = parse_responses(responses, limits=limits)
    if rubric.pass_condition:
        by_rule = F.expr(rubric.pass_condition)
        flat = parsed.select("*", "scores.*").withColumn("passed", F.coalesce(by_rule, F.lit(False)) & ~is_failure())
        parsed = flat.select(*parsed.columns)
    keep = [c for c in responses.columns if c not in ("pair_id", "response")]
    return parsed.select(
        *keep, "pair_id", "scores", "passed", F.lit(model).alias("judge_model"), "judgment_reasoning",
        F.lit(judged_at).cast("timestamp").alias("judged_at"),
        F.struct(F.lit(rubric.name).alias("name"), F.lit(rubric.version).alias("version")).alias("rubric"),
        F.lit(tag).cast("string").alias("tag"),
    )


def is_failure(reasoning: str = "judgment_reasoning") -> Column:
    """Judgments that carry an error instead of an opinion."""
    return F.coalesce(F.col(reasoning).startswith(f"{FAILED}:"), F.lit(False))


def cache_rows(scored: DataFrame, rubric: Rubric, backend: str, model: str, written: int = 0) -> DataFrame:
    """Judgments as cache rows: the key, the judgment and the write stamp; failures are left out."""
    names = [f.name for f in JUDGMENT if f.name != "tag"]
    return scored.filter(~is_failure()).select(
        cache_key(rubric, backend, model).alias("key"), *names, F.lit(written).cast("bigint").alias("written"))


@dataclass
class IncrementalRun:
    judgments: DataFrame   # every pair, from the cache or fresh
    fresh: DataFrame       # new cache rows: key and judgment
    stats: DataFrame       # one row: hits, misses, writes


def judge_incremental(pairs: DataFrame, cache: DataFrame, scorer: Scorer, rubric: Rubric = BUILTIN,
                      backend: str = "", model: str = "", limits: dict[str, float] | None = None,
                      tag: str | None = None, judged_at: str | None = None, enabled: bool = True, order: str = "seq",
                      stage: Callable[[DataFrame], DataFrame] = stage, written: int = 0) -> IncrementalRun:
    """Judge only what the cache does not hold.

    ``cache`` has the columns of ``cache_rows`` and serves any number of datasets: it knows no row order, only ``key`` and
    the stamp ``written``, whose largest value counts. Hits keep their judgment and take this run's tag; misses are
    scored, and all but failures are new cache rows with this run's stamp. Only ids and row places meet
    the cache; the texts of the misses follow by place. Of the cache, keys and stamps are aggregated; whole judgments are
    taken for the hits alone. The misses are staged, so the scorer runs once. Every side of a join grows with the pairs or the
    cache, so none is broadcast, however small it looks: what the driver holds does not grow.
    """
    apart = lambda df: df.hint("merge")
    keyed = pairs.select(order, F.col("id").alias("pair_id"), cache_key(rubric, backend, model, F.col("id")).alias("key"))
    cache = cache if enabled else cache.filter(F.lit(False))
    stamps = cache.groupBy("key").agg(F.max("written").alias("written"))
    missing = keyed.join(apart(stamps), "key", "left_anti")
    # Where the cache holds everything, no text is moved to learn it.
    asked = pairs.join(apart(missing.select(order)), order, "left_semi") if not missing.isEmpty() else pairs.filter(F.lit(False))
    scored = stage(judge(asked, scorer, rubric, limits, tag, model, judged_at, order))
    wanted = stamps.join(apart(keyed.select("key")), "key", "left_semi")
    kept = cache.join(apart(wanted), ["key", "written"], "left_semi").dropDuplicates(["key"]).drop("pair_id", "written")
    hits = keyed.join(apart(kept), "key").withColumn("tag", F.lit(tag).cast("string"))
    judgments = hits.select(*scored.columns).unionByName(scored)
    fresh = cache_rows(scored, rubric, backend, model, written)
    fresh = fresh if enabled else fresh.filter(F.lit(False))
    one = lambda df, name: df.select(F.lit(name).alias("k"))
    events = one(hits, "hits").unionByName(one(scored, "misses")).unionByName(one(fresh, "writes"))
    stats = events.agg(*[F.count_if(F.col("k") == k).alias(k) for k in ("hits", "misses", "writes")])
    return IncrementalRun(judgments, fresh, stats)


def run_summary(judgments: DataFrame) -> DataFrame:
    """One row: judged, passed, pass share, failures and the mean overall of the rest."""
    n, passed = F.count(F.lit(1)), F.count_if("passed")
    return judgments.agg(
        n.alias("judged"), passed.alias("passed"),
        (passed / F.greatest(n, F.lit(1))).alias("pass_share"),
        F.count_if(is_failure()).alias("failures"),
        F.coalesce(F.avg(F.when(~is_failure(), F.col("scores.overall"))), F.lit(0.0)).alias("avg_overall"),
    )


def latest_judgments(judgments: DataFrame, order: str = "seq") -> DataFrame:
    """The last judgment of each pair."""
    return last_wins(judgments, "pair_id", order)


def flag_passed(pairs: DataFrame, judgments: DataFrame, order: str = "seq") -> DataFrame:
    """Pairs with the verdict of their last judgment; a pair without one has not passed."""
    last = judgments.groupBy("pair_id").agg(F.max_by("passed", order).alias("passed"))
    joined = pairs.join(last.withColumnRenamed("pair_id", "id"), "id", "left")
    return joined.withColumn("passed", F.coalesce("passed", F.lit(False)))


def with_tier(judgments: DataFrame) -> DataFrame:
    return judgments.withColumn("quality_tier", tier())


def fill_scores(judgments: DataFrame) -> DataFrame:
    """Stored judgments with partial scores: a missing criterion has the overall score, else 5."""
    s = F.col("scores")
    overall = F.coalesce(s["overall"], F.lit(5.0))
    filled = [F.coalesce(s[n], overall).alias(n) for n in ("coherence", "accuracy", "helpfulness")]
    return judgments.withColumn("scores", F.struct(*filled, overall.alias("overall")))


# ----- scorers -----

def rule_scorer(requests: DataFrame) -> DataFrame:
    """An offline scorer for dry runs: scores grow with the length of the request.

    Works in tenths of a point: coherence is the request's length in units of 20 characters,
    accuracy the remainder of its length by 101, helpfulness the mean of both, all at most 10.
    """
    n = "length(prompt)"
    c, a = f"least({n} div 20, 100)", f"{n} % 101"
    h = f"(({c} + {a}) div 2)"
    tenths = lambda x: f"concat(CAST(({x}) div 10 AS STRING), '.', CAST(({x}) % 10 AS STRING))"
    response = (f"""concat('{{"coherence": ', {tenths(c)}, ', "accuracy": ', {tenths(a)}, """
                f"""', "helpfulness": ', {tenths(h)}, ', "reasoning": "rule"}}')""")
    return requests.withColumn("response", F.expr(response))


Answer = Callable[[list[str], float | None], Iterable[str | None]]


def python_scorer(answer: Answer, tasks: int | None = None) -> Scorer:
    """A scorer from a Python function: a batch of prompts in, as many response texts (or None) out.

    A batch has about a megabyte of prompts, or one prompt. Runs in every task over Arrow batches; the number of requests in flight is the number of tasks. An error
    of the function never fails the job; its type and message go into ``error``. If the function yields its answers one
    by one, those before the error stay and only the prompt at which it occurred fails; if it fails before
    any answer, the prompts are asked one by one. The function that runs on the workers needs nothing of this package.
    """

    def score(requests: DataFrame) -> DataFrame:
        keep = [c for c in requests.columns if c not in ("prompt", "temperature")]
        schema = T.StructType([*(requests.schema[c] for c in keep), T.StructField("response", T.StringType()),
                               T.StructField("error", T.StringType())])

        def ask(prompts: list, temperature: float | None) -> list:
            done: list = []
            alone = False   # the rest is asked one by one
            while len(done) < len(prompts):
                some = prompts[len(done):len(done) + 1] if alone else prompts[len(done):]
                before, error = len(done), None
                try:
                    for given in answer(some, temperature):
                        done.append((given, None))
                        if len(done) - before == len(some):
                            break
                except Exception as e:  # any error of the caller's function is a failed answer
                    error = f"{type(e).__name__}: {e}"
                if len(done) - before == len(some):
                    continue
                if len(some) == 1 or (error and len(done) > before):
                    done.append((None, error))
                else:
                    alone = True
            return done

        small = small_batches()

        def run(batches):
            import pyarrow as arrow

            for batch in small(batches):
                if batch.num_rows:
                    temperature = batch.column("temperature")[0].as_py()
                    told = ask(batch.column("prompt").to_pylist(), temperature)
                    columns = [*(batch.column(c) for c in keep), arrow.array([t for t, _ in told], arrow.string()),
                               arrow.array([e for _, e in told], arrow.string())]
                    yield arrow.RecordBatch.from_arrays(columns, names=[*keep, "response", "error"])

        spread = requests.repartition(tasks) if tasks else requests
        return spread.mapInArrow(run, schema)

    return score
