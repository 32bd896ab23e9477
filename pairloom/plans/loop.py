"""The closed loop: seeds to pairs to verdicts, the failures of a cycle seeding the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from pairloom.operators import cycles, export, generate, judge
from pairloom.session import configure, stage
from pairloom.sources.store import DatasetStore

# Adds the column response to the requests, or returns (seq, response); a seed without an answer is a failed generation.
Generator = Callable[[DataFrame], DataFrame]


def cycle_seeds(store: DatasetStore, base: DataFrame, cycle_id: int, loop_run: int = 1,
                failure_limit: int = cycles.FAILURE_SEEDS) -> DataFrame:
    """The base seeds, and from the second cycle on the failures of the one before."""
    if cycle_id == 1:
        return cycles.next_seeds(base, None)
    before = {k: store.find(k, loop_run=loop_run, cycle_id=cycle_id - 1) for k in ("cycle_pairs", "cycle_judgments")}
    if None in before.values():
        return cycles.next_seeds(base, None)
    return cycles.next_seeds(base, cycles.failure_seeds(before["cycle_pairs"], before["cycle_judgments"], failure_limit))


def run_cycle(store: DatasetStore, base: DataFrame, cycle_id: int, generator: Generator, scorer: judge.Scorer,
              template: str = generate.DEFAULT_TEMPLATE, rubric: judge.Rubric = judge.BUILTIN,
              limits: dict[str, float] | None = None, model: str = "", now: str | None = None, loop_run: int = 1,
              failure_limit: int = cycles.FAILURE_SEEDS) -> DataFrame:
    """One cycle of a run. Seeds, pairs, judgments, training set and metrics each replace the cycle's
    partition of their table, so the next cycle reads tables and not a growing plan."""
    at = {"loop_run": loop_run, "cycle_id": cycle_id}
    seeds = store.put(cycle_seeds(store, base, cycle_id, loop_run, failure_limit), "cycle_seeds", **at).drop(*at)
    answers = generator(generate.generation_requests(seeds, template))
    pairs = _put_pairs(store, seeds, answers, at).drop("loop_run")
    judged = judge.judge(pairs, scorer, rubric, limits, model=model, judged_at=now)
    judged = store.put(judged, "cycle_judgments", **at).drop("loop_run")
    store.put(export.training_set(pairs, judged, stored=True).drop("cycle_id"), "training", **at)
    metrics = cycles.cycle_metrics(pairs, judged)
    return store.put(metrics, "cycle_metrics", **at)


def _put_pairs(store: DatasetStore, seeds: DataFrame, answers: DataFrame, at: dict[str, int]) -> DataFrame:
    """Store a pair for each answer, and a failed one for each seed without.

    Answers that still have their seed become pairs where they are: only places are compared to find seeds without an answer.
    """
    cycle_id = at["cycle_id"]
    if "seed" not in answers.columns:
        return store.put(generate.generated_pairs(seeds, answers, cycle_id), "cycle_pairs", **at)
    pairs = store.put(generate.parse_generated(answers.select("seq", "seed", "response"), cycle_id), "cycle_pairs", **at)
    lost = stage(seeds.select("seq").join(pairs.select("seq"), "seq", "left_anti"), "lost")
    if lost.isEmpty():
        return pairs
    failed = seeds.join(lost, "seq", "left_semi").withColumn("response", F.lit(None).cast("string"))
    return store.put(generate.parse_generated(failed, cycle_id), "cycle_pairs", mode="append", **at)


def run_loop(store: DatasetStore, base: DataFrame, generator: Generator, scorer: judge.Scorer, max_cycles: int = 10,
             stop_below: float = cycles.STOP_BELOW, resume: bool = False, **options) -> DataFrame:
    """Cycles until max_cycles, or until one passes less than the stop limit: the metrics of all.

    Without ``resume`` a new run begins; what older runs stored is not touched. With it the newest
    run goes on after its last stored cycle, unless that one was already below the limit.
    """
    configure(store.spark)
    loop_run = (store.last_run() if resume else 0) or store.begin_run()
    last = store.last_cycle(loop_run)
    stopped = last > 0 and _pass_rate(store.get("cycle_metrics", loop_run=loop_run, cycle_id=last)) < stop_below
    while last < max_cycles and not stopped:
        last += 1
        stopped = _pass_rate(run_cycle(store, base, last, generator, scorer, loop_run=loop_run, **options)) < stop_below
    return store.cycles("cycle_metrics", upto=last, loop_run=loop_run)


def _pass_rate(metrics: DataFrame) -> float:
    row = metrics.select("pass_rate").first()
    return -1.0 if row is None else row.pass_rate
