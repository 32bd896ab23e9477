"""The curation job: ingest, validate, judge, label, export, visualize, compare, calibrate.

A job is a dataset name and an ordered list of one-key steps, as a dict. Each step writes its
result to the store, so later steps read a table instead of recomputing, and a lost executor
costs only the step that was running.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pairloom.operators import checks, compare, evaluate, export, ingest, judge, labels, profile
from pairloom.session import configure, scratch, stage
from pairloom.sources.readers import read_rows, source_kind
from pairloom.sources.store import DatasetStore, write_pairs


@dataclass
class Job:
    """State of a running job: the store, named scorers, and each step's result tables."""

    spark: SparkSession
    store: DatasetStore
    dataset: str
    scorers: dict[str, judge.Scorer] = field(default_factory=lambda: {"rule": judge.rule_scorer})
    now: str | None = None
    results: dict[str, DataFrame] = field(default_factory=dict)
    judge_tag: str | None = None

    def part(self, kind: str, **more) -> DataFrame:
        return self.store.get(kind, dataset=self.dataset, **more)

    def find(self, kind: str, **more) -> DataFrame | None:
        return self.store.find(kind, dataset=self.dataset, **more)

    def run_of(self, spec: Any) -> DataFrame | None:
        """Judgments named by a step: a tag, or 'auto' for the last judge step's."""
        if spec in (None, False):
            return None
        tag = self.judge_tag if spec in ("auto", True) else spec
        return None if tag is None else judge.latest_judgments(self.part("judgments", tag=tag))

    def latest_labels(self) -> DataFrame | None:
        log = self.find("labels")
        return None if log is None else labels.latest_labels(log)


def step_ingest(job: Job, spec: dict) -> DataFrame:
    source = spec["input"]
    if isinstance(source, DataFrame):
        raw, kind = source, "table"
    else:
        raw = read_rows(job.spark, source, spec.get("format", "auto"), spec.get("split"))
        kind = source_kind(source, spec.get("format", "auto"))
    if spec.get("dry_run"):
        return ingest.preview(raw)
    # Once: text sources are parsed, and tables may be derived, by work that finding the first copies would repeat.
    pairs = ingest.ingest(raw, spec.get("map"), spec.get("tag"), spec.get("limit"), job.now, stage=stage)
    stored = job.store.put(pairs, "pairs", dataset=job.dataset)
    meta = ingest.dataset_meta(stored, job.dataset, kind, spec.get("tag"), spec.get("map"), job.now)
    return evaluate.list_datasets(job.store.put(meta, "meta", dataset=job.dataset))


def step_validate(job: Job, spec: dict) -> DataFrame:
    pairs = job.part("pairs")
    options = checks.Options(
        spec.get("min_instruction_len", 3), spec.get("max_output_len", 8000), spec.get("pii") or "warn",
        spec.get("lang"), spec.get("lang_column"), flagged_words=spec.get("flagged_words"))
    facts = job.store.put(checks.check_facts(pairs, spec.get("checks", checks.DEFAULT_CHECKS), options), "facts", dataset=job.dataset)
    report = job.store.put(checks.report(facts), "reports", dataset=job.dataset)
    if spec.get("write_clean"):
        name = spec["write_clean"] if isinstance(spec["write_clean"], str) else f"{job.dataset}.clean"
        job.store.put(checks.clean(pairs, facts).drop("dataset"), "pairs", dataset=name)
    gate = spec.get("fail_on", "never")
    if gate != "never":
        outcome = checks.quality_gate(facts, gate).first()
        if not outcome.passed:
            raise ValueError(f"{outcome.errors} error(s), {outcome.warnings} warning(s) found")
    return report


def step_judge(job: Job, spec: dict) -> DataFrame:
    tag = spec.get("tag")
    job.judge_tag = tag
    rubric = spec.get("rubric", judge.DEFAULT)
    backend = spec.get("backend", "rule")
    pairs = judge.sample_pairs(job.part("pairs"), spec.get("sample"), spec.get("max_pairs")).drop("dataset")
    model = spec.get("model", backend)
    # One cache for all datasets; a partition holds what one rubric, backend and model said.
    own = {"cache_rubric": rubric.name, "cache_version": rubric.version, "cache_backend": backend, "cache_model": model}
    cache = None if spec.get("no_cache") else job.store.find("judgment_cache", **own)
    scorer = job.scorers[backend]
    run = tag or backend
    if cache is None:
        scored = judge.judge(pairs, scorer, rubric, spec.get("thresholds"), tag, model, job.now)
        kept = job.store.put(scored, "judgments", dataset=job.dataset, tag=run)
        fresh = judge.cache_rows(kept, rubric, backend, model)
    else:
        once = lambda df: job.store.put(df, "scored", dataset=job.dataset, run=run).drop("dataset", "run")
        stamp = (cache.agg(F.max("written")).first()[0] or 0) + 1
        merged = judge.judge_incremental(pairs, cache.drop(*own), scorer, rubric, backend, model, spec.get("thresholds"),
                                         tag, job.now, stage=once, written=stamp)
        kept, fresh = job.store.put(merged.judgments, "judgments", dataset=job.dataset, tag=run), merged.fresh
    if not spec.get("no_cache"):
        job.store.put(fresh, "judgment_cache", mode="append", **own)
    return judge.run_summary(kept)


def step_label(job: Job, spec: dict) -> DataFrame:
    mode = spec["mode"]
    judged, current = job.run_of(spec.get("judgments")), job.latest_labels()
    if mode == "auto-from-judge":
        if judged is None:
            raise ValueError("judgments are required for auto-from-judge")
        new = labels.auto_label(judged, spec.get("reject_below", labels.REJECT_BELOW), labeled_at=job.now)
    elif mode == "bulk":
        if not spec.get("where") or not spec.get("set_status"):
            raise ValueError("where and set_status are required for bulk mode")
        new = labels.bulk_label(job.part("pairs"), spec["where"], spec["set_status"], judged, current,
                                spec.get("tag"), spec.get("note"), job.now)
    elif mode == "interactive":
        return labels.review_queue(job.part("pairs"), judged, current, bool(spec.get("resume")))
    else:
        raise ValueError(f"unknown label mode: {mode}")
    if spec.get("resume") and current is not None:
        new = labels.resume_labels(new, current)
    # Later label steps come after earlier ones: the step's number leads the order.
    log = job.find("labels")
    last = None if log is None else log.agg(F.max("seq.step")).first()[0]
    step = 0 if last is None else last + 1   # the log may exist and be empty
    ordered = new.withColumn("seq", F.struct(F.lit(step).alias("step"), F.col("seq").cast("string").alias("at"), F.col("pair_id").alias("pair")))
    ordered = ordered.select("seq", *[c for c in ordered.columns if c != "seq"])
    job.store.put(ordered, "labels", mode="append", dataset=job.dataset)
    written = job.part("labels").filter(F.col("seq.step") == step)
    return written.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def step_export(job: Job, spec: dict) -> DataFrame:
    pairs = job.part("pairs").drop("dataset")
    # The filter and its joins run once, over narrow columns; places and splits then pick the whole rows.
    chosen = export.filter_pairs(pairs, spec.get("filter"), job.run_of(spec.get("judgments")), job.latest_labels())
    keys = job.store.put(chosen.select("seq", "id"), "chosen", dataset=job.dataset).drop("dataset")
    ratios = spec.get("split") or {}
    ratios = export.parse_split(ratios) if isinstance(ratios, str) else ratios
    places = job.store.put(export.ratio_split(keys, ratios, spec.get("seed", 42)), "splits", dataset=job.dataset).drop("dataset")
    assigned = pairs.join(places.select("seq", "split"), "seq")
    if spec.get("to"):
        write_pairs(assigned if ratios else assigned.drop("split"), spec["to"], spec.get("format", "jsonl"))
    else:
        job.store.put(assigned, "exports", dataset=job.dataset)
    return export.split_sizes(places)


def step_visualize(job: Job, spec: dict) -> DataFrame:
    """All chart data in long form (chart, series, x, y)."""
    pairs, log = job.part("pairs"), job.find("labels")
    judged = job.find("judgments")
    long = lambda df, chart, series, x, y: df.select(
        F.lit(chart).alias("chart"), series.cast("string").alias("series"), x.cast("string").alias("x"), y.cast("double").alias("y"))
    none = F.lit(None)
    parts = [
        long(profile.top_categories(pairs), "categories", none, F.col("category"), F.col("n")),
        long(profile.length_histograms(pairs), "lengths", F.col("field"), F.col("bin"), F.col("n")),
    ]
    if (report := job.find("reports")) is not None:
        parts.append(long(profile.ranked_issues(report), "validation", none, F.col("check"), F.col("n")))
    if judged is not None:
        parts += [
            long(profile.pass_fail_counts(judged), "pass_fail", none, F.col("outcome"), F.col("n")),
            long(profile.score_histogram(judged), "scores", none, F.col("bin"), F.col("n")),
            long(profile.criterion_means(judged), "criteria", none, F.col("criterion"), F.col("mean")),
            long(profile.agreement_matrix(judged), "agreement", F.col("a_pass"), F.col("b_pass"), F.col("n")),
        ]
    if log is not None:
        parts.append(long(profile.label_distribution(labels.latest_labels(log)), "labels", none, F.col("status"), F.col("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return job.store.put(out, "charts", dataset=job.dataset)


def step_compare(job: Job, spec: dict) -> DataFrame:
    tags = spec["tags"]
    if len(tags) < 2:
        raise ValueError("compare needs at least two tags")
    judged = job.part("judgments").filter(F.col("tag").isin(tags[:2]))
    return compare.compare_runs(judged, tags[0], tags[1])


def step_calibrate(job: Job, spec: dict) -> DataFrame:
    current = job.latest_labels()
    if current is None:
        raise ValueError("no labels; label some pairs first")
    return compare.calibrate(job.run_of(spec["tag"]), current, spec.get("approved_is", "approved"))


STEPS: dict[str, Callable[[Job, dict], DataFrame]] = {
    "ingest": step_ingest, "validate": step_validate, "judge": step_judge, "label": step_label,
    "export": step_export, "visualize": step_visualize, "compare": step_compare, "calibrate": step_calibrate,
}


def run_job(spark: SparkSession, config: dict, root: str, scorers: dict[str, judge.Scorer] | None = None,
            now: str | None = None) -> Job:
    """Run the steps in order. ``results`` has each step's table under ``<number>.<name>``."""
    if not config.get("dataset"):
        raise ValueError("a job needs a 'dataset'")
    for i, step in enumerate(config.get("steps") or [], 1):
        if not isinstance(step, dict) or len(step) != 1:
            raise ValueError(f"step {i}: one name with its settings is wanted")
        if next(iter(step)) not in STEPS:
            raise ValueError(f"there is no step {next(iter(step))}")
    configure(spark)
    job = Job(spark, DatasetStore(spark, root), config["dataset"], now=now)
    job.scorers.update(scorers or {})
    for i, step in enumerate(config.get("steps") or [], 1):
        (name, spec), = step.items()
        with scratch(spark) if name != "ingest" or not (spec or {}).get("dry_run") else nullcontext():
            job.results[f"{i}.{name}"] = STEPS[name](job, spec or {})
    return job


def dataset_info(job: Job) -> DataFrame:
    """Which artefacts of the dataset exist."""
    kinds = {"pairs": "pairs", "meta": "meta", "validation": "reports", "labels": "labels"}
    return evaluate.inventory(job.dataset, {k: job.find(v) for k, v in kinds.items()}, job.find("judgments"))


def summary(job: Job) -> DataFrame:
    """Every number of every step in long form: (step, item, key, value)."""
    out = None
    for name, df in job.results.items():
        fields = {f.name: f.dataType for f in df.schema if f.name != "dataset"}
        numbers = [c for c, t in fields.items() if isinstance(t, T.NumericType)]
        words = [F.col(f"`{c}`") for c, t in fields.items() if isinstance(t, T.StringType)]
        cells = F.array(*[F.struct(F.lit(c).alias("key"), F.col(f"`{c}`").cast("double").alias("value")) for c in numbers])
        item = F.concat_ws("/", *words) if words else F.lit("")
        rows = df.select(F.lit(name).alias("step"), item.alias("item"), F.explode(cells).alias("c")).select("step", "item", "c.*")
        out = rows if out is None else out.unionByName(rows)
    return out
