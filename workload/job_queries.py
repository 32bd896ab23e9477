"""Cycles, the closed loop and the whole curation job."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.operators import cycles, judge
from pairloom.plans import curate, loop
from pairloom.session import new_folder
from pairloom.sources.store import DatasetStore
from workload import inputs as I
from workload.registry import query, r6
from workload.sqltext import (COUNTS, CYCLES, DIRTY, DOCS, cut_split, generated, issues_of, pair_hash, pair_id, rule_run, share, strip)

_RATES = ["pass_rate", "avg_quality", "avg_coherence", "avg_accuracy", "avg_helpfulness", "avg_overall"]
_R6 = ", ".join(f"round({c}, 6) AS {c}" for c in _RATES)


def _metrics(spark, sf) -> DataFrame:
    return cycles.cycle_metrics(I.cycle_pairs(spark, sf), I.cycle_judgments(spark, sf))


# ----- cycles -----

_FAILED_SEEDS = """fs AS (SELECT j.seq, p.instruction AS seed FROM cj j JOIN cp p ON p.id = j.pair_id AND p.cycle_id = j.cycle_id
  WHERE j.cycle_id = 2 AND NOT j.passed AND p.instruction <> '' ORDER BY j.seq LIMIT 10)"""


@query("K2", f"WITH {CYCLES}, {_FAILED_SEEDS} SELECT seq, seed FROM fs")
def failure_seeds(spark, sf):
    return cycles.failure_seeds(I.cycle_pairs(spark, sf).filter("cycle_id = 2"), I.cycle_judgments(spark, sf).filter("cycle_id = 2"))


@query("K3", f"""WITH {CYCLES}, {_FAILED_SEEDS}, base AS (SELECT seq, completion AS seed FROM docs)
SELECT seq, seed FROM base UNION ALL
SELECT (SELECT max(seq) FROM base) + row_number() OVER (ORDER BY seq), seed FROM fs""")
def next_cycle_seeds(spark, sf):
    return cycles.next_seeds(I.seeds(spark, sf), failure_seeds(spark, sf))


@query("K4", f"WITH {CYCLES} SELECT cycle_id, generated, passed, failed, {_R6} FROM metrics")
def cycle_metrics(spark, sf):
    return _metrics(spark, sf).select("cycle_id", "generated", "passed", "failed", *[r6(c) for c in _RATES])


@query("K7", f"""WITH {CYCLES} SELECT count(*) AS total_cycles, CAST(sum(passed) AS BIGINT) AS total_passed_pairs,
  round(avg(pass_rate), 6) AS avg_pass_rate FROM metrics""")
def loop_summary(spark, sf):
    return cycles.loop_summary(_metrics(spark, sf)).select("total_cycles", "total_passed_pairs", r6("avg_pass_rate"))


@query("K8", f"""WITH {CYCLES} SELECT count(*) AS total_cycles, CAST(sum(generated) AS BIGINT) AS total_generated, CAST(sum(passed) AS BIGINT) AS total_passed,
  CAST(sum(failed) AS BIGINT) AS total_failed, round(avg(pass_rate) * 100, 6) AS avg_pass_rate_pct, round(avg(avg_quality), 6) AS avg_quality,
  (SELECT cycle_id FROM metrics ORDER BY pass_rate DESC, cycle_id LIMIT 1) AS best_cycle FROM metrics""")
def report_totals(spark, sf):
    t = cycles.report_totals(_metrics(spark, sf))
    return t.select("total_cycles", "total_generated", "total_passed", "total_failed", r6("avg_pass_rate_pct"), r6("avg_quality"), "best_cycle")


@query("K8", f"""WITH {CYCLES} SELECT cycle_id, round(pass_rate * 100, 6) AS pass_rate_pct,
  CASE WHEN pass_rate * 100 >= 70 THEN 'high' WHEN pass_rate * 100 >= 40 THEN 'medium' ELSE 'low' END AS pass_rate_class,
  round(avg_quality, 6) AS avg_quality, round(avg_coherence, 6) AS coherence, round(avg_accuracy, 6) AS accuracy,
  round(avg_helpfulness, 6) AS helpfulness, round(avg_overall, 6) AS overall FROM metrics""")
def report_cycles(spark, sf):
    c = cycles.report_cycles(_metrics(spark, sf))
    return c.select("cycle_id", r6("pass_rate_pct"), "pass_rate_class", r6("avg_quality"),
                    *[r6(x) for x in ("coherence", "accuracy", "helpfulness", "overall")])


@query("K9", f"""WITH {CYCLES} SELECT 'summary' AS section, 0 AS position, count(*) AS cycles, CAST(sum(passed) AS BIGINT) AS passed,
  round(avg(pass_rate), 6) AS rate FROM metrics
UNION ALL SELECT 'cycle', cycle_id, NULL, passed, round(pass_rate, 6) FROM metrics""")
def json_report(spark, sf):
    """The JSON documents, read back field by field."""
    d = cycles.json_report(_metrics(spark, sf)).withColumn("v", F.parse_json("document"))
    field = lambda name, t: F.try_variant_get("v", f"$.{name}", t)
    return d.select("section", "position", field("total_cycles", "bigint").alias("cycles"),
                    F.coalesce(field("total_passed_pairs", "bigint"), field("passed", "bigint")).alias("passed"),
                    r6(F.coalesce(field("avg_pass_rate", "double"), field("pass_rate", "double")), "rate"))


# ----- the closed loop -----

_LIMITS = {"overall": 2.5, "coherence": 1.0, "accuracy": 2.0, "helpfulness": 2.0}
_MAX_CYCLES = 3


def _loop_sql() -> str:
    """The loop unrolled: a cycle after the first takes part while the one before reached the stop limit."""
    ctes = [DOCS, "seeds1 AS (SELECT seq, completion AS seed FROM docs)"]
    for k in range(1, _MAX_CYCLES + 1):
        if k > 1:
            ctes.append(f"""fail{k} AS (SELECT j.seq, p.instruction AS seed FROM run{k - 1} j JOIN pairs{k - 1} p ON p.seq = j.seq
  WHERE NOT j.passed AND p.instruction <> '' ORDER BY j.seq LIMIT 10), seeds{k} AS (
  SELECT seq, completion AS seed FROM docs UNION ALL
  SELECT (SELECT max(seq) FROM docs) + row_number() OVER (ORDER BY seq), seed FROM fail{k})""")
        ctes.append(generated(f"seeds{k}", f"pairs{k}"))
        ctes.append(rule_run(f"pairs{k}", f"run{k}", judge.BUILTIN.prompt, (2.5, 1, 2, 2)))
        go = f"(SELECT pass_rate >= 0.1 FROM m{k - 1})" if k > 1 else "true"
        ctes.append(f"""m{k} AS (SELECT {k} AS cycle_id, count(*) AS generated, count(*) FILTER (passed) AS passed,
  count(*) FILTER (NOT passed) AS failed, count(*) FILTER (passed) / count(*) AS pass_rate, avg(overall) AS avg_quality FROM run{k} HAVING {go})""")
    rows = " UNION ALL ".join(
        f"SELECT cycle_id, generated, passed, failed, round(pass_rate, 6) AS pass_rate, round(avg_quality, 6) AS avg_quality FROM m{k}"
        for k in range(1, _MAX_CYCLES + 1))
    return f"WITH {', '.join(ctes)} {rows}"


@query("K5 K6 A15", _loop_sql())
def closed_loop(spark, sf):
    store = DatasetStore(spark, new_folder(spark, "loop"))
    metrics = loop.run_loop(store, I.seeds(spark, sf), I.generated_texts, judge.rule_scorer, _MAX_CYCLES, limits=_LIMITS)
    return metrics.select("cycle_id", "generated", "passed", "failed", r6("pass_rate"), r6("avg_quality"))


# ----- the whole job -----

JOB = {
    "dataset": "docs",
    "steps": [
        {"ingest": {"tag": "web"}},
        {"validate": {"checks": ["schema", "length", "dedup", "pii"], "write_clean": True}},
        {"judge": {"tag": "a", "thresholds": {"overall": 4.0, "coherence": 2.0, "accuracy": 2.0, "helpfulness": 2.0}}},
        {"judge": {"tag": "b", "rubric": judge.FACTUALITY, "thresholds": {"overall": 4.0, "coherence": 2.0, "accuracy": 2.0, "helpfulness": 2.0}}},
        {"label": {"mode": "auto-from-judge", "judgments": "a"}},
        {"label": {"mode": "bulk", "where": "category IN ('src1', 'src2')", "set_status": "approved", "tag": "trusted", "resume": True}},
        {"export": {"filter": "scores.overall >= 3.5 AND label.status = 'approved'", "judgments": "auto", "split": {"train": 0.8, "val": 0.1, "test": 0.1}}},
        {"compare": {"tags": ["a", "b"]}},
        {"calibrate": {"tag": "b"}},
        {"judge": {"tag": "a2", "thresholds": {"overall": 4.0, "coherence": 2.0, "accuracy": 2.0, "helpfulness": 2.0}}},
        {"visualize": {}},
    ],
}


def run_documents(spark, sf) -> curate.Job:
    steps = [{k: (v | {"input": I.raw_dirty(spark, sf)} if k == "ingest" else v)} for step in JOB["steps"] for k, v in step.items()]
    return curate.run_job(spark, JOB | {"steps": steps}, new_folder(spark, "job"))


def _job_sql() -> str:
    limits = (4, 2, 2, 2)
    summary = lambda step, run: f"""SELECT '{step}' AS step, '' AS item, key, value FROM (UNPIVOT (SELECT CAST(count(*) AS DOUBLE) AS judged,
    CAST(count(*) FILTER (passed) AS DOUBLE) AS passed, count(*) FILTER (passed) / count(*) AS pass_share, CAST(0 AS DOUBLE) AS failures,
    avg(overall) AS avg_overall FROM {run}) ON COLUMNS(*) INTO NAME key VALUE value)"""
    judged = "(SELECT * FROM ra UNION ALL SELECT * FROM rb UNION ALL SELECT * FROM ra)"
    lengths = lambda c: f"""SELECT '11.visualize' AS step, 'lengths/{c}/' || b.bin AS item, 'y' AS key, CAST(count(x) AS DOUBLE) AS value
    FROM (SELECT unnest(range(20)) AS bin) b CROSS JOIN (SELECT CAST(min(length({c})) AS DOUBLE) AS lo, CAST(max(length({c})) AS DOUBLE) AS hi FROM pairs) e
    LEFT JOIN (SELECT CAST(length({c}) AS DOUBLE) AS x FROM pairs) d ON least(floor((x - lo) * 20 / (hi - lo)), 19) = b.bin GROUP BY b.bin"""
    return f"""WITH {DIRTY}, raw AS (SELECT seq, {strip('prompt')} AS i, {strip('completion')} AS o, topic FROM dirty), pairs AS (
  SELECT seq, {pair_id('i', 'o')} AS id, i AS instruction, o AS output, topic AS category FROM raw WHERE i <> '' OR o <> ''
  QUALIFY row_number() OVER (PARTITION BY i, o ORDER BY seq) = 1), {issues_of('pairs')}, {COUNTS},
  {rule_run('pairs', 'ra', judge.DEFAULT.prompt, limits)}, {rule_run('pairs', 'rb', judge.FACTUALITY.prompt, limits)}, auto AS (
  SELECT pair_id, CASE WHEN passed THEN 'approved' WHEN overall < 3.5 THEN 'rejected' ELSE 'needs_edit' END AS status FROM ra), final AS (
  SELECT p.*, CASE WHEN category IN ('src1', 'src2') THEN 'approved' ELSE a.status END AS status FROM pairs p JOIN auto a ON a.pair_id = p.id), chosen AS (
  SELECT f.* FROM final f JOIN rb ON rb.pair_id = f.id WHERE rb.overall >= 3.5 AND f.status = 'approved'),
  {cut_split('chosen', ['train', 'val', 'test'], [share(0.8), share(0.1)])}, ab AS (
  SELECT ra.passed AS ap, rb.passed AS bp, ra.overall AS ao, rb.overall AS bo FROM ra JOIN rb USING (pair_id)), agree AS (
  SELECT count(*) AS n, avg(CASE WHEN ap = bp THEN 1.0 ELSE 0 END) AS po, avg(CASE WHEN ap THEN 1.0 ELSE 0 END) AS pa,
    avg(CASE WHEN bp THEN 1.0 ELSE 0 END) AS pb, corr(ao, bo) AS r, count(*) FILTER (ap) AS pas, count(*) FILTER (bp) AS pbs,
    avg(ao) AS am, avg(bo) AS bm FROM ab), kap AS (
  SELECT *, (po - (pa * pb + (1 - pa) * (1 - pb))) / (1 - (pa * pb + (1 - pa) * (1 - pb))) AS k FROM agree), comparison AS (
  SELECT 'a/b/' || CASE WHEN k < 0 THEN 'below chance' WHEN k < .2 THEN 'poor' WHEN k < .4 THEN 'fair' WHEN k < .6 THEN 'moderate'
    WHEN k < .8 THEN 'substantial' ELSE 'near-perfect' END AS item, CAST(n AS DOUBLE) AS n_common, po AS pass_agreement, k AS cohens_kappa,
    r AS score_pearson, CAST(pas AS DOUBLE) AS a_passed, CAST(pbs AS DOUBLE) AS b_passed, am AS a_mean, bm AS b_mean FROM kap), truth AS (
  SELECT rb.passed AS pred, f.status = 'approved' AS t FROM rb JOIN final f ON f.id = rb.pair_id), cm AS (
  SELECT count(*) AS n, count(*) FILTER (pred AND t) AS tp, count(*) FILTER (pred AND NOT t) AS fp, count(*) FILTER (NOT pred AND NOT t) AS tn,
    count(*) FILTER (NOT pred AND t) AS fn FROM truth), calib AS (
  SELECT CAST(n AS DOUBLE) AS n_evaluated, CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(tn AS DOUBLE) AS tn, CAST(fn AS DOUBLE) AS fn,
    coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, (tp + tn) / n AS accuracy FROM cm), every AS (
  SELECT '1.ingest' AS step, 'docs/table/web' AS item, 'pairs' AS key, CAST(count(*) AS DOUBLE) AS value FROM pairs
  UNION ALL SELECT '2.validate', key, 'n', n FROM counts
  UNION ALL SELECT '2.validate', 'total_pairs', 'n', count(*) FROM pairs
  UNION ALL {summary('3.judge', 'ra')} UNION ALL {summary('4.judge', 'rb')}
  UNION ALL SELECT '5.label', status, 'n', count(*) FROM auto GROUP BY status
  UNION ALL SELECT '6.label', 'approved', 'n', count(*) FROM pairs WHERE category IN ('src1', 'src2')
  UNION ALL SELECT '7.export', split, 'n', count(*) FROM splits GROUP BY split
  UNION ALL SELECT '8.compare', item, key, value FROM (UNPIVOT comparison ON COLUMNS(* EXCLUDE item) INTO NAME key VALUE value)
  UNION ALL SELECT '9.calibrate', '', key, value FROM (UNPIVOT calib ON COLUMNS(*) INTO NAME key VALUE value)
  UNION ALL {summary('10.judge', 'ra')}
  UNION ALL SELECT '11.visualize', 'categories/' || category, 'y', n FROM (
    SELECT category, count(*) AS n FROM pairs GROUP BY category ORDER BY n DESC, min(seq) LIMIT 20)
  UNION ALL {lengths('instruction')} UNION ALL {lengths('output')}
  UNION ALL SELECT '11.visualize', 'validation/' || key, 'y', n FROM counts WHERE key NOT LIKE 'severity:%'
  UNION ALL SELECT '11.visualize', 'pass_fail/' || o, 'y', count(*) FILTER (passed = (o = 'passed')) FROM {judged}, (VALUES ('passed'), ('failed')) v(o) GROUP BY o
  UNION ALL SELECT '11.visualize', 'scores/' || b.bin, 'y', count(pair_id) FROM (SELECT unnest(range(10)) AS bin) b
    LEFT JOIN {judged} ON least(CAST(floor(overall) AS BIGINT), 9) = b.bin GROUP BY b.bin
  UNION ALL SELECT '11.visualize', 'criteria/' || criterion, 'y', mean FROM (UNPIVOT (SELECT avg(coherence) AS coherence, avg(accuracy) AS accuracy,
    avg(helpfulness) AS helpfulness, avg(overall) AS overall FROM {judged}) ON COLUMNS(*) INTO NAME criterion VALUE mean)
  UNION ALL SELECT '11.visualize', 'agreement/' || x || '/' || y, 'y', count(*) FILTER (x = y AND passed = (x = 'true'))
    FROM ra, (VALUES ('true'), ('false')) v(x), (VALUES ('true'), ('false')) w(y) GROUP BY x, y
  UNION ALL SELECT '11.visualize', 'labels/' || status, 'y', count(*) FROM final GROUP BY status
  UNION ALL SELECT '12.clean', '', 'n', count(*) FROM (
    SELECT seq FROM pairs WHERE id NOT IN (SELECT pair_id FROM issues WHERE severity = 'error')
    QUALIFY row_number() OVER (PARTITION BY {pair_hash('instruction', 'output')} ORDER BY seq) = 1))
SELECT step, item, key, round(value, 6) AS value FROM every"""


@query("L1 H5", _job_sql())
def curation_job(spark, sf):
    """Every number of every step, with a second judge run from the cache, all chart data and the size of the clean set."""
    job = run_documents(spark, sf)
    job.results["12.clean"] = job.store.get("pairs", dataset="docs.clean").agg(F.count(F.lit(1)).alias("n"))
    return curate.summary(job).select("step", "item", "key", r6("value"))
