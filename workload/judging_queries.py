"""Judging, labels, comparison, evaluation, export, chart data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.functions import predicates as P
from pairloom.functions.verdict import thresholds
from pairloom.operators import checks, compare, evaluate, export, ingest, judge, labels, profile
from pairloom.schemas import CRITERIA
from pairloom.session import new_folder, stage
from pairloom.sources.readers import read_jsonl
from pairloom.sources.store import DatasetStore, append_labels, judgment_records, load_judgments
from workload import inputs as I
from workload.registry import query, r6, scores6
from workload.sqltext import (CONTEXT, COUNTS, DIRTY, DOCS, LABEL_LOG, LABELS, LAST, LOG, NAMES, RESPONSES, RUN_A, RUN_B,
                              TURNS, cut_split, issues_of, pairs_of, parsed, rule_run, sha256_rank, share)

_S6 = ", ".join(f"round({n}, 6) AS {n}" for n in NAMES)


def _flat(judgments: DataFrame, *more: str) -> DataFrame:
    return judgments.select("pair_id", *scores6(), "passed", *more)


# ----- judging -----

@query("A8", f"WITH {LAST} SELECT pair_id, {_S6}, passed, tag FROM jlast")
def last_judgments(spark, sf):
    return _flat(judge.latest_judgments(I.judge_log(spark, sf)), "tag")


@query("B11", f"""WITH {RUN_A}, p AS (SELECT pair_id, CASE WHEN passed THEN coherence END AS coherence, CASE WHEN coherence > 5 THEN overall END AS overall FROM ja)
SELECT pair_id, round(coalesce(coherence, overall, 5), 6) AS coherence, round(coalesce(overall, 5), 6) AS accuracy,
  round(coalesce(overall, 5), 6) AS helpfulness, round(coalesce(overall, 5), 6) AS overall FROM p""")
def filled_scores(spark, sf):
    a, none = I.judge_a(spark, sf), F.lit(None).cast("double")
    partial = a.withColumn("scores", F.struct(
        F.when(F.col("passed"), F.col("scores.coherence")).alias("coherence"), none.alias("accuracy"), none.alias("helpfulness"),
        F.when(F.col("scores.coherence") > 5, F.col("scores.overall")).alias("overall")))
    return judge.fill_scores(partial).select("pair_id", *scores6())


@query("E1", f"""WITH {DOCS}, {pairs_of('docs')}, ranks AS (
  SELECT *, row_number() OVER (ORDER BY {sha256_rank(42)}) AS rk, count(*) OVER () AS n FROM pairs)
SELECT seq, id FROM ranks WHERE rk <= greatest(1, {share(0.13)})""")
def sampled_pairs(spark, sf):
    return judge.sample_pairs(I.doc_pairs(spark, sf), 0.13).select("seq", "id")


@query("E2", f"""WITH {DOCS}, {pairs_of('docs')}, ranks AS (
  SELECT *, row_number() OVER (ORDER BY {sha256_rank(42)}) AS rk, count(*) OVER () AS n FROM pairs), head AS (
  SELECT seq, id FROM pairs ORDER BY seq LIMIT 40)
SELECT 'sample' AS part, seq, id FROM ranks WHERE rk <= least(25, greatest(1, {share(0.5)}))
UNION ALL SELECT 'prefix', seq, id FROM head""")
def capped_pairs(spark, sf):
    pairs = I.doc_pairs(spark, sf)
    part = lambda df, name: df.select(F.lit(name).alias("part"), "seq", "id")
    return part(judge.sample_pairs(pairs, 0.5, max_pairs=25), "sample").unionByName(part(judge.sample_pairs(pairs, None, 40), "prefix"))


def _prompt_sql(rubric: judge.Rubric, instruction: str = "instruction", output: str = "output") -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    before, rest = rubric.prompt.split("{instruction}")
    between, after = rest.split("{output}")
    return f"{quote(before)} || {instruction} || {quote(between)} || {output} || {quote(after)}"


@query("E3", f"""WITH {DOCS}, {pairs_of('docs')}
SELECT seq, id AS pair_id, {_prompt_sql(judge.BUILTIN)} AS prompt, CAST(0.3 AS DOUBLE) AS temperature FROM pairs
UNION ALL SELECT seq, id, {_prompt_sql(judge.FACTUALITY)}, CAST(0.2 AS DOUBLE) FROM pairs""")
def judge_requests(spark, sf):
    pairs = I.doc_pairs(spark, sf)
    return judge.judge_requests(pairs).unionByName(judge.judge_requests(pairs, judge.FACTUALITY))


@query("E4 E5", f"""WITH {RESPONSES}, {parsed()}
SELECT pair_id, {_S6}, passed, reasoning FROM verdicts""")
def judge_verdicts(spark, sf):
    found = judge.verdicts(I.responses(spark, sf))
    return found.select("pair_id", *scores6(), "passed", F.col("judgment_reasoning").alias("reasoning"))


@query("E5", f"""WITH {RESPONSES}, {parsed(limits=(4, 3, 6, 2))}
SELECT passed, count(*) AS n FROM verdicts GROUP BY passed""")
def custom_thresholds(spark, sf):
    limits = thresholds({"overall": 4.0, "coherence": 3.0, "accuracy": 0, "helpfulness": 2.0}, zero_means_default=True)
    found = judge.verdicts(I.responses(spark, sf), limits=limits)
    return found.groupBy("passed").agg(F.count(F.lit(1)).alias("n"))


@query("E6 E7", f"""WITH {RESPONSES}, {parsed()}
SELECT reasoning, count(*) AS n, max(overall) AS overall FROM verdicts WHERE problem LIKE 'Judgment failed:%' GROUP BY reasoning""")
def failure_rows(spark, sf):
    found = judge.verdicts(I.responses(spark, sf)).filter(judge.is_failure())
    return found.groupBy(F.col("judgment_reasoning").alias("reasoning")).agg(
        F.count(F.lit(1)).alias("n"), F.max("scores.overall").alias("overall"))


@query("E8", f"""SELECT CAST(doc_id AS VARCHAR) AS pair_id,
  sha256(doc_id || chr(31) || 'default' || chr(31) || '1' || chr(31) || 'rule' || chr(31) || 'rule-1') AS key FROM documents""")
def cache_keys(spark, sf):
    ids = I.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("pair_id"))
    return ids.select("pair_id", judge.cache_key(judge.BUILTIN, I.BACKEND, I.MODEL).alias("key"))


_INCREMENTAL = f"""WITH {DOCS}, {pairs_of('docs')}, {RUN_B}, {rule_run('pairs', 'jr', judge.BUILTIN.prompt)}, merged AS (
  SELECT r.pair_id, coalesce(b.coherence, r.coherence) AS coherence, coalesce(b.accuracy, r.accuracy) AS accuracy,
    coalesce(b.helpfulness, r.helpfulness) AS helpfulness, coalesce(b.overall, r.overall) AS overall, coalesce(b.passed, r.passed) AS passed,
    'now' AS tag, b.pair_id IS NOT NULL AS hit FROM jr r LEFT JOIN jb b ON b.pair_id = r.pair_id)"""


def _incremental(spark, sf) -> judge.IncrementalRun:
    return judge.judge_incremental(I.doc_pairs(spark, sf), I.cache(spark, sf), judge.rule_scorer, judge.BUILTIN, I.BACKEND, I.MODEL, tag="now")


@query("E9", f"{_INCREMENTAL} SELECT pair_id, {_S6}, passed, tag FROM merged")
def incremental_judging(spark, sf):
    return _flat(_incremental(spark, sf).judgments, "tag")


@query("E9", f"""{_INCREMENTAL} SELECT count(*) FILTER (hit) AS hits, count(*) FILTER (NOT hit) AS misses, count(*) FILTER (NOT hit) AS writes FROM merged""")
def cache_statistics(spark, sf):
    return _incremental(spark, sf).stats


@query("E10", f"""WITH {RESPONSES}, {parsed()}, t AS (SELECT *, coalesce(problem LIKE 'Judgment failed:%', false) AS bad FROM verdicts)
SELECT count(*) AS judged, count(*) FILTER (passed) AS passed, round(count(*) FILTER (passed) / count(*), 6) AS pass_share,
  count(*) FILTER (bad) AS failures, round(avg(overall) FILTER (NOT bad), 6) AS avg_overall FROM t""")
def judge_run_summary(spark, sf):
    s = judge.run_summary(judge.verdicts(I.responses(spark, sf)))
    return s.select("judged", "passed", r6("pass_share"), "failures", r6("avg_overall"))


@query("E11", f"""WITH {LAST} SELECT CAST(d.doc_id AS VARCHAR) AS id, coalesce(j.passed, false) AS passed
FROM documents d LEFT JOIN jlast j ON j.pair_id = CAST(d.doc_id AS VARCHAR)""")
def passed_pairs(spark, sf):
    return judge.flag_passed(I.doc_pairs(spark, sf), I.judge_log(spark, sf)).select("id", "passed")


@query("E12", f"""WITH {RUN_A} SELECT CASE WHEN overall >= 8 THEN 'high' WHEN overall >= 6 THEN 'medium' ELSE 'low' END AS quality_tier,
  count(*) AS n FROM ja GROUP BY 1""")
def quality_tiers(spark, sf):
    return judge.with_tier(I.judge_a(spark, sf)).groupBy("quality_tier").agg(F.count(F.lit(1)).alias("n"))


_RULE = f"WITH {DOCS}, {pairs_of('docs')}, {rule_run('pairs', 'jr', judge.BUILTIN.prompt)} SELECT pair_id, {_S6}, passed FROM jr"


@query("E13", _RULE)
def rule_scoring(spark, sf):
    return _flat(judge.judge(I.doc_pairs(spark, sf), judge.rule_scorer))


def rule_answers(prompts: list[str], temperature: float | None) -> list[str]:
    """The rule scorer's answers from plain Python, to exercise the scorer hook."""
    out = []
    for p in prompts:
        c, a = min(len(p) // 20, 100), len(p) % 101
        h = (c + a) // 2
        out.append(f'{{"coherence": {c / 10}, "accuracy": {a / 10}, "helpfulness": {h / 10}, "reasoning": "rule"}}')
    return out


@query("E13", _RULE)
def python_scoring(spark, sf):
    return _flat(judge.judge(I.doc_pairs(spark, sf), judge.python_scorer(rule_answers)))


# ----- labels -----

@query("F1", f"""WITH {CONTEXT} SELECT id, {_S6}, passed, status, label_tag FROM ctx""")
def pair_context(spark, sf):
    ctx = labels.context(I.doc_pairs(spark, sf), judge.latest_judgments(I.judge_log(spark, sf)), I.label_docs(spark, sf))
    return ctx.select("id", *scores6(), "passed", F.col("label.status").alias("status"), F.col("label.tag").alias("label_tag"))


@query("F2", f"""WITH {CONTEXT} SELECT seq, id AS pair_id, 'needs_edit' AS status, 'short' AS tag FROM ctx
WHERE overall >= 4 AND length(output) < 2000 AND status IS DISTINCT FROM 'approved'""")
def bulk_labels(spark, sf):
    where = "scores.overall >= 4 AND length(output) < 2000 AND NOT (label.status <=> 'approved')"
    made = labels.bulk_label(I.doc_pairs(spark, sf), where, "needs_edit", judge.latest_judgments(I.judge_log(spark, sf)),
                             I.label_docs(spark, sf), tag="short")
    return made.select("seq", "pair_id", "status", "tag")


_AUTO = """SELECT pair_id, CASE WHEN passed THEN 'approved' WHEN overall < 3.5 THEN 'rejected' ELSE 'needs_edit' END AS status,
  'overall=' || printf('%.1f', overall) AS tag, 'auto-from-judge' AS labeler FROM jlast"""


@query("F3", f"WITH {LAST} {_AUTO}")
def auto_labels(spark, sf):
    return labels.auto_label(judge.latest_judgments(I.judge_log(spark, sf))).select("pair_id", "status", "tag", "labeler")


@query("F4 A10", f"WITH {LABEL_LOG} SELECT pair_id, status, tag FROM llast")
def latest_labels(spark, sf):
    return labels.latest_labels(I.label_log(spark, sf)).select("pair_id", "status", "tag")


@query("F5", """SELECT event_type AS status, count(*) AS n FROM events GROUP BY event_type""")
def invalid_statuses(spark, sf):
    """Events taken as labels without translation: no type is a label status."""
    raw = I.label_log(spark, sf).withColumn("status", F.col("tag"))
    return labels.invalid_labels(raw).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("F6", f"""WITH {LAST}, {LABELS}, auto AS ({_AUTO}), named AS (
  SELECT pair_id, status, CASE WHEN status = 'needs_edit' THEN NULL ELSE 'good' END AS tag FROM auto)
SELECT n.pair_id, n.status, n.tag FROM named n LEFT JOIN lab l ON l.pair_id = n.pair_id
WHERE l.pair_id IS NULL OR n.status IS DISTINCT FROM l.status OR n.tag IS DISTINCT FROM l.tag""")
def resumed_labels(spark, sf):
    new = labels.auto_label(judge.latest_judgments(I.judge_log(spark, sf))).withColumn(
        "tag", F.when(F.col("status") != "needs_edit", "good"))
    return labels.resume_labels(new, I.label_docs(spark, sf)).select("pair_id", "status", "tag")


@query("F7", f"""WITH {DOCS}, {LAST}, {LABELS} SELECT seq, prompt AS instruction, completion AS output,
  printf('%.1f', j.overall) AS overall, j.passed, j.reasoning AS reasoning
FROM docs d LEFT JOIN jlast j ON j.pair_id = CAST(d.seq AS VARCHAR) WHERE CAST(d.seq AS VARCHAR) NOT IN (SELECT pair_id FROM lab)"""
       .replace("SELECT seq, prompt", "SELECT d.seq, prompt"))
def review_queue(spark, sf):
    queue = labels.review_queue(I.doc_pairs(spark, sf), judge.latest_judgments(I.judge_log(spark, sf)), I.label_docs(spark, sf))
    return queue.select("seq", "instruction", "output", "overall", "passed", "reasoning")


# ----- stored runs and labels -----

@query("A9 A12", f"""WITH {LOG} SELECT tag, count(*) AS n, count(*) FILTER (passed) AS passed, round(avg(overall), 6) AS avg_overall FROM jlog GROUP BY tag""")
def judgment_sets(spark, sf):
    """Two runs written to the store, read back together with their tags."""
    kept = DatasetStore(spark, new_folder(spark, "store"))
    for tag, run in (("a", I.judge_a(spark, sf)), ("b", I.judge_b(spark, sf))):
        kept.put(run, "judgments", dataset="docs", tag=tag)
    runs = kept.get("judgments", dataset="docs")
    return runs.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.count_if("passed").alias("passed"), r6(F.avg("scores.overall"), "avg_overall"))


@query("A8 A16 B10 B11", f"WITH {RUN_A} SELECT pair_id, {_S6}, passed, reasoning, 'default' AS rubric FROM ja")
def stored_judgments(spark, sf):
    """A run as JSON records, read back."""
    path = new_folder(spark, "records")
    judgment_records(I.judge_a(spark, sf)).write.text(path)
    back = load_judgments(spark, path)
    return _flat(back, F.col("judgment_reasoning").alias("reasoning"), F.col("rubric.name").alias("rubric"))


@query("A10 F4", f"""WITH {LAST}, {LABELS}, auto AS ({_AUTO}), logged AS (
  SELECT pair_id, status, tag, 0 AS step FROM lab UNION ALL SELECT pair_id, status, tag, 1 FROM auto WHERE status <> 'needs_edit')
SELECT pair_id, status, tag FROM logged QUALIFY row_number() OVER (PARTITION BY pair_id ORDER BY step DESC) = 1""")
def appended_labels(spark, sf):
    """Labels, then decided automatic labels, appended to one log; the later ones win."""
    path = new_folder(spark, "labels")
    append_labels(I.label_docs(spark, sf), path)
    auto = labels.auto_label(judge.latest_judgments(I.judge_log(spark, sf))).filter("status <> 'needs_edit'")
    append_labels(auto.withColumn("seq", F.col("seq") + 10 * I.COPY_OFFSET), path)
    return labels.latest_labels(spark.read.parquet(path)).select("pair_id", "status", "tag")


# ----- comparison -----

_BOTH = f"""{LOG}, both_runs AS (SELECT a.pair_id, a.passed AS ap, b.passed AS bp, a.overall AS ao, b.overall AS bo
  FROM ja a JOIN jb b ON b.pair_id = a.pair_id)"""


@query("G1", f"WITH {_BOTH} SELECT pair_id, ap AS a_pass, bp AS b_pass, round(ao, 6) AS a_score, round(bo, 6) AS b_score FROM both_runs")
def aligned_runs(spark, sf):
    both = compare.align_runs(I.judge_log(spark, sf), "a", "b")
    return both.select("pair_id", "a_pass", "b_pass", r6("a_score"), r6("b_score"))


@query("G2 G3 G4 G5", f"""WITH {_BOTH}, m AS (SELECT count(*) AS n, avg(CASE WHEN ap = bp THEN 1.0 ELSE 0 END) AS po,
  avg(CASE WHEN ap THEN 1.0 ELSE 0 END) AS pa, avg(CASE WHEN bp THEN 1.0 ELSE 0 END) AS pb, corr(ao, bo) AS r,
  count(*) FILTER (ap) AS a_passed, count(*) FILTER (bp) AS b_passed, avg(ao) AS a_mean, avg(bo) AS b_mean FROM both_runs), e AS (
  SELECT *, pa * pb + (1 - pa) * (1 - pb) AS pe FROM m), k AS (
  SELECT *, CASE WHEN pe = 1 THEN CASE WHEN po = 1 THEN 1 ELSE 0 END ELSE (po - pe) / (1 - pe) END AS kappa FROM e)
SELECT n AS n_common, round(po, 6) AS pass_agreement, round(kappa, 6) AS cohens_kappa,
  CASE WHEN kappa < 0 THEN 'below chance' WHEN kappa < .2 THEN 'poor' WHEN kappa < .4 THEN 'fair' WHEN kappa < .6 THEN 'moderate'
    WHEN kappa < .8 THEN 'substantial' ELSE 'near-perfect' END AS kappa_label,
  round(CASE WHEN isnan(r) THEN 0 ELSE r END, 6) AS score_pearson, a_passed, b_passed, round(a_mean, 6) AS a_mean, round(b_mean, 6) AS b_mean FROM k""")
def run_comparison(spark, sf):
    c = compare.compare_runs(I.judge_log(spark, sf), "a", "b")
    return c.select("n_common", r6("pass_agreement"), r6("cohens_kappa"), "kappa_label", r6("score_pearson"),
                    "a_passed", "b_passed", r6("a_mean"), r6("b_mean"))


def _prf(source: str) -> str:
    return f"""c AS (SELECT count(*) AS n_evaluated, count(*) FILTER (pred AND truth) AS tp, count(*) FILTER (pred AND NOT truth) AS fp,
  count(*) FILTER (NOT pred AND NOT truth) AS tn, count(*) FILTER (NOT pred AND truth) AS fn FROM {source}), s AS (
  SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS r FROM c)
SELECT n_evaluated, tp, fp, tn, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1,
  round(coalesce((tp + tn) / nullif(n_evaluated, 0), 0), 6) AS accuracy FROM s"""


def _shares(df: DataFrame) -> DataFrame:
    return df.select("n_evaluated", "tp", "fp", "tn", "fn", r6("precision"), r6("recall"), r6("f1"), r6("accuracy"))


@query("G6 G7", f"WITH {RUN_A}, t AS (SELECT overall >= 5 AS pred, coherence >= 5 AS truth FROM ja), {_prf('t')}")
def confusion_shares(spark, sf):
    rows = I.judge_a(spark, sf).select((F.col("scores.overall") >= 5).alias("pred"), (F.col("scores.coherence") >= 5).alias("truth"))
    return _shares(compare.confusion_report(rows))


@query("G8", f"""WITH {LAST}, {LABELS}, t AS (SELECT j.passed AS pred, l.status = 'approved' AS truth FROM jlast j JOIN lab l ON l.pair_id = j.pair_id), {_prf('t')}""")
def calibration(spark, sf):
    return _shares(compare.calibrate(judge.latest_judgments(I.judge_log(spark, sf)), labels.latest_labels(I.label_docs(spark, sf))))


# ----- evaluation -----

@query("H1", """SELECT round(avg(CASE WHEN item_id % 4 <> 0 THEN 1.0 ELSE 0 END), 6) AS exact_match FROM benchmark""")
def exact_match(spark, sf):
    made, wanted = I.predictions(spark, sf)
    return evaluate.exact_match(made, wanted, "item_id").select(r6("exact_match"))


_METRICS = """count(*) AS total, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed,
  round(count(*) FILTER (passed) / count(*), 6) AS pass_rate, round(avg(coherence), 6) AS avg_coherence,
  round(avg(accuracy), 6) AS avg_accuracy, round(avg(helpfulness), 6) AS avg_helpfulness, round(avg(overall), 6) AS avg_overall"""


@query("H2", f"WITH {LOG} SELECT {_METRICS} FROM jlog")
def judgment_metrics(spark, sf):
    m = evaluate.judgment_metrics(I.judge_log(spark, sf))
    return m.select("total", "passed", "failed", r6("pass_rate"), *[r6(f"avg_{c}") for c in CRITERIA])


_BLANKED = "CASE WHEN topic IN ('src1', 'src2') THEN '' WHEN topic = 'src4' THEN NULL ELSE topic END"


def _some_blank(spark, sf) -> DataFrame:
    c = F.col("category")
    return I.doc_pairs(spark, sf).withColumn("category", F.when(c.isin("src1", "src2"), "").when(c != "src4", c))


@query("H3", f"""WITH {DOCS} SELECT coalesce(nullif({_BLANKED}, ''), 'unknown') AS category, count(*) AS n FROM docs GROUP BY 1""")
def category_counts(spark, sf):
    return evaluate.category_counts(_some_blank(spark, sf))


@query("H4", f"""WITH {DOCS}, {RUN_A}, m AS (SELECT {_METRICS} FROM ja)
SELECT 'dataset' AS section, 'total_samples' AS key, CAST(count(*) AS DOUBLE) AS value FROM docs
UNION ALL SELECT 'category', coalesce(nullif({_BLANKED}, ''), 'unknown'), count(*) FROM docs GROUP BY 2
UNION ALL SELECT 'judgments', key, value FROM (
  UNPIVOT (SELECT CAST(COLUMNS(*) AS DOUBLE) FROM m) ON COLUMNS(*) INTO NAME key VALUE value)""")
def dataset_evaluation(spark, sf):
    e = evaluate.evaluate_dataset(_some_blank(spark, sf), I.judge_a(spark, sf))
    return e.select("section", "key", r6("value"))


@query("H5", """SELECT lang AS name, count(DISTINCT trim(split_part(text, chr(10), 1)) || chr(31) || text) AS pairs, 'table' AS source, lang || '-docs' AS tags
FROM documents GROUP BY lang""")
def dataset_listing(spark, sf):
    metas = None
    for lang in ("de", "en", "es", "fr"):
        rows = I.raw_docs(spark, sf).filter(F.col("level") == lang)
        m = ingest.dataset_meta(ingest.ingest(rows), lang, "table", f"{lang}-docs")
        metas = m if metas is None else metas.unionByName(m)
    return evaluate.list_datasets(metas)


@query("H6", f"""WITH {LOG} SELECT 'docs' AS dataset, 'pairs' AS artifact, CASE WHEN (SELECT count(*) FROM documents) > 0 THEN 'present' ELSE 'missing' END AS status, CAST(NULL AS BIGINT) AS sets
UNION ALL SELECT 'docs', 'validation', 'missing', NULL
UNION ALL SELECT 'docs', 'labels', CASE WHEN (SELECT count(*) FROM labels) > 0 THEN 'present' ELSE 'missing' END, NULL
UNION ALL SELECT 'docs', 'judgments', 'present', count(DISTINCT tag) FROM jlog""")
def dataset_inventory(spark, sf):
    return evaluate.inventory("docs", {"pairs": I.doc_pairs(spark, sf), "validation": None, "labels": I.label_docs(spark, sf)}, I.judge_log(spark, sf))


# ----- filter, split, export -----

@query("I1", f"""WITH {CONTEXT} SELECT seq, id, category FROM ctx
WHERE (passed OR overall / nullif(coherence, 0) > 1.2) AND label_tag IS DISTINCT FROM 'good'""")
def context_filter(spark, sf):
    where = (F.col("passed") | (P.divide(F.col("scores.overall"), F.col("scores.coherence")) > 1.2)) & P.not_equal(F.col("label.tag"), "good")
    kept = export.filter_pairs(I.doc_pairs(spark, sf), where, judge.latest_judgments(I.judge_log(spark, sf)), I.label_docs(spark, sf))
    return kept.select("seq", "id", "category")


_TURN_PAIRS = f"""{TURNS}, pairs AS (SELECT seq, CAST(seq AS VARCHAR) AS id FROM turns)"""


@query("I2 I3", f"""WITH {_TURN_PAIRS}, {cut_split('pairs', ['train', 'val', 'test'], [share(0.8), share(0.13)], 7)} SELECT seq, split FROM splits""")
def ratio_split(spark, sf):
    return export.ratio_split(I.turn_pairs(spark, sf), export.parse_split("train=0.8,val=0.13,test=0.07"), seed=7).select("seq", "split")


@query("I4", f"""WITH {_TURN_PAIRS}, {cut_split('pairs', ['test', 'val', 'train'], [share(0.2), share(0.1)])} SELECT seq, split FROM splits""")
def train_test_split(spark, sf):
    return export.train_test_split(I.turn_pairs(spark, sf)).select("seq", "split")


@query("I5", f"""WITH {CONTEXT}, kept AS (SELECT * FROM ctx WHERE overall >= 4 AND status IS DISTINCT FROM 'rejected'),
{cut_split('kept', ['train', 'val'], [share(0.9)])} SELECT split, count(*) AS n, CAST(sum(length(output)) AS BIGINT) AS chars FROM splits GROUP BY split""")
def export_job(spark, sf):
    out = export.export(I.doc_pairs(spark, sf), "scores.overall >= 4 AND NOT (label.status <=> 'rejected')",
                        judge.latest_judgments(I.judge_log(spark, sf)), I.label_docs(spark, sf), "train=0.9,val=0.1", stage=stage)
    return out.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("output")).alias("chars"))


@query("I6", f"""WITH {LAST} SELECT doc_id AS seq, text AS output, 'train' AS split, 3 AS cycle_id FROM documents
JOIN jlast j ON j.pair_id = CAST(doc_id AS VARCHAR) WHERE j.passed""")
def training_set(spark, sf):
    return export.training_set(I.doc_pairs(spark, sf), I.judge_log(spark, sf), cycle_id=3).select("seq", "output", "split", "cycle_id")


# ----- chart data -----

@query("J1", f"""WITH {LOG} SELECT CASE WHEN passed THEN 'passed' ELSE 'failed' END AS outcome, count(*) AS n FROM jlog GROUP BY 1""")
def pass_fail_counts(spark, sf):
    return profile.pass_fail_counts(I.judge_log(spark, sf))


@query("J2", f"""WITH {LOG} SELECT b.bin, count(pair_id) AS n FROM (SELECT unnest(range(10)) AS bin) b
LEFT JOIN jlog ON least(CAST(floor(overall) AS BIGINT), 9) = b.bin GROUP BY b.bin""")
def score_histogram(spark, sf):
    return profile.score_histogram(I.judge_log(spark, sf))


@query("J3", f"""WITH {LOG}, m AS (SELECT avg(coherence) AS coherence, avg(accuracy) AS accuracy, avg(helpfulness) AS helpfulness, avg(overall) AS overall FROM jlog)
SELECT criterion, round(mean, 6) AS mean FROM (UNPIVOT m ON COLUMNS(*) INTO NAME criterion VALUE mean)""")
def criterion_means(spark, sf):
    return profile.criterion_means(I.judge_log(spark, sf)).select("criterion", r6("mean"))


@query("J4", f"""WITH {DOCS} SELECT coalesce(nullif({_BLANKED}, ''), '(uncategorized)') || '/' || level AS category, count(*) AS n
FROM docs GROUP BY 1 ORDER BY n DESC, min(seq) LIMIT 20""")
def top_categories(spark, sf):
    named = _some_blank(spark, sf).withColumn("category", F.concat(evaluate.category_name("(uncategorized)"), F.lit("/"), F.col("difficulty")))
    return profile.top_categories(named)


def _hist(field: str, column: str) -> str:
    return f"""SELECT '{field}' AS field, b.bin, count(x) AS n, min(lo) AS lo, min(hi) AS hi FROM (SELECT unnest(range(20)) AS bin) b
  CROSS JOIN (SELECT CAST(min(length({column})) AS DOUBLE) AS lo, CAST(max(length({column})) AS DOUBLE) AS hi FROM docs) e
  LEFT JOIN (SELECT CAST(length({column}) AS DOUBLE) AS x FROM docs) d ON least(floor((x - lo) * 20 / (hi - lo)), 19) = b.bin GROUP BY b.bin"""


@query("J5", f"WITH {DOCS} {_hist('instruction', 'prompt')} UNION ALL {_hist('output', 'completion')}")
def length_histograms(spark, sf):
    return profile.length_histograms(I.doc_pairs(spark, sf))


@query("J6", f"""WITH {LABEL_LOG} SELECT status, count(*) AS n,
  CAST(CASE status WHEN 'approved' THEN 1 WHEN 'needs_edit' THEN 2 WHEN 'rejected' THEN 3 ELSE 4 END AS BIGINT) AS position FROM llast GROUP BY status""")
def label_distribution(spark, sf):
    return profile.label_distribution(labels.latest_labels(I.label_log(spark, sf)))


@query("J7", f"""WITH {DIRTY}, {pairs_of('dirty')}, {issues_of('pairs')} SELECT "check", count(*) AS n FROM issues GROUP BY 1""")
def ranked_issues(spark, sf):
    facts = stage(checks.check_facts(I.dirty_pairs(spark, sf), checks.DEFAULT_CHECKS), "facts")
    return profile.ranked_issues(checks.report(facts))


@query("J8", f"""WITH {_BOTH}, cells AS (SELECT * FROM (VALUES (true, true), (true, false), (false, true), (false, false)) v(a_pass, b_pass))
SELECT c.a_pass, c.b_pass, count(pair_id) AS n FROM cells c LEFT JOIN both_runs b ON b.ap = c.a_pass AND b.bp = c.b_pass GROUP BY ALL""")
def agreement_matrix(spark, sf):
    return profile.agreement_matrix(I.judge_log(spark, sf))


@query("J9", f"""WITH {LOG}, {LABEL_LOG} SELECT (SELECT count(*) FROM documents) AS pairs, (SELECT count(DISTINCT tag) FROM jlog) AS judgment_sets,
  (SELECT count(*) FROM jlog) AS judgments, (SELECT count(*) FROM llast) AS labels""")
def dataset_overview(spark, sf):
    return profile.overview(I.doc_pairs(spark, sf), I.judge_log(spark, sf), labels.latest_labels(I.label_log(spark, sf)))


# ----- one cache, failing scorers, stored runs -----

@query("E9 A1", """SELECT run, count(*) AS judged, CASE run WHEN 'second' THEN count(*) ELSE 0 END AS hits,
  CASE run WHEN 'first' THEN count(*) ELSE 0 END AS misses FROM (
  SELECT doc_id FROM documents UNION ALL SELECT conv_id FROM nexts WHERE role = 'user' AND next_role = 'assistant'), (VALUES ('first'), ('second')) r(run)
GROUP BY run""".replace("SELECT run,", "WITH nexts AS (SELECT conv_id, role, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role FROM conversations) SELECT run,", 1))
def shared_cache(spark, sf):
    """Documents and conversations, one with numbers and one with file places as order, judged twice against one store."""
    store = DatasetStore(spark, new_folder(spark, "cache"))
    path = new_folder(spark, "turns") + ".jsonl"
    turns = I.turn_pairs(spark, sf).withColumn("id", F.concat(F.lit("turn-"), "id"))
    turns.select(F.to_json(F.struct("id", "instruction", "output")).alias("value")).write.text(path)
    back = read_jsonl(spark, path).select("seq", *[F.try_variant_get("row", f"$.{c}", "string").alias(c) for c in ("id", "instruction", "output")])
    own = {"cache_rubric": "default", "cache_version": 1, "cache_backend": I.BACKEND, "cache_model": I.MODEL}
    out = None
    for turn, name in enumerate(("first", "second")):
        for pairs in (I.doc_pairs(spark, sf), back):
            held = store.find("judgment_cache", **own)
            empty = judge.cache_rows(I.judge_b(spark, sf).limit(0), judge.BUILTIN, I.BACKEND, I.MODEL)
            run = judge.judge_incremental(pairs, empty if held is None else held.drop(*own), judge.rule_scorer, judge.BUILTIN,
                                          I.BACKEND, I.MODEL, written=turn)
            store.put(run.fresh, "judgment_cache", mode="append", **own)
            rows = stage(run.stats).select(F.lit(name).alias("run"), "hits", "misses")
            out = rows if out is None else out.unionByName(rows)
    return out.groupBy("run").agg(F.sum(F.col("hits") + F.col("misses")).alias("judged"), F.sum("hits").alias("hits"), F.sum("misses").alias("misses"))


def failing_answers(prompts: list[str], temperature: float | None):
    """Answers one by one; a request of an odd length times out."""
    for p in prompts:
        if len(p) % 2:
            raise TimeoutError(f"no answer to {len(p)} characters")
        yield '{"coherence": 8, "accuracy": 8, "helpfulness": 8, "reasoning": "even"}'


_ASKED = len(judge.BUILTIN.prompt) - len("{instruction}{output}")


@query("E7 E13", f"""WITH {DOCS}, n AS (SELECT CAST(seq AS VARCHAR) AS pair_id, {_ASKED} + length(prompt) + length(completion) AS n FROM docs)
SELECT pair_id, n % 2 = 0 AS passed, CASE WHEN n % 2 = 0 THEN 8.0 ELSE 0.0 END AS overall,
  CASE WHEN n % 2 = 0 THEN 'even' ELSE 'Judgment failed: TimeoutError: no answer to ' || n || ' characters' END AS reasoning FROM n""")
def failing_scorer(spark, sf):
    made = judge.judge(I.doc_pairs(spark, sf), judge.python_scorer(failing_answers))
    return made.select("pair_id", "passed", r6("scores.overall", "overall"), F.col("judgment_reasoning").alias("reasoning"))


@query("A9 A16", f"""WITH {LOG} SELECT tag, count(*) AS n, count(*) FILTER (passed) AS passed, round(avg(overall), 6) AS avg_overall FROM jlog GROUP BY tag""")
def exported_runs(spark, sf):
    """Two runs written as JSON folders named after dataset and tag, beside one of another dataset."""
    root = new_folder(spark, "runs")
    for name, run in (("docs.a", I.judge_a(spark, sf)), ("docs.b", I.judge_b(spark, sf)), ("others.a", I.judge_b(spark, sf))):
        judgment_records(run).write.text(f"{root}/{name}.jsonl")
    runs = load_judgments(spark, f"{root}/*.jsonl", dataset="docs")
    return runs.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.count_if("passed").alias("passed"), r6(F.avg("scores.overall"), "avg_overall"))
