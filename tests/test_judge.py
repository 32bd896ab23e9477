"""Judge responses, verdicts, incremental runs, samples, labels, comparison."""

import json

import pytest
from pyspark.sql import functions as F

from pairloom.functions.verdict import thresholds
from pairloom.operators import compare, evaluate, generate, judge, labels
from pairloom.session import new_folder
from pairloom.sources.store import append_labels
from pairloom.operators.export import check_ratios, export, filter_pairs, parse_split, ratio_split, split_sizes, train_test_split

GOOD = {"coherence": 8.0, "accuracy": 8, "helpfulness": 8, "overall": 8.0, "passed": True, "reasoning": "fine"}


FAILED, UNREAD = (0, 0, 0, 0, False, "Judgment failed:"), (5, 5, 5, 5, False, "Parse error")
# Response text, then coherence, accuracy, helpfulness, overall, passed and how the reasoning begins.
RESPONSES = [
    (json.dumps(GOOD), (8, 8, 8, 8, True, 'fine')),
    ('```json\n' + json.dumps(GOOD) + '\n```', (8, 8, 8, 8, True, 'fine')),
    ('```\n' + json.dumps(GOOD) + '```', (8, 8, 8, 8, True, 'fine')),
    ('```json\n' + json.dumps(GOOD), (8, 8, 8, 8, True, 'fine')),
    ('Sure! ' + json.dumps(GOOD) + ' bye', (8, 8, 8, 8, True, 'fine')),
    ('This is not valid JSON', UNREAD),
    ('', UNREAD),
    ('{}', (5, 5, 5, 5, False, 'No reasoning provided')),
    ('{ }', (5, 5, 5, 5, False, 'No reasoning provided')),
    ('5', FAILED),
    ('5 trailing', UNREAD),
    ('"text"', FAILED),
    ('null', FAILED),
    ('[1, 2]', FAILED),
    ('1.5', FAILED),
    ('true', FAILED),
    ('{"coherence": 9}', (9, 5, 5, 6.333333333333333, False, 'No reasoning provided')),
    ('{"coherence": 9, "accuracy": 9, "helpfulness": 9}', (9, 9, 9, 9, True, 'No reasoning provided')),
    ('{"coherence": "8", "accuracy": " 7.5 ", "overall": "1e0"}', (8, 7.5, 5, 1, False, 'No reasoning provided')),
    ('{"coherence": "x"}', UNREAD),
    ('{"coherence": null}', FAILED),
    ('{"coherence": [1]}', FAILED),
    ('{"accuracy": "x", "coherence": null}', FAILED),
    ('{"coherence": "x", "accuracy": null}', UNREAD),
    ('{"overall": 11}', FAILED),
    ('{"overall": -0.5}', FAILED),
    ('{"overall": "inf"}', FAILED),
    ('{"overall": "nan"}', FAILED),
    ('{"overall": "8d"}', UNREAD),
    ('{"overall": "1_0"}', (5, 5, 5, 10, False, 'No reasoning provided')),
    ('{"overall": "_1"}', UNREAD),
    ('{"overall": true}', (5, 5, 5, 1, False, 'No reasoning provided')),
    ('{"overall": 9, "passed": "false"}', (5, 5, 5, 9, True, 'No reasoning provided')),
    ('{"passed": ""}', (5, 5, 5, 5, False, 'No reasoning provided')),
    ('{"passed": 0}', (5, 5, 5, 5, False, 'No reasoning provided')),
    ('{"passed": 1}', (5, 5, 5, 5, True, 'No reasoning provided')),
    ('{"passed": []}', (5, 5, 5, 5, False, 'No reasoning provided')),
    ('{"passed": [0]}', (5, 5, 5, 5, True, 'No reasoning provided')),
    ('{"passed": null, "overall": 9, "coherence": 9, "accuracy": 9, "helpfulness": 9}', (9, 9, 9, 9, True, 'No reasoning provided')),
    ('{"detail": {"a": 1}, "overall": 9}', UNREAD),
    ('{"reasoning": 5}', FAILED),
    ('{"reasoning": null}', FAILED),
    ('{"reasoning": "a } b"}', UNREAD),
    ('{"overall": 7, "coherence": 6, "accuracy": 6, "helpfulness": 6}', (6, 6, 6, 7, True, 'No reasoning provided')),
    ('{"overall": 6.999, "coherence": 6, "accuracy": 6, "helpfulness": 6}', (6, 6, 6, 6.999, False, 'No reasoning provided')),
    ('```json```', UNREAD),
    ('``` ```json {"overall": 3}', (5, 5, 5, 3, False, 'No reasoning provided')),
    ('{"a": 1} {"overall": 2}', (5, 5, 5, 5, False, 'No reasoning provided')),
    ('{"overall": 1.}', UNREAD),
    ('{"overall": 01}', UNREAD),
    ("{'overall': 1}", UNREAD),
    ('{"overall": 1,}', UNREAD),
    ('{"overall": 8, "overall": 4}', (5, 5, 5, 4, False, 'No reasoning provided')),
    ('\xa0{"overall": 3}\xa0', (5, 5, 5, 3, False, 'No reasoning provided')),
    (None, FAILED),
]


def test_responses(spark):
    df = spark.createDataFrame([(i, str(i), r) for i, (r, _) in enumerate(RESPONSES)], "seq int, pair_id string, response string")
    rows = judge.verdicts(df).orderBy("seq").collect()
    for (text, want), r in zip(RESPONSES, rows):
        assert (*tuple(r.scores), r.passed) == pytest.approx(want[:5]), text
        assert r.judgment_reasoning.startswith(want[5]), (text, r.judgment_reasoning)


def test_failure_texts(spark):
    df = spark.createDataFrame([(0, "a", '{"overall": null}'), (1, "b", "[1]"), (2, "c", "1.5")], "seq int, pair_id string, response string")
    assert [r.judgment_reasoning for r in judge.verdicts(df).orderBy("seq").collect()] == [
        "Judgment failed: TypeError: float() argument must be a string or a real number, not 'NoneType'",
        "Judgment failed: AttributeError: 'list' object has no attribute 'get'",
        "Judgment failed: AttributeError: 'float' object has no attribute 'get'"]


def test_thresholds_and_rule(spark):
    assert thresholds({"overall": 0, "accuracy": 3.0}, zero_means_default=True) == {"overall": 7.0, "coherence": 6.0, "accuracy": 3.0, "helpfulness": 6.0}
    assert thresholds({"overall": 0})["overall"] == 0
    df = spark.createDataFrame([(0, "a", '{"overall": 3, "accuracy": 9}')], "seq int, pair_id string, response string")
    assert judge.verdicts(df, judge.Rubric(pass_condition="accuracy >= 8")).first().passed
    assert judge.verdicts(df, limits={"overall": 1, "coherence": 1, "accuracy": 1, "helpfulness": 1}).first().passed


def test_prompt_quotes_the_texts(pairs_of):
    pairs = pairs_of([(1, "say {output} 'x'", "é" * 2500)])
    prompt = judge.judge_requests(pairs).first().prompt
    assert "say {output} 'x'" in prompt and prompt.count("é") == 2500 and prompt.endswith('"brief explanation"}')
    assert judge.judge_requests(pairs, judge.Rubric(output_chars=2000)).first().prompt.count("é") == 2000


def test_scorer_hook_survives_errors(pairs_of):
    def answer(prompts, temperature):
        if any("boom" in p for p in prompts):
            raise RuntimeError("no")
        return [json.dumps(GOOD) for _ in prompts]

    pairs = pairs_of([(1, "fine", "x"), (2, "boom", "x"), (3, "ok", "y")]).withColumn("seq", F.struct(F.lit("f").alias("file"), "seq"))
    rows = {r.pair_id: (r.passed, r.judgment_reasoning) for r in judge.judge(pairs, judge.python_scorer(answer, tasks=2)).collect()}
    assert rows == {"1": (True, "fine"), "2": (False, "Judgment failed: RuntimeError: no"), "3": (True, "fine")}
    asked = []

    def one_by_one(prompts, temperature):
        for p in prompts:
            asked.append(p)
            if "boom" in p:
                raise TimeoutError("late")
            yield json.dumps(GOOD | {"reasoning": f"asked {sum(p == q for q in asked)}"})

    rows = {r.pair_id: (r.passed, r.judgment_reasoning) for r in judge.judge(pairs, judge.python_scorer(one_by_one, tasks=1)).collect()}
    assert rows == {"1": (True, "asked 1"), "2": (False, "Judgment failed: TimeoutError: late"), "3": (True, "asked 1")}
    short = judge.judge(pairs, judge.python_scorer(lambda prompts, temperature: [], tasks=1))
    assert {r.judgment_reasoning for r in short.collect()} == {"Judgment failed: no response"}
    with pytest.raises(ValueError, match="lost"):
        judge.judge(pairs, lambda requests: requests.select("pair_id"))


def test_cache(spark, pairs_of):
    pairs = pairs_of([(i, f"text {i}", "out") for i in range(10)])
    empty = judge.cache_rows(judge.judge(pairs.limit(0), judge.rule_scorer), judge.BUILTIN, "", "")
    first = judge.judge_incremental(pairs, empty, judge.rule_scorer, tag="one")
    assert tuple(first.stats.first()) == (0, 10, 10)
    second = judge.judge_incremental(pairs, first.fresh, judge.rule_scorer, tag="two")
    assert tuple(second.stats.first()) == (10, 0, 0)
    assert second.judgments.filter("tag = 'two'").count() == 10
    off = judge.judge_incremental(pairs, first.fresh, judge.rule_scorer, enabled=False)
    assert tuple(off.stats.first()) == (0, 10, 0)
    later = first.fresh.withColumns({"written": F.lit(5).cast("bigint"), "judgment_reasoning": F.lit("later")})
    twice = judge.judge_incremental(pairs, first.fresh.unionByName(later), judge.rule_scorer)
    assert twice.judgments.filter("judgment_reasoning = 'later'").count() == twice.judgments.count() == 10
    other = pairs.withColumn("seq", F.struct(F.lit("file").alias("file"), "seq"))
    assert tuple(judge.judge_incremental(other, first.fresh, judge.rule_scorer).stats.first()) == (10, 0, 0)


def test_failures_are_not_cached(pairs_of):
    pairs = pairs_of([(1, "a", "b"), (2, "c", "d")])
    answers = lambda req: req.withColumn("response", F.when(F.col("pair_id") == "1", "no json"))
    empty = judge.cache_rows(judge.judge(pairs.limit(0), judge.rule_scorer), judge.BUILTIN, "", "")
    run = judge.judge_incremental(pairs, empty, answers)
    assert tuple(run.stats.first()) == (0, 2, 1)
    assert run.fresh.first().judgment_reasoning == "Parse error"


def test_run_summary(judgments_of):
    js = judgments_of([("a", True, 8), ("b", False, 4), ("c", False, 0, "t", "Judgment failed: x")])
    s = judge.run_summary(js).first()
    assert (s.judged, s.passed, s.failures, s.avg_overall) == (3, 1, 1, 6.0) and s.pass_share == pytest.approx(1 / 3)
    assert tuple(judge.run_summary(js.limit(0)).first()) == (0, 0, 0.0, 0, 0.0)


def test_partition_and_tiers(pairs_of, judgments_of):
    pairs = pairs_of([("a", "1", "x"), ("b", "2", "x"), ("c", "3", "x")])
    js = judgments_of([("a", False, 1), ("b", True, 8), ("a", True, 8), ("b", False, 4)])
    assert {r.id: r.passed for r in judge.flag_passed(pairs, js).collect()} == {"a": True, "b": False, "c": False}
    tiers = judge.with_tier(judgments_of([("a", True, 8), ("b", True, 6), ("c", True, 5.9)])).orderBy("seq")
    assert [r.quality_tier for r in tiers.collect()] == ["high", "medium", "low"]


def test_sample_sizes(spark):
    pairs = spark.range(1003).selectExpr("id AS seq", "CAST(id AS STRING) AS id")
    for fraction, cap, n in ((0.1, None, 100), (0.0001, None, 1), (0.5, 20, 20), (None, 7, 7), (1.0, None, 1003), (0.3, 0, 0)):
        assert judge.sample_pairs(pairs, fraction, cap).count() == n
    once = sorted(r.id for r in judge.sample_pairs(pairs, 0.1).collect())
    assert once == sorted(r.id for r in judge.sample_pairs(pairs.repartition(5), 0.1).collect())


# ----- labels -----

def test_bulk_by_score(pairs_of, judgments_of, labels_of):
    pairs = pairs_of([("a", "1", "x"), ("b", "2", "x"), ("a", "again", "y"), ("c", "3", "z")])
    js = judgments_of([("a", True, 9), ("b", False, 3)])
    assert [r.pair_id for r in labels.bulk_label(pairs, "scores.overall >= 7", "approved", js).collect()] == ["a"]
    assert labels.bulk_label(pairs, "output = 'y'", "approved", js).count() == 0
    assert [r.pair_id for r in labels.bulk_label(pairs, "judge_model IS NULL AND NOT passed", "skipped", js).collect()] == ["c"]
    cur = labels_of([("a", "approved")])
    assert sorted(r.pair_id for r in labels.bulk_label(pairs, "NOT (label.status <=> 'approved')", "rejected", js, cur).collect()) == ["b", "c"]
    with pytest.raises(ValueError):
        labels.bulk_label(pairs, "true", "great")
    with pytest.raises(ValueError):
        labels.bulk_label(pairs, "output", "approved")


def test_auto_labels(judgments_of):
    rows = labels.auto_label(judgments_of([("a", True, 8), ("b", False, 2), ("c", False, 5), ("d", False, 3.5), ("e", False, 0.25)])).orderBy("seq")
    assert [(r.status, r.tag) for r in rows.collect()] == [
        ("approved", "overall=8.0"), ("rejected", "overall=2.0"), ("needs_edit", "overall=5.0"), ("needs_edit", "overall=3.5"), ("rejected", "overall=0.2")]


def test_latest_and_resume(labels_of):
    log = labels_of([("x", "approved"), ("y", "skipped", "t"), ("x", "rejected"), (None, "approved"), ("z", None)])
    latest = labels.latest_labels(log.replace("None", None, ["pair_id"]))
    assert {(r.pair_id, r.status) for r in latest.collect()} == {("x", "rejected"), ("y", "skipped")}
    new = labels_of([("x", "rejected"), ("y", "skipped"), ("z", "approved")])
    assert sorted(r.pair_id for r in labels.resume_labels(new, latest).collect()) == ["y", "z"]


def test_appending_labels(spark, labels_of):
    path = new_folder(spark, "log")
    assert append_labels(labels_of([("x", "approved"), ("y", "skipped")]), path) == 2
    with pytest.raises(ValueError, match="not a label status: great"):
        append_labels(labels_of([("z", "approved"), ("z", "great")]), path)
    assert spark.read.parquet(path).count() == 2


def test_review_queue(pairs_of, judgments_of, labels_of):
    pairs = pairs_of([("a", "1", "x" * 700), ("b", "2", "y")])
    judged, done = judgments_of([("a", True, 7.25, "t", "r" * 200)]), labels_of([("b", "approved")])
    shown = lambda **cut: [(r.id, len(r.output), r.overall, len(r.reasoning)) for r in labels.review_queue(pairs, judged, done, **cut).collect()]
    assert shown() == [("a", 700, "7.2", 200)] and shown(output_chars=600, reasoning_chars=120) == [("a", 600, "7.2", 120)]
    assert labels.review_queue(pairs, None, labels_of([("b", "approved")]), resume=False).count() == 2


# ----- comparison and evaluation -----

def test_compare_runs(judgments_of):
    js = judgments_of([("a", True, 9, "v1"), ("b", True, 8, "v1"), ("c", False, 3, "v1"),
                       ("a", True, 8, "v2"), ("b", False, 5, "v2"), ("c", False, 4, "v2"), ("d", True, 9, "v2")])
    c = compare.compare_runs(js, "v1", "v2").first()
    assert (c.n_common, c.a_passed, c.b_passed) == (3, 2, 1) and c.pass_agreement == pytest.approx(2 / 3)
    assert c.a_mean == pytest.approx(20 / 3) and c.cohens_kappa == pytest.approx(0.4) and c.kappa_label == "fair"   # 0.39999999999999986
    assert compare.compare_runs(js, "v1", "v3").first().n_common == 0


@pytest.mark.parametrize("pred,truth,want", [("TTFF", "TFTF", (1, 1, 1, 1, .5, .5, .5, .5)), ("FFF", "FFF", (0, 0, 3, 0, 0, 0, 0, 1.0)),
                                             ("TTTTTTFF", "TTTTTTTT", (6, 0, 0, 2, 1.0, .75, 6 / 7, .75))])
def test_shares(spark, pred, truth, want):
    df = spark.createDataFrame([(p == "T", t == "T") for p, t in zip(pred, truth)], "pred boolean, truth boolean")
    r = compare.confusion_report(df).first()
    assert (r.tp, r.fp, r.tn, r.fn, r.precision, r.recall, r.f1, r.accuracy) == pytest.approx(want)


def test_calibrate(judgments_of, labels_of):
    js = judgments_of([("a", True, 9), ("b", True, 8), ("c", False, 3), ("d", False, 2), ("e", True, 9)])
    r = compare.calibrate(js, labels_of([("a", "approved"), ("b", "approved"), ("c", "rejected"), ("d", "skipped")])).first()
    assert (r.n_evaluated, r.precision, r.recall, r.f1) == (4, 1.0, 1.0, 1.0)


@pytest.mark.parametrize("preds,refs,want", [(["A", "B", "C"], ["A", "B", "D"], 2 / 3), ([], [], 0.0), (["A"], ["A", "B"], 0.0), (["Hello "], ["hELLO"], 1.0)])
def test_exact_match(spark, preds, refs, want):
    p = spark.createDataFrame(list(enumerate(preds)), "i int, prediction string")
    r = spark.createDataFrame(list(enumerate(refs)), "i int, reference string")
    assert evaluate.exact_match(p, r, "i").first()[0] == pytest.approx(want)


def test_metrics_and_categories(pairs_of, judgments_of):
    m = evaluate.judgment_metrics(judgments_of([("a", True, 8), ("b", False, 6), ("c", True, 9)])).first()
    assert (m.total, m.passed) == (3, 2) and m.pass_rate == pytest.approx(2 / 3) and m.avg_overall == pytest.approx(23 / 3)
    pairs = pairs_of([(i, "x", "y") for i in range(5)], category=["math", "math", "science", "", None])
    assert {r.category: r.n for r in evaluate.category_counts(pairs).collect()} == {"math": 2, "science": 1, "unknown": 2}
    assert [tuple(r) for r in evaluate.evaluate_dataset(pairs.limit(0)).collect()] == [("error", "Empty dataset", None)]


# ----- splits -----

def sizes(df):
    return {r.split: r.n for r in split_sizes(df).collect()}


def test_split_sizes(spark):
    pairs = lambda n: spark.range(n).selectExpr("id AS seq", "CAST(id AS STRING) AS id")
    assert sizes(ratio_split(pairs(10), {"train": 0.8, "val": 0.2})) == {"train": 8, "val": 2}
    assert sizes(ratio_split(pairs(6), {"train": 0.8, "val": 0.2})) == {"train": 4, "val": 2}
    assert sizes(train_test_split(pairs(10))) == {"train": 7, "test": 2, "val": 1}
    assert sizes(ratio_split(pairs(10), {"a": 0.0, "b": 0.0, "c": 1.0})) == {"c": 10}
    assert sizes(ratio_split(pairs(10), {"a": 1.0, "b": 0.0})) == {"a": 10}
    assert sizes(ratio_split(pairs(3), {})) == {"": 3}
    assert sizes(ratio_split(pairs(0), {"a": 0.5, "b": 0.5})) == {}
    assert sizes(ratio_split(pairs(2), {"a": 0.4, "b": 0.3, "c": 0.3})) == {"c": 2}
    big = ratio_split(pairs(5003), {"a": 0.29, "b": 0.29, "c": 0.42})
    assert sizes(big) == {"a": int(5003 * .29), "b": int(5003 * .29), "c": 5003 - 2 * int(5003 * .29)}
    assert big.orderBy("seq").collect() == ratio_split(pairs(5003).repartition(3), {"a": 0.29, "b": 0.29, "c": 0.42}).orderBy("seq").collect()
    assert big.filter("split = 'a'").join(ratio_split(pairs(5003), {"a": 0.29, "b": 0.71}, seed=1).filter("split = 'a'"), "seq").count() < 600


def test_equal_ids_do_not_break_the_split(spark):
    same = spark.range(2000).selectExpr("id AS seq", "'same' AS id")
    assert sizes(ratio_split(same, {"a": 0.3, "b": 0.7})) == {"a": 600, "b": 1400}


def test_split_spec():
    assert parse_split("train=0.9, val=0.1") == {"train": 0.9, "val": 0.1}
    assert parse_split(None) == {}
    with pytest.raises(ValueError):
        check_ratios({"a": 0.5, "b": 0.4})


def test_export_filters_by_context(pairs_of, judgments_of, labels_of):
    pairs = pairs_of([("a", "1", "x"), ("b", "2", "x"), ("c", "3", "x")])
    kept = filter_pairs(pairs, "scores.overall / 2 > 2 AND NOT (label.status <=> 'rejected')", judgments_of([("a", True, 9), ("b", True, 9)]), labels_of([("b", "rejected")]))
    assert [r.id for r in kept.collect()] == ["a"] and kept.columns == pairs.columns
    assert filter_pairs(pairs, "try_divide(scores.overall, 0) > 1").count() == 0
    assert sizes(export(pairs, None, split="x=0.4,y=0.6")) == {"x": 1, "y": 2}


# ----- generation -----

def test_templates(spark):
    seeds = spark.createDataFrame([(0, "a {seed} b")], "seq int, seed string")
    prompt = lambda t: generate.generation_requests(seeds, t).first().prompt
    assert "question-answer" in prompt("qa") and "reasoning problem" in prompt("REASONING") and "creative writing" in prompt("Creative")
    assert prompt("unknown") == prompt("INSTRUCTION") and "a {seed} b" in prompt("QA") and '{\n    "instruction"' in prompt("QA")
    assert [r.seed for r in generate.seed_list(spark, " a, b,, c ,").orderBy("seq").collect()] == ["a", "b", "c"]


CASES = [
    ('{"instruction":"Test","input":"i","output":"Result","category":"c"}', ("Test", "Result", "c")),
    ('{"output":"only"}', ("", "only", None)), ("plain text ", ("s", "plain text ", None)),
    ('```json\n{"instruction":"T"}\n```', ("s", '```json\n{"instruction":"T"}\n```', None)),
    ("[1]", ("s", "[Generation failed]", None)), ('{"instruction":null}', ("s", "[Generation failed]", None)),
    ('{"output":5}', ("s", "[Generation failed]", None)), ('{"category":null}', ("", "", None)), ('{"category":7}', ("s", "[Generation failed]", None)),
    ('{"a":1} x', ("s", '{"a":1} x', None)), (None, ("s", "[Generation failed]", None)),
]


def test_generated_texts(spark):
    seeds = spark.createDataFrame([(i, "s") for i in range(len(CASES))], "seq int, seed string")
    answers = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES) if c[0] is not None], "seq int, response string")
    rows = generate.generated_pairs(seeds, answers, 2).orderBy("seq").collect()
    assert [(r.instruction, r.output, r.category) for r in rows] == [c[1] for c in CASES]
    assert {r.cycle_id for r in rows} == {2} and {r.input for r in rows} == {None} and len({r.id for r in rows}) == len(CASES)
    fenced = generate.parse_generated(seeds.withColumn("response", F.lit('```json\n{"instruction":"T"}\n```')), strip_fences=True)
    assert fenced.first().instruction == "T"
