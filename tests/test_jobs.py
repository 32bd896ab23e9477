"""Chart data, cycles, the loop, the whole job, streams, plans."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from workload import inputs as I
from workload.registry import QUERIES
from pairloom.operators.export import filter_pairs
from pairloom.functions import variants as V
from pairloom.operators import checks, cycles, ingest, judge, labels, profile
from pairloom.plans import curate, loop
from pairloom.session import new_folder
from pairloom.sources.readers import read_table
from pairloom.sources.store import DatasetStore
from pairloom.streaming.append import append_to, appended_lines

SF = "/root/testdata/sf0.001"


def test_histograms_like_numpy(pairs_of, judgments_of):
    for lengths in ([1, 2, 3, 50, 51, 100, 100], [7, 7, 7], [0, 20, 10, 5, 15, 19], list(range(41)), [3, 10, 17, 24, 31, 38, 45, 52, 59, 66, 73]):
        pairs = pairs_of([(i, "x" * n, "y") for i, n in enumerate(lengths)])
        rows = profile.length_histograms(pairs).filter("field = 'instruction'").collect()
        counts, edges = np.histogram(lengths, bins=20)
        assert {r.bin: r.n for r in rows} == {i: int(c) for i, c in enumerate(counts)}
        assert {(r.lo, r.hi) for r in rows} == {(edges[0], edges[-1])}
    scores = [0, 0.99, 1, 5, 9, 9.99, 10, 10]
    rows = profile.score_histogram(judgments_of([(i, True, s) for i, s in enumerate(scores)])).orderBy("bin").collect()
    assert [r.n for r in rows] == list(np.histogram(scores, bins=range(11))[0])


def test_other_charts(pairs_of, judgments_of, labels_of):
    js = judgments_of([("a", True, 9, "v1"), ("b", False, 3, "v1"), ("a", True, 7, "v2"), ("a", False, 2, "v2")])
    assert {r.outcome: r.n for r in profile.pass_fail_counts(js).collect()} == {"passed": 2, "failed": 2}
    assert {(r.a_pass, r.b_pass): r.n for r in profile.agreement_matrix(js).collect()} == {
        (True, True): 0, (True, False): 1, (False, True): 0, (False, False): 0}
    assert profile.agreement_matrix(js.filter("tag = 'v1'")).count() == 0
    assert {r.criterion: r["mean"] for r in profile.criterion_means(js).collect()}["overall"] == pytest.approx(21 / 4)
    assert profile.criterion_means(js.limit(0)).count() == 0
    pairs = pairs_of([(i, "x", "y") for i in range(25)], category=[f"c{i % 23}" for i in range(25)])
    top = profile.top_categories(pairs).collect()
    assert len(top) == 20 and [r.category for r in top[:3]] == ["c0", "c1", "c2"] and top[0].n == 2
    dist = profile.label_distribution(labels.latest_labels(labels_of([("a", "skipped"), ("b", "approved"), ("a", "odd")]))).orderBy("position")
    assert [(r.status, r.n) for r in dist.collect()] == [("approved", 1), ("odd", 1)]
    assert tuple(profile.overview(pairs, js, js).first()) == (25, 2, 4, 4)


def test_failure_seeds_keep_order_and_duplicates(spark, pairs_of, judgments_of):
    pairs = pairs_of([("a", "A", "x"), ("b", "", "x"), ("c", "C", "x"), ("a", "later", "x")] + [(f"k{i}", f"K{i}", "x") for i in range(20)])
    js = judgments_of([("c", False, 1), ("a", False, 1), ("b", False, 1), ("zz", False, 1), ("a", False, 1), ("k0", True, 9)] + [(f"k{i}", False, 1) for i in range(1, 20)])
    got = [r.seed for r in cycles.failure_seeds(pairs, js).orderBy("seq").collect()]
    assert got == ["C", "A", "A"] + [f"K{i}" for i in range(1, 8)]
    base = spark.createDataFrame([(0, "base"), (5, "A")], "seq bigint, seed string")
    listed = cycles.next_seeds(base, cycles.failure_seeds(pairs, js)).orderBy("seq").collect()
    assert [r.seed for r in listed] == ["base", "A", *got]


def test_cycle_metrics_and_report(spark):
    pairs = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "d"), (3, "e")], "cycle_id int, id string")
    js = spark.createDataFrame([(0, 1, "a", True, 8.0), (1, 1, "b", False, 6.0), (2, 3, "e", True, 9.0)], "seq bigint, cycle_id int, pair_id string, passed boolean, o double")
    js = js.selectExpr("*", "struct(o AS coherence, o AS accuracy, o AS helpfulness, o AS overall) AS scores")
    m = cycles.cycle_metrics(pairs, js)
    rows = {r.cycle_id: (r.generated, r.passed, r.failed, r.pass_rate, r.avg_quality) for r in m.collect()}
    assert rows[1] == pytest.approx((3, 1, 2, 1 / 3, 7.0)) and rows[2] == (1, 0, 1, 0.0, 0.0)
    totals = cycles.report_totals(m).first()
    assert (totals.total_generated, totals.total_failed, totals.best_cycle) == (5, 3, 3)
    tied = cycles.report_totals(m.withColumn("pass_rate", F.lit(0.5))).first()
    assert tied.best_cycle == 1
    assert {r.cycle_id: r.pass_rate_class for r in cycles.report_cycles(m).collect()} == {1: "low", 2: "low", 3: "high"}
    assert cycles.loop_summary(m.limit(0)).first().avg_pass_rate == 0.0
    docs = cycles.json_report(m).orderBy("position").collect()
    assert json.loads(docs[0].document)["total_passed_pairs"] == 2 and json.loads(docs[1].document)["cycle_id"] == 1


def test_loop_stops_resumes_and_feeds_back(spark):
    base = spark.createDataFrame([(0, "one"), (1, "two")], "seq bigint, seed string")
    echo = lambda req: req.withColumn("response", F.to_json(F.struct(F.col("seed").alias("instruction"), F.lit("out").alias("output"))))
    verdict = lambda ok: lambda req: req.withColumn("response", F.when(F.col("prompt").contains(ok), '{"overall": 9, "passed": true}').otherwise('{"passed": false}'))
    store = DatasetStore(spark, new_folder(spark, "loop"))
    m = loop.run_loop(store, base, echo, verdict("one"), max_cycles=3)
    assert [(r.cycle_id, r.generated, r.passed) for r in m.orderBy("cycle_id").collect()] == [(1, 2, 1), (2, 3, 1), (3, 4, 1)]
    assert [r.seed for r in store.get("cycle_seeds", loop_run=1, cycle_id=2).orderBy("seq").collect()] == ["one", "two", "two"]
    assert store.get("training", loop_run=1, cycle_id=1).count() == 1 and store.last_cycle() == 3
    more = loop.run_loop(store, base, echo, verdict("nothing"), max_cycles=9, resume=True)
    assert sorted(r.cycle_id for r in more.collect()) == [1, 2, 3, 4]
    assert store.cycles("cycle_metrics", upto=2).count() == 2
    stopped = loop.run_loop(store, base, echo, verdict("one"), max_cycles=9, resume=True)   # cycle 4 was below the limit
    assert stopped.count() == 4
    again = loop.run_loop(store, base, echo, verdict("one"), max_cycles=1)
    assert [r.cycle_id for r in again.collect()] == [1] and store.last_run() == 2
    longer = loop.run_loop(store, base, echo, verdict("one"), max_cycles=3, resume=True)    # goes on after its own cycle 1
    assert [(r.cycle_id, r.generated, r.passed) for r in longer.orderBy("cycle_id").collect()] == [(1, 2, 1), (2, 3, 1), (3, 4, 1)]


def test_job_steps_and_errors(spark, tmp_path):
    rows = [{"prompt": "What is 2+2?", "completion": "4"}, {"prompt": "What is 3+3?", "completion": "6"}, {"prompt": "Bad example", "completion": ""}]
    path = tmp_path / "raw.jsonl"
    path.write_text("\n".join(map(json.dumps, rows)))
    root, out = new_folder(spark, "job"), new_folder(spark, "out")
    config = {"dataset": "d", "steps": [
        {"ingest": {"input": str(path)}}, {"validate": {"write_clean": True}}, {"judge": {"tag": "t"}}, {"judge": {"tag": "t2"}},
        {"label": {"mode": "auto-from-judge", "judgments": "auto"}}, {"label": {"mode": "auto-from-judge", "judgments": "auto", "resume": True}},
        {"label": {"mode": "bulk", "where": "output = ''", "set_status": "rejected"}}, {"label": {"mode": "interactive", "resume": True}},
        {"export": {"to": out, "split": {"train": 0.7, "val": 0.3}}}, {"compare": {"tags": ["t", "t2"]}}, {"calibrate": {"tag": "t"}}, {"visualize": {}}]}
    job = curate.run_job(spark, config, root)
    r = job.results
    assert r["1.ingest"].first().pairs == 3
    assert {x.key: x.n for x in r["2.validate"].collect()}["schema"] == 1
    assert job.store.get("pairs", dataset="d.clean").count() == 2
    assert r["3.judge"].first().judged == 3 and r["10.compare"].first().n_common == 3 and r["10.compare"].first().pass_agreement == 1.0
    assert r["6.label"].count() == 0 and [(x.status, x.n) for x in r["7.label"].collect()] == [("rejected", 1)]
    assert r["8.label"].count() == 0 and r["11.calibrate"].first().n_evaluated == 3
    assert {x.split: x.n for x in r["9.export"].collect()} == {"train": 2, "val": 1}
    assert {x.chart for x in r["12.visualize"].collect()} == {"categories", "lengths", "validation", "pass_fail", "scores", "criteria", "agreement", "labels"}
    assert {x.artifact: x.status for x in curate.dataset_info(job).collect()}["labels"] == "present"
    for bad in ({"steps": []}, {"dataset": "d", "steps": [{"dance": {}}]}, {"dataset": "d", "steps": [{"a": 1, "b": 2}]}):
        with pytest.raises(ValueError):
            curate.run_job(spark, bad, root)
    with pytest.raises(ValueError, match="error"):
        curate.run_job(spark, {"dataset": "d", "steps": [{"validate": {"fail_on": "error"}}]}, root)
    assert curate.run_job(spark, {"dataset": "d", "steps": [{"ingest": {"input": str(path), "dry_run": True}}]}, root).results["1.ingest"].count() == 3


def test_appended_files_are_processed_once(spark, tmp_path):
    folder, out, mark = tmp_path / "in", new_folder(spark, "stream"), new_folder(spark, "mark")
    folder.mkdir()
    clean = lambda rows: ingest.drop_empty(ingest.normalize_rows(rows, order="arrived"))
    (folder / "1.jsonl").write_text('{"prompt":"a","completion":"b"}\nbroken\n{"prompt":"","completion":""}\n')
    append_to(appended_lines(spark, str(folder)), clean, out, mark).awaitTermination()
    (folder / "2.jsonl").write_text('{"prompt":"a","completion":"b"}\n{"prompt":"c","completion":"d"}\n')
    append_to(appended_lines(spark, str(folder)), clean, out, mark).awaitTermination()
    stored = read_table(spark, out)
    assert sorted(r.instruction for r in stored.collect()) == ["a", "a", "c"]
    assert ingest.drop_exact_copies(stored).count() == 2


def test_stateless_operators_accept_streams(spark, tmp_path):
    schema = "seq bigint, id string, pair_id string, instruction string, output string, response string"
    rows = spark.createDataFrame([(1, "a", "a", "", "x", '{"overall": 9, "coherence": 9, "accuracy": 9, "helpfulness": 9}')], schema)
    path = new_folder(spark, "rows")
    rows.write.parquet(path)
    stream = lambda: spark.readStream.schema(schema).parquet(path)
    results = {
        "facts": lambda df: checks.check_facts(df), "verdicts": lambda df: judge.verdicts(df.select("seq", "pair_id", "response")),
        "labels": lambda df: labels.auto_label(judge.verdicts(df.select("seq", "pair_id", "response"))),
    }
    for name, operator in results.items():
        out = new_folder(spark, name)
        append_to(stream(), operator, out, new_folder(spark, "mark")).awaitTermination()
        assert spark.read.parquet(out).count() == 1


# ----- plans -----

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Functions of the caller, and the checksum that folds rows in their order.
HOOK = ("python_scoring", "failing_scorer", "custom_check", "sequence_checksum")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_only_the_scorer_hook_uses_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert name in HOOK or "Python" not in text and "InPandas" not in text and "InArrow" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_conditions_on_pairs_reach_the_scan(spark):
    pairs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id AS seq", "CAST(doc_id AS STRING) AS id", "text AS output", "source AS category")
    judged = judge.latest_judgments(I.judge_log(spark, SF))
    text = plan(filter_pairs(pairs, "category = 'src1' AND scores.overall >= 4", judged))
    assert "EqualTo(source,src1)" in text


def test_wide_rows_move_once(spark):
    """First wins: the texts are not sorted, and are shuffled by the unique row order only."""
    pairs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id AS seq", "text AS instruction", "text AS output", "CAST(doc_id AS STRING) AS id")
    text = plan(ingest.drop_exact_copies(pairs))
    assert text.count("Exchange hashpartitioning(seq") <= 2 and "SortAggregate" not in text
    wide = [line for line in text.splitlines() if "Exchange" in line and "instruction" in line]
    assert not wide or all("hashpartitioning(seq" in line for line in wide)


def test_splits_do_not_shuffle_the_texts(spark):
    from pairloom.operators.export import ratio_split
    pairs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id AS seq", "text AS output", "CAST(doc_id AS STRING) AS id")
    outer = plan(ratio_split(pairs, {"a": 0.5, "b": 0.5})).split("Subquery")[0]
    assert "Exchange" not in outer


def test_row_checks_read_each_text_once(spark):
    pairs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id AS seq", "text AS instruction", "text AS output", "CAST(doc_id AS STRING) AS id")
    text = plan(checks.validate(pairs, ["schema", "length", "pii"]))
    assert text.count("FileScan") == 1 and "Exchange" not in text


def test_number_like_names_stay_text(spark):
    store = DatasetStore(spark, new_folder(spark, "names"))
    store.put(spark.range(3).selectExpr("id AS seq"), "judgments", dataset="007", tag="2024-01-01")
    assert {(r.dataset, r.tag) for r in store.get("judgments").collect()} == {("007", "2024-01-01")}
    assert store.get("judgments", dataset="007").count() == 3 and store.find("labels", dataset="007") is None


def test_hot_ids_count_fully(spark):
    pairs = spark.range(300).selectExpr("id AS seq", "1 AS cycle_id", "CASE WHEN id < 100 THEN 'h' ELSE CAST(id AS STRING) END AS id")
    js = spark.createDataFrame([(0, 1, "h", False), (1, 1, "h", True), (2, 1, "200", True)], "seq bigint, cycle_id int, pair_id string, passed boolean") \
        .selectExpr("*", "struct(1D AS coherence, 1D AS accuracy, 1D AS helpfulness, 1D AS overall) AS scores")
    m = cycles.cycle_metrics(pairs, js).first()
    assert (m.generated, m.passed, m.failed) == (300, 101, 199)


def test_tag_filter_prunes_partitions(spark):
    store = DatasetStore(spark, new_folder(spark, "prune"))
    for tag in ("a", "b"):
        store.put(spark.range(3).selectExpr("id AS seq"), "judgments", dataset="d", tag=tag)
    assert store.get("judgments", dataset="d").filter("tag = 'a'").inputFiles() != [] and \
        "PartitionFilters: [isnotnull(tag" in plan(store.get("judgments", dataset="d").filter("tag = 'a'"))


# ----- SQL twins -----

from tests.oracle import compare, connect  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_sql_twin(spark, duck, name):
    problem = compare(spark, duck, SF, entry.queries()[name], entry.oracle_sql()[name])
    assert problem == "", problem


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["step", "item", "key", "value"] and df.count() > 20


def test_staged_tables_go_with_their_owner(spark):
    import os

    from pairloom.session import scratch, stage

    kept = stage(spark.range(3))
    with scratch(spark):
        gone = stage(spark.range(3))
        assert gone.count() == 3
    where = lambda df: df.inputFiles()[0].removeprefix("file://")
    files = [where(kept), where(gone)]
    assert [os.path.exists(f) for f in files] == [True, False]
