"""Splits by content, recovery, time, streams with state, sketches, ranges, subtotals, custom checks, sequence checksums."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from pairloom.operators import bands, checks, compare, export, ingest, judge, labels, profile
from pairloom.plans import curate
from pairloom.session import new_folder, recover_folder, replace_folder
from pairloom.sources import readers, store
from pairloom.streaming import append, state

DAY = dt.datetime(2024, 1, 1)


def at(minutes):
    return DAY + dt.timedelta(minutes=minutes)


@pytest.fixture
def pairs_of(pairs_of):
    """Pairs from (instruction, output)."""
    return lambda rows: pairs_of([(n, *r) for n, r in enumerate(rows)])


def test_members_do_not_depend_on_paths(spark, tmp_path):
    lines = [json.dumps({"prompt": f"q {n}", "completion": f"a {n}"}) for n in range(200)]
    seen = []
    for name, cut in (("one", 200), ("other", 37)):
        (tmp_path / name).mkdir()
        for i in range(0, 200, cut):
            (tmp_path / name / f"{name}-{i:03}.jsonl").write_text("\n".join(lines[i:i + cut]))
        pairs = ingest.ingest(readers.read_rows(spark, str(tmp_path / name), "jsonl"))
        splits = {r.id: r.split for r in export.ratio_split(pairs, {"train": 0.5, "test": 0.5}).collect()}
        sample = {r.id for r in judge.sample_pairs(pairs, 0.3, 40).collect()}
        seen.append((splits, sample))
    assert seen[0] == seen[1] and sorted(seen[0][0].values()).count("train") == 100 and len(seen[0][1]) == 40


def test_split_of_rows_with_one_id(spark, pairs_of):
    pairs = pairs_of([("same", "same")] * 300 + [(f"i{n}", "o") for n in range(100)])
    pairs = pairs.withColumn("id", F.col("instruction"))
    for ratio in (0.1, 0.5, 0.9):
        made = export.ratio_split(pairs, {"a": ratio, "b": 1 - ratio})
        assert made.filter("split = 'a'").count() == int(400 * ratio)


def test_label_step_after_an_empty_one(spark, pairs_of):
    raw = pairs_of([("question one", "answer"), ("question two", "answer two")]).select("seq", "instruction", "output")
    job = {"dataset": "d", "steps": [
        {"ingest": {"input": raw}},
        {"label": {"mode": "bulk", "where": "output = 'nothing'", "set_status": "rejected"}},
        {"label": {"mode": "bulk", "where": "output = 'answer'", "set_status": "approved"}}]}
    root = new_folder(spark, "job")
    curate.run_job(spark, job, root)
    assert [(r.status, r.seq.step) for r in store.DatasetStore(spark, root).get("labels", dataset="d").collect()] == [("approved", 0)]


def test_scorer_that_fails_often(spark, pairs_of):
    def answer(prompts, temperature):
        for p in prompts:
            if int(p.split("INSTRUCTION:\n")[1].split("\n")[0].split()[1]) % 2:
                raise ValueError("odd")
            yield '{"coherence": 8, "accuracy": 8, "helpfulness": 8}'

    pairs = pairs_of([(f"number {n}", "o") for n in range(3000)]).coalesce(1)
    made = judge.judge(pairs, judge.python_scorer(answer))
    assert made.groupBy("passed").count().orderBy("passed").collect() == [(False, 1500), (True, 1500)]
    assert made.filter("NOT passed AND judgment_reasoning = 'Judgment failed: ValueError: odd'").count() == 1500


def test_replacement_that_was_cut_off(spark, monkeypatch):
    path = os.path.join(new_folder(spark, "kept"), "kind", "dataset=a")
    replace_folder(spark, path, spark.range(3).write.parquet)
    replace_folder(spark, path, spark.range(5).write.parquet)
    assert spark.read.parquet(path).count() == 5 and os.listdir(os.path.dirname(path)) == ["dataset=a"]
    aside = os.path.join(os.path.dirname(path), "_old-dataset=a")
    os.rename(path, aside)  # the run ended between the two moves
    root = os.path.dirname(os.path.dirname(path))
    assert store.DatasetStore(spark, root).get("kind", dataset="a").count() == 5 and not os.path.exists(aside)
    os.rename(path, aside)
    spark.range(7).write.parquet(path)  # ended before the old one was deleted
    recover_folder(spark, path)
    assert spark.read.parquet(path).count() == 7 and not os.path.exists(aside)
    os.rename(path, aside)
    with pytest.raises(Exception):
        replace_folder(spark, path, spark.range(1).selectExpr("raise_error('x') AS id").write.parquet)
    assert spark.read.parquet(path).count() == 7


def test_cache_texts_move_for_hits_only(spark, pairs_of):
    pairs = pairs_of([("one", "a"), ("two", "b"), ("three", "c")]).withColumn("id", F.col("instruction"))
    old = judge.cache_rows(judge.judge(pairs.limit(2), judge.rule_scorer), judge.BUILTIN, "", "", written=1)
    new = judge.cache_rows(judge.judge(pairs.limit(1), judge.rule_scorer), judge.BUILTIN, "", "", written=2)
    cache = old.unionByName(new.withColumn("judgment_reasoning", F.lit("newer"))).unionByName(new.withColumn("judgment_reasoning", F.lit("newer")))
    run = judge.judge_incremental(pairs, cache, judge.rule_scorer)
    assert run.stats.first() == (2, 1, 1)
    assert sorted(r.judgment_reasoning for r in run.judgments.collect()) == ["newer", "rule", "rule"]


def test_labels_as_of_the_verdict(spark):
    rng = random.Random(4)
    log = [(n, rng.choice(["hot", "hot", "x", "y"]), rng.choice(["approved", "rejected"]), "u", at(rng.randrange(500)) if n % 17 else None) for n in range(700)]
    asked = [(n, rng.choice(["hot", "hot", "x", "y", "z"]), rng.random() < 0.5, at(rng.randrange(-5, 520)) if n % 13 else None) for n in range(400)]
    labels_ = spark.createDataFrame(log, "seq int, pair_id string, status string, labeler string, labeled_at timestamp")
    verdicts = spark.createDataFrame(asked, "seq int, pair_id string, passed boolean, judged_at timestamp")
    made = {r.seq: r.known and r.known.status for r in compare.labels_as_of(verdicts, labels_).collect()}
    want = {}
    for seq, pair, _, when in asked:
        known = [(t, s, status) for s, p, status, _, t in log if p == pair and t is not None and when is not None and t <= when]
        want[seq] = max(known)[2] if known else None
    assert made == want and len(made) == 400 and None in made.values()
    counted = compare.calibrate_as_of(verdicts, labels_).first()
    both = [(p, want[s] == "approved") for s, _, p, _ in asked if want[s]]
    assert (counted.tp, counted.fp, counted.tn, counted.fn) == tuple(both.count(x) for x in ((True, True), (True, False), (False, False), (False, True)))
    assert compare.labels_as_of(verdicts, labels_.limit(0)).filter("known IS NOT NULL").count() == 0


def label_file(path, rows):
    path.write_text("\n".join(json.dumps({"pair_id": p, "status": s, "labeled_at": t.isoformat() + "Z"}) for p, s, t in rows) + "\nnot json\n{}\n")


def test_labels_as_they_arrive(spark, tmp_path):
    folder, path, checkpoint = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "checkpoint")
    folder.mkdir()

    def run():
        state.follow_labels(state.label_lines(spark, str(folder), 1), path, checkpoint, late="2 hours", width="1 hour").awaitTermination()
        return {r.pair_id: r.status for r in state.followed_labels(spark, path).collect()}

    label_file(folder / "a.jsonl", [("p", "approved", at(10)), ("q", "rejected", at(20)), ("p", "approved", at(10))])
    assert run() == {"p": "approved", "q": "rejected"}
    label_file(folder / "b.jsonl", [("p", "skipped", at(5)), ("q", "approved", at(70)), ("r", "rejected", at(300))])   # late, newer, new
    assert run() == {"p": "approved", "q": "approved", "r": "rejected"}
    label_file(folder / "c.jsonl", [("p", "rejected", at(40)), ("r", "rejected", at(300)), ("r", "approved", at(290))])   # p is too late
    assert run() == {"p": "approved", "q": "approved", "r": "rejected"} and run() == run()


def test_pairs_as_they_arrive(spark, tmp_path):
    folder, path, checkpoint = tmp_path / "in", str(tmp_path / "pairs"), str(tmp_path / "checkpoint")
    folder.mkdir()

    def run(name, texts, age):
        (folder / name).write_text("\n".join(json.dumps({"prompt": t, "completion": "c"}) for t in texts))
        os.utime(folder / name, (1_700_000_000 + age,) * 2)
        rows = ingest.normalize_rows(append.appended_lines(spark, str(folder), 1), order="arrived")
        state.follow_pairs(rows, path, checkpoint, late="1 hour").awaitTermination()
        return sorted(r.instruction for r in spark.read.parquet(path).collect())

    assert run("a", ["x", "y", "x"], 0) == ["x", "y"]
    assert run("b", ["y", "z"], 60) == ["x", "y", "z"]
    assert run("c", ["w"], 90_000) == ["w", "x", "y", "z"]
    assert run("d", ["x", "v", "w"], 180_000) == ["v", "w", "x", "y", "z"]  # x has left the state, not the table


def test_label_sessions(spark):
    rows = [("a", "approved", at(0)), ("a", "rejected", at(29)), ("a", "approved", at(60)), ("a", "skipped", at(200)), ("b", "approved", at(3)), ("b", "approved", None)]
    log = spark.createDataFrame(rows, "labeler string, status string, labeled_at timestamp")
    made = [tuple(r) for r in labels.label_sessions(log).orderBy("labeler", "started").collect()]
    assert made == [("a", at(0), at(29), 2, 1, 0, 1, 0, 29.0, 120 / 29, None), ("a", at(60), at(60), 1, 1, 0, 0, 0, 0.0, None, 31.0),
                    ("a", at(200), at(200), 1, 0, 0, 0, 1, 0.0, None, 140.0), ("b", at(3), at(3), 1, 1, 0, 0, 0, 0.0, None, None)]


def test_sketches_merge(spark):
    rows = spark.range(60_000).selectExpr("id % 7 AS part", "id % 2 AS half", "CAST((id * 7919) % 60000 AS DOUBLE) AS value", "CAST(id % 20000 AS STRING) AS item")
    stored = profile.sketches(rows, ["half", "part"], "value", "item")
    found = {r.share: r for r in profile.read_sketches(profile.merge_sketches(stored, ["half"]), [0.1, 0.5, 0.9]).filter("half = 0").collect()}
    assert all(abs(found[s].value / 60_000 - s) < 0.011 and found[s].n == 30_000 and abs(found[s].distinct - 10_000) < 500 for s in found)
    assert len(found) == 3


def test_band_join(spark):
    rng = random.Random(8)
    rows = [(n, rng.choice([rng.uniform(-50, 50), 7.0, None])) for n in range(500)]
    edges = [(n, rng.choice([None, rng.uniform(-60, 40), 7.0]), None) for n in range(60)]
    edges = [(n, a, rng.choice([None, a, (a or 0) + rng.choice([1e-6, 0.3, 5.0, 80.0, -1.0])])) for n, a, _ in edges]
    values = spark.createDataFrame(rows, "id int, v double")
    table = spark.createDataFrame(edges, "band int, low double, high double")
    joined = bands.band_join(values, "v", table)
    want = {(i, b) for i, v in rows if v is not None for b, low, high in edges if (low is None or low <= v) and (high is None or v < high)}
    got = [(r.id, r.band) for r in joined.collect()]
    assert set(got) == want and len(got) == len(want) and joined.columns == ["id", "v", "band", "low", "high"]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = bands.band_join(values, "v", table)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "CartesianProduct" not in plan
    assert bands.band_join(values, "v", table.limit(0)).count() == 0 and bands.band_join(values.limit(0), "v", table).count() == 0


def test_checks_of_a_caller(spark, pairs_of):
    def twice(instruction, output):
        if output == "boom":
            yield "warning", "before", None
            raise RuntimeError("no")
        if instruction == output:
            yield "error", "echo", "output"

    pairs = pairs_of([("same", "same"), ("a question", "boom"), ("fine", "answer"), ("x", "y")])
    facts = checks.check_facts(pairs, ["length"], custom={"echo": twice}, keep=("category",))
    found = sorted((r.seq, r.check, r.severity, r.message) for r in checks.issues(facts).collect())
    assert found == [(0, "echo", "error", "echo"), (1, "echo", "error", "echo failed: RuntimeError: no"), (1, "echo", "warning", "before"),
                     (3, "length", "warning", "instruction shorter than 3 chars")]
    assert {r.key: r.n for r in checks.report(facts).collect()} == {"echo": 3, "length": 1, "severity:error": 2, "severity:warning": 2, "total_pairs": 4}
    assert sorted(r.seq for r in checks.clean(pairs, facts).collect()) == [2, 3]
    assert checks.validate(pairs, ["length"], custom={"echo": twice}).count() == 4
    cube = {(r.check, r.severity, r.level): r.n for r in checks.issue_cube(facts).collect()}
    assert cube[None, None, 3] == 4 and cube["echo", None, 1] == 3 and cube[None, "error", 2] == 2 and cube["length", "warning", 0] == 1


def test_language_of_a_detector(spark, pairs_of):
    pairs = pairs_of([("der Hund", "x"), ("the dog", "x")]).withColumn("id", F.col("seq").cast("string"))
    table = spark.createDataFrame([("0", "en"), ("1", "de")], "id string, lang string")
    found = lambda **o: [r.seq for r in checks.validate(pairs, ["lang"], checks.Options(lang="en", **o)).collect()]
    assert found() == [0] and found(lang_table=table) == [1] and found(lang_column=F.lit("fr")) != [] and found(lang_column=F.lit("en")) == []
    plan = checks.check_facts(pairs, ["lang"], checks.Options(lang="en"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_sequence_checksum(spark, pairs_of):
    texts = [(f"i{n}", f"o{n}") for n in range(500)]
    pairs = pairs_of(texts)
    one = ingest.sequence_fingerprint(pairs.coalesce(1)).first()
    assert ingest.sequence_fingerprint(pairs.repartition(13)).first() == one and one.row_count == 500
    texts[3], texts[4] = texts[4], texts[3]
    assert ingest.sequence_fingerprint(pairs_of(texts)).first().checksum != one.checksum
    halves = [ingest.sequence_fingerprint(pairs.filter(c)).withColumn("place", F.lit(n)) for n, c in enumerate(("seq < 123", "seq >= 123"))]
    assert ingest.combine_fingerprints(halves[0].unionByName(halves[1])).first() == one
    assert ingest.sequence_fingerprint(pairs.limit(0)).first() == (0, 0, 1)
