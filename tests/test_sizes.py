"""Queries on tables that lie in several files, and with more partitions than files."""

import glob
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from pairloom.functions.rows import small_batches
from pairloom.operators import bands, checks, export, judge
from pairloom.plans import curate, loop
from pairloom.session import new_folder, stage
from pairloom.sources import blocks
from pairloom.sources.store import DatasetStore
from pairloom.streaming import state
from tests import oracle
from workload import inputs as I
from workload import data_queries, extended_queries, job_queries, judging_queries  # noqa: F401
from workload.registry import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
SPREAD = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def settings(spark):
    """Settings of a session until the test ends."""
    before = {}

    def put(values):
        for k, v in values.items():
            before.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)

    yield put
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def agrees(spark, name, folder):
    return oracle.compare(spark, oracle.connect(folder), folder, QUERIES[name], ORACLES[name])


def test_every_file_holds_one_json_document(spark, settings):
    settings(SPREAD)
    assert agrees(spark, "large_json_documents", SMALL) == ""


def test_bands_are_joined_once_for_each_value(spark, monkeypatch):
    seen, join = [], bands.band_join

    def watched(rows, *rest, **more):
        seen.append(rows.count())
        return join(rows, *rest, **more)

    monkeypatch.setattr(bands, "band_join", watched)
    assert agrees(spark, "score_bands", SMALL) == ""
    assert seen and max(seen) <= 101   # the scores follow from the document's number modulo 101


def test_totals_of_bands(spark):
    rows = spark.createDataFrame([(1, 2.0), (2, 2.0), (3, 9.0), (4, None)], "id int, x double")
    ranges = spark.createDataFrame([(1, 0.0, 3.0), (2, 2.0, None), (3, 2.0, 2.0), (4, None, 2.0)], "b int, low double, high double")
    found = bands.band_totals(rows, "x", ranges, [F.count(F.lit(1)).alias("n"), F.sum("b").alias("s")])
    assert sorted(map(tuple, found.select("id", "n", "s").collect())) == [(1, 2, 3), (2, 2, 3), (3, 1, 2)]


def test_clean_set_of_files_keeps_copies_in_other_spelling(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(20)
    again = docs.withColumns({"doc_id": F.col("doc_id") + 10**6, "text": F.upper("text")})
    docs.unionByName(again).write.parquet(f"{tmp_path}/one/documents.parquet")
    spark.read.parquet(f"{tmp_path}/one/documents.parquet").toPandas().to_parquet(f"{tmp_path}/documents.parquet")
    assert agrees(spark, "cleaned_files", str(tmp_path)) == ""


def test_rows_of_a_block_are_taken_as_they_come():
    taken = []
    rows = (taken.append(n) or (n,) for n in range(1000))
    assert next(blocks._with_end(rows)) == (0,) and len(taken) == 1
    assert list(blocks._with_end(iter([(1,), (2,)]))) == [(1,), (2,), None]


def test_files_do_not_multiply_with_conversations(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(data_queries, "new_folder", lambda spark, name: f"{tmp_path}/{name}-1")
    assert agrees(spark, "json_documents", SMALL) == ""
    conversations = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id").distinct().count()
    files = list(tmp_path.glob("json-*/**/part-*"))
    assert files and len(files) <= 8 < conversations


def test_each_line_of_a_stream_is_parsed_once(spark, tmp_path):
    (tmp_path / "a.txt").write_text("{}")
    lines = state.label_lines(SimpleNamespace(readStream=spark.read), str(tmp_path))   # the same rows as no stream, which has a plan
    assert lines._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_streamed_files_come_from_many_tasks(spark, tmp_path, monkeypatch, settings):
    spark.read.parquet(f"{SMALL}/documents.parquet").repartition(12).write.parquet(f"{tmp_path}/in/documents.parquet")
    settings({"spark.sql.files.openCostInBytes": str(128 << 20)})   # a task for each file
    monkeypatch.setattr(extended_queries, "new_folder", lambda spark, name: f"{tmp_path}/{name}-1")
    rows = extended_queries.streamed_pairs(spark, f"{tmp_path}/in")
    assert rows.count() == rows.select("id").distinct().count() > 0
    assert len(list(tmp_path.glob("pair-files-1/part-*"))) > 6


def test_large_batches_are_cut(spark, pairs_of):
    sizes = []

    def answer(prompts, temperature):
        return [str(sum(map(len, prompts)))] * len(prompts)

    pairs = pairs_of([(n, "a", "x" * 100_000) for n in range(64)]).coalesce(1)
    told = judge.python_scorer(answer)(judge.judge_requests(pairs)).select("response").collect()
    sizes = [int(r["response"]) for r in told]
    assert len(sizes) == 64 and max(sizes) < 2 << 20


def test_batches_of_a_custom_check_are_cut(spark, pairs_of):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 1000] * 10_000)], names=["t"])
    parts = list(small_batches()([batch]))
    assert sum(p.num_rows for p in parts) == 10_000 and max(p.num_rows for p in parts) * 1000 <= 1 << 20
    plan = checks.custom_issues(pairs_of([("1", "a", "b")]), "c", lambda i, o: [])._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan


def test_training_rows_are_found_in_their_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(export, "MARKS", 8)   # several bitmaps for each file
    rows = spark.range(0, 100, 1, 3).selectExpr("id AS seq", "CAST(id % 90 AS STRING) AS id", "repeat('x', 50) AS instruction")
    rows.write.parquet(f"{tmp_path}/pairs")
    pairs = spark.read.parquet(f"{tmp_path}/pairs")
    judged = spark.range(120).selectExpr("id AS seq", "CAST(id % 95 AS STRING) AS pair_id", "id % 3 = 0 OR id > 110 AS passed")
    told = lambda df: sorted(map(tuple, df.select("seq", "id", "instruction", "split").collect()))
    found = export.training_set(pairs, judged, stored=True)
    assert told(found) == told(export.training_set(pairs, judged)) and 0 < found.count() < 100
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange" in line and "instruction" in line]


def test_loop_stores_and_moves_texts_once(spark, monkeypatch):
    monkeypatch.setattr(loop.generate, "generated_pairs", None)   # the join of seeds and answers
    store = DatasetStore(spark, new_folder(spark, "loop"))
    seeds = spark.range(300).selectExpr("id AS seq", "concat_ws(' ', transform(sequence(1, 200), i -> sha2(CAST(id * 1000 + i AS STRING), 256))) AS seed")
    said = F.to_json(F.struct(F.concat(F.lit("Explain: "), "seed").alias("instruction"), F.concat_ws(" ", "seed", "seed").alias("output")))
    echo = lambda requests: requests.filter("seq % 10 <> 9").withColumn("response", said)
    loop.run_loop(store, seeds, echo, judge.rule_scorer, 1)
    size = lambda kind: sum(os.path.getsize(f) for f in glob.glob(f"{store.path(kind, loop_run=1, cycle_id=1)}/*.parquet"))
    assert size("cycle_pairs") < 1.5 * size("cycle_seeds")   # the texts of a pair are four times its seed
    pairs = store.get("cycle_pairs", loop_run=1, cycle_id=1)
    assert pairs.count() == 300 and pairs.filter("output = concat_ws(' ', source_seed, source_seed)").count() == 270
    assert pairs.filter("seq % 10 = 9 AND instruction = source_seed AND output = '[Generation failed]'").count() == 30


def test_incremental_judging_sends_nothing_to_the_driver(spark, pairs_of):
    plans = []

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df)

    pairs = pairs_of([(str(n), f"instruction {n}", "output") for n in range(40)])
    held = stage(judge.cache_rows(judge.judge(pairs.filter("seq < 15"), judge.rule_scorer), judge.BUILTIN, "rule", "m"))
    run = judge.judge_incremental(pairs, held, judge.rule_scorer, backend="rule", model="m", stage=watched, written=1)
    plans += [df._jdf.queryExecution().executedPlan().toString() for df in (run.judgments, run.stats)]
    assert run.stats.first().asDict() == {"hits": 15, "misses": 25, "writes": 25}
    assert len(plans) == 3 and not any("Broadcast" in p for p in plans)
    assert "Broadcast" not in I.raw_turns(spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def test_a_derived_table_is_derived_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    raw = spark.range(60).selectExpr("id AS seq", "concat('instruction ', id % 50) AS prompt", "'text' AS completion")
    raw = raw.mapInArrow(watched, raw.schema)
    curate.run_job(spark, {"dataset": "d", "steps": [{"ingest": {"input": raw}}]}, f"{tmp_path}/job")
    assert spark.read.parquet(f"{tmp_path}/job/pairs/dataset=d").count() == 50 and seen.value == 60


def test_a_full_cache_moves_no_texts(spark, pairs_of):
    plans = []

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df)

    pairs = stage(pairs_of([(str(n), f"instruction {n}", "output") for n in range(20)]))
    held = stage(judge.cache_rows(judge.judge(pairs, judge.rule_scorer), judge.BUILTIN, "rule", "m"))
    run = judge.judge_incremental(pairs, held, judge.rule_scorer, backend="rule", model="m", stage=watched, written=1)
    assert run.stats.first().asDict() == {"hits": 20, "misses": 0, "writes": 0} and run.judgments.count() == 20
    assert len(plans) == 1 and "Exchange" not in plans[0]
