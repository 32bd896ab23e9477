"""Sources, field names, ids, copies, facts about a dataset."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from pairloom.operators import ingest
from pairloom.operators.ordering import first_rows, first_wins, join_groups, last_wins
from pairloom.session import new_folder, stage
from pairloom.sources import readers, store


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def got(df, *columns):
    return [tuple(r) for r in df.orderBy("seq").select(*columns).collect()]


def test_names_and_mapping(spark, tmp_path):
    path = put(tmp_path, "a.jsonl", '{"question":"q","answer":"a"}\n\n  \n{"prompt":"p","text":"t","output":null}\n')
    rows = readers.read_rows(spark, path)
    assert got(ingest.normalize_rows(rows), "instruction", "output") == [("q", "a"), ("p", "")]
    mapped = ingest.normalize_rows(rows, {"output": "text"})
    assert got(mapped, "instruction", "output") == [("q", "a"), ("p", "t")]


def test_null_value_stops_the_search(spark, tmp_path):
    path = put(tmp_path, "a.jsonl", '{"instruction":null,"prompt":"p","output":"x","input":5,"category":true,"label":"no"}')
    assert got(ingest.normalize_rows(readers.read_rows(spark, path)), "instruction", "output", "input", "category") == [("", "x", "5", "True")]


def test_falsy_values_are_empty(spark, tmp_path):
    lines = [json.dumps({"instruction": v, "output": "o"}) for v in (0, False, "", [], {}, 0.0, 1, " s ", 1.5, [1])]
    rows = readers.read_rows(spark, put(tmp_path, "a.jsonl", "\n".join(lines)))
    assert [r[0] for r in got(ingest.normalize_rows(rows), "instruction")] == [""] * 6 + ["1", "s", "1.5", "[1]"]


def test_three_formats_give_the_same_pairs(spark, tmp_path):
    rows = [{"prompt": "hello", "completion": "world"}, {"prompt": 'a "b"\nc', "completion": "x,y"}]
    jsonl = put(tmp_path, "a.jsonl", "\n".join(json.dumps(r) for r in rows))
    listed = put(tmp_path, "b.json", json.dumps(rows, indent=1))
    nested = put(tmp_path, "c.json", json.dumps({"data": rows}))
    csv = put(tmp_path, "d.csv", 'prompt,completion\nhello,world\n"a ""b""\nc","x,y"\n')
    want = [(r["prompt"], r["completion"], str(uuid.uuid5(uuid.NAMESPACE_URL, f"sdf::{r['prompt']}::{r['completion']}"))) for r in rows]
    for path in (jsonl, listed, nested, csv):
        assert got(ingest.ingest(readers.read_rows(spark, path)), "instruction", "output", "id") == want
        assert got(ingest.ingest(readers.read_rows(spark, path), stage=stage), "instruction", "output", "id") == want


def test_csv_keeps_empty_cells_and_spaces(spark, tmp_path):
    rows = readers.read_rows(spark, put(tmp_path, "a.csv", "prompt,completion,input\n a ,,\"\"\nshort\n"))
    assert got(rows, "prompt", "completion", "input") == [(" a ", "", ""), ("short", "", "")]


def test_source_errors(spark, tmp_path):
    with pytest.raises(ValueError):
        readers.source_kind("a.txt")
    with pytest.raises(ValueError):
        readers.source_kind("a.jsonl", "xml")
    with pytest.raises(FileNotFoundError):
        readers.read_rows(spark, str(tmp_path / "none.jsonl"))
    with pytest.raises(Exception, match="malformed JSON"):
        readers.read_rows(spark, put(tmp_path, "bad.jsonl", '{"a":1}\n{"a":1} x\n')).collect()
    with pytest.raises(Exception, match="must be a list of rows"):
        readers.read_rows(spark, put(tmp_path, "bad.json", '{"rows":[1]}')).collect()


def test_bad_lines(spark, tmp_path):
    path = put(tmp_path, "a.jsonl", '{"a":1}\n{"a"\n[1]\n{} {}\n')
    assert [r.line for r in readers.bad_lines(spark, path).orderBy("seq").collect()] == ['{"a"', "{} {}"]
    assert readers.read_jsonl(spark, path, lenient=True).filter("row IS NULL").count() == 2


def test_limit_counts_raw_rows(spark):
    raw = spark.createDataFrame([(0, "", ""), (1, "a", "b"), (2, "a", "b"), (3, "c", "")], "seq bigint, prompt string, completion string")
    assert got(ingest.ingest(raw, limit=3), "seq") == [(1,)]
    assert got(ingest.ingest(raw), "seq") == [(1,), (3,)]
    assert ingest.ingest(raw, limit=0).count() == 0


def test_dedup_is_idempotent_and_partition_free(spark):
    raw = spark.range(2000).selectExpr("id AS seq", "concat('p', CASE WHEN id % 3 = 0 THEN 0 ELSE id % 50 END) AS prompt", "'x' AS completion")
    once = ingest.ingest(raw)
    want = got(once, "seq", "id")
    assert len(want) == 50
    assert got(ingest.drop_exact_copies(once), "seq", "id") == want
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert got(ingest.ingest(raw.repartition(7)), "seq", "id") == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_checksum_ignores_order_but_not_content(spark):
    raw = spark.range(100).selectExpr("id AS seq", "concat('p', id) AS instruction", "'x' AS output")
    a, b = ingest.fingerprint(raw).first(), ingest.fingerprint(raw.orderBy(F.desc("seq"))).first()
    assert a == b and a.row_count == 100
    assert ingest.fingerprint(raw.filter("seq > 0")).first().checksum != a.checksum
    assert ingest.fingerprint(raw.limit(0)).first().checksum == "0"


def test_order_helpers(spark):
    df = spark.createDataFrame([(3, "a", "z"), (1, "a", "x"), (2, "b", "y")], "seq bigint, k string, v string")
    assert sorted(r.v for r in first_wins(df, "k").collect()) == ["x", "y"]
    assert sorted(r.v for r in last_wins(df, "k").collect()) == ["y", "z"]
    assert sorted(r.seq for r in first_rows(df, 2).collect()) == [1, 2]


def test_hot_keys_are_salted_and_lose_nothing(spark):
    rows = spark.range(3000).selectExpr("id AS seq", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 40) END AS k")
    groups = rows.groupBy("k").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    joined = join_groups(rows, groups, "k", "n", "seq", hot_rows=100)
    plain = rows.join(groups, "k")
    assert sorted(map(tuple, joined.select("seq", "k", "first").collect())) == sorted(map(tuple, plain.select("seq", "k", "first").collect()))


def test_stored_records_round_trip(spark, tmp_path):
    raw = spark.createDataFrame([(0, 'é "q"\n', "o", None), (1, "b", "", "cat")], "seq bigint, prompt string, completion string, topic string")
    pairs = ingest.ingest(raw, tag="t", created_at="2024-01-02 03:04:05")
    path = new_folder(spark, "pairs")
    store.write_pairs(pairs, path)
    back = store.load_pairs(spark, path)
    columns = ["id", "instruction", "output", "category", "metadata", "created_at"]
    assert sorted(map(str, back.select(*columns).collect())) == sorted(map(str, pairs.select(*columns).collect()))
    assert sorted(map(str, store.load_pairs(spark, path, tolerant=True).select(*columns).collect())) == sorted(map(str, pairs.select(*columns).collect()))
    assert store.load_pairs_or_empty(spark, path + "-none").count() == 0


def test_csv_export_has_five_columns(spark):
    raw = spark.createDataFrame([(0, "a", 'x"y', None)], "seq bigint, prompt string, completion string, topic string")
    path = new_folder(spark, "csv")
    store.write_pairs(ingest.ingest(raw), path, "csv")
    rows = readers.read_csv(spark, path)
    assert [c for c in rows.columns if c != "seq"] == store.CSV_COLUMNS
    assert got(rows, "instruction", "input", "output", "category") == [("a", "", 'x"y', "")]


def test_tolerant_records(spark, tmp_path):
    good = {"id": "A" * 8 + "-0000-0000-0000-" + "0" * 12, "instruction": "i", "output": "o", "created_at": "2024-01-01T00:00:00Z", "cycle_id": 2}
    lines = [good, {"id": "x"}, {"instruction": None}, {"output": 5}, {"created_at": "never"}, {"metadata": []}, {"cycle_id": 1.5}]
    path = put(tmp_path, "a.jsonl", "\n".join(map(json.dumps, lines)) + '\n"text"\n')
    rows = got(store.load_pairs(spark, path, tolerant=True), "id", "instruction", "cycle_id")
    assert rows == [(good["id"].lower(), "i", 2), ("x", "", None)]


def test_judgment_and_label_files(spark, tmp_path):
    put(tmp_path, "ds.a.jsonl", '{"pair_id":"x","scores":{"overall":8.0},"passed":true}\n{"pair_id":"y","scores":{"coherence":2.0}}\n')
    put(tmp_path, "ds.b.v2.jsonl", '{"pair_id":"x","quality_tier":"low","rubric":{"name":"r","version":2}}\n')
    put(tmp_path, "other.c.jsonl", '{"pair_id":"z"}\n')
    j = store.load_judgments(spark, str(tmp_path), "ds")
    rows = {(r.pair_id, r.tag): (r.scores.coherence, r.scores.overall, r.passed) for r in j.collect()}
    assert rows == {("x", "a"): (8.0, 8.0, True), ("y", "a"): (2.0, 5.0, False), ("x", "b.v2"): (5.0, 5.0, False)}
    labels = put(tmp_path, "labels.jsonl", '{"pair_id":"x","status":"approved"}\nnot json\n{"pair_id":"x","status":"rejected"}\n')
    from pairloom.operators.labels import latest_labels
    assert [(r.pair_id, r.status) for r in latest_labels(store.load_labels(spark, labels)).collect()] == [("x", "rejected")]


def test_places_do_not_depend_on_packing(spark, tmp_path):
    """The same folder split and packed in two ways gives the same rows, also after a second read."""
    from pairloom.operators import checks
    from pairloom.operators.export import ratio_split

    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(12):
        lines = [json.dumps({"prompt": f"question {n % 150} of {i % 5}", "completion": f"answer {n % 150}"}) for n in range(200)]
        (folder / f"{i:02}.jsonl").write_text("\n\n".join(lines) + "\n")
    raw = str(folder) + "/*.jsonl"
    seen = []
    keys = ("spark.sql.files.minPartitionNum", "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for setting in (("2", "128m", "4m"), ("200", "4k", "1")):
            for k, v in zip(keys, setting):
                spark.conf.set(k, v)
            pairs = ingest.ingest(readers.read_rows(spark, raw, "jsonl"))
            facts = checks.check_facts(pairs)
            spark.conf.set(keys[0], "7")
            clean = checks.clean(pairs, facts)
            split = ratio_split(clean, {"a": 0.3, "b": 0.7})
            seen.append((got(pairs, "seq", "id"), got(clean, "seq", "id"), got(split, "seq", "split")))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert seen[0] == seen[1] and len(seen[0][0]) == len(seen[0][1]) == 5 * 150


def test_long_prefixes_agree_with_short_ones(spark, monkeypatch):
    from pairloom.operators import ordering

    df = spark.range(1000).selectExpr("struct(id % 10 AS a, id AS b) AS seq").repartition(7)
    for n in (1, 250, 999, 1000, 5000):
        want = sorted(tuple(r.seq) for r in first_rows(df, n).collect())
        monkeypatch.setattr(ordering, "HEAD_ROWS", 0)
        assert sorted(tuple(r.seq) for r in first_rows(df, n).collect()) == want and len(want) == min(n, 1000)
        monkeypatch.undo()


def test_failed_overwrite_keeps_the_old_table(spark):
    kept = store.DatasetStore(spark, new_folder(spark, "safe"))
    kept.put(spark.range(3), "pairs", dataset="d / x")
    with pytest.raises(Exception, match="no more"):
        kept.put(spark.range(9).selectExpr("IF(id > 5, raise_error('no more'), id) AS id"), "pairs", dataset="d / x")
    assert kept.get("pairs", dataset="d / x").count() == 3
    kept.put(spark.range(0), "pairs", dataset="d / x")
    assert kept.get("pairs", dataset="d / x").count() == 0


def test_cycle_ids_are_read_leniently(spark):
    values = [1, "3", True, 2.0, 3000000000, None, "x", 1.5, "1.5", [1]]
    rows = spark.createDataFrame([(i, json.dumps({"id": str(i), "cycle_id": v})) for i, v in enumerate(values)], "seq int, line string")
    found = ingest.tolerant_pairs(rows.selectExpr("seq", "parse_json(line) AS row"))
    assert {r.seq: r.cycle_id for r in found.collect()} == {0: 1, 1: 3, 2: 1, 3: 2, 4: None, 5: None}
