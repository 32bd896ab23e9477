"""Files cut by many tasks against readers that see them whole."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from pairloom.sources import blocks, readers


@pytest.fixture
def small_blocks(spark):
    """Blocks of a few hundred bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "40"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def cell(rng):
    kind = rng.randrange(6)
    words = lambda n: " ".join(rng.choice(["a", "bb", "é", "日本", "x,y", 'say "hi"']) for _ in range(n))
    return ["", words(3), words(2) + "\n" + words(2), "\n" * rng.randint(1, 4), '"', words(60) + "\n" * 3 + words(60)][kind]


def test_csv_walk_agrees_with_the_csv_module():
    rng = random.Random(1)
    for _ in range(400):
        out = io.StringIO()
        rows = [[cell(rng) for _ in range(3)] for _ in range(4)]
        csv.writer(out, lineterminator="\n").writerows(rows)
        text, state, ends = out.getvalue(), blocks.OUTSIDE, []
        lines = text[:-1].split("\n")
        for n, line in enumerate(lines):
            found, state, _ = blocks.Csv.walk(line, state, 0)
            if found:
                ends.append(n)
        starts = [0, *[e + 1 for e in ends]]
        back = [next(csv.reader(["\n".join(lines[a:b])], lineterminator="\n")) if a != b else [] for a, b in zip(starts, starts[1:])]
        assert [r for r in csv.reader(io.StringIO(text, newline=""))] == rows and len(ends) == len(rows)
        assert len(back) == len(rows)
    assert blocks.Csv.walk('5" disk,"open', 0, 0)[1] == 1 and blocks.Csv.walk('5" disk,b"c', 0, 0)[1] == 0
    assert blocks.Csv.walk('end",5" x', 1, 0)[1] == 0 and blocks.Csv.walk('a ""b', 1, 0)[1] == 1


def test_csv_with_line_breaks_in_many_blocks(spark, tmp_path, small_blocks):
    rng = random.Random(2)
    folder = tmp_path / "files.csv"
    folder.mkdir()
    want = []
    for name in ("a", "b"):
        rows = [[cell(rng), str(i), cell(rng)] for i in range(120)] + [['5" disk', "120", "x"]]
        with open(folder / f"{name}.csv", "w", newline="") as out:
            out.write('prompt,"no","comp ""x"""\r\n')
            csv.writer(out, lineterminator="\r\n" if name == "b" else "\n").writerows(rows)
            out.write("\nshort\n")
        want += [(name, *r) for r in rows] + [(name, "short", "", "")]
    rows = readers.read_rows(spark, str(folder), "csv")
    assert rows.columns == ["seq", "prompt", "no", 'comp "x"']
    got = [(r.seq.file[-5], r.seq.row, *r[1:]) for r in rows.collect()]
    assert [(f, *r) for f, _, *r in sorted(got)] == want
    scanned = spark.read.option("lineSep", "\n").text(str(folder)).select(F.col("_metadata.file_block_start")).distinct().count()
    assert scanned > 20


def test_csv_headers_must_agree(spark, tmp_path):
    folder = tmp_path / "two.csv"
    folder.mkdir()
    (folder / "a.csv").write_text('p,q\n"a\nb",c\n')
    (folder / "b.csv").write_text('p,r\n"a\nb",c\n')
    with pytest.raises(ValueError, match="different headers"):
        readers.read_rows(spark, str(folder), "csv")


def documents(rng, n):
    value = lambda: rng.choice([
        {"a": 'x"},{[', "b": [1, [2, {"c": "}"}]]}, {}, [], 5, None, True, "t{e\\x}t", {"text": "word } " * 40}, ["}", {"q": '\\"}'}], -1.5e3])
    return [value() for _ in range(n)]


def elements(spark, path, **more):
    rows = readers.read_json(spark, path, **more).select("seq", F.to_json("row").alias("row")).collect()
    return [json.loads(r.row) for r in sorted(rows, key=lambda r: (r.seq.file, r.seq.row))]


def test_large_json_documents(spark, tmp_path, small_blocks):
    rng = random.Random(3)
    for n, shape in enumerate(["[%s]", ' \n[%s]\n', '{"data": %s}', '{"x": [1, {"data": [7]}], "n": "}", "data" : %s, "m": {"data": [8]}}  ', '{"data":[9],"data":%s}']):
        rows = documents(rng, 0 if n == 1 else 150)
        body = json.dumps(rows, indent=rng.choice([None, 1]))
        text = shape % (body[1:-1] if "[%s" in shape else body)
        (tmp_path / f"{n}.json").write_text(text)
        assert elements(spark, str(tmp_path / f"{n}.json"), whole_bytes=0) == rows, shape
        assert elements(spark, str(tmp_path / f"{n}.json")) == rows
    folder = tmp_path / "both"
    folder.mkdir()
    (folder / "a.json").write_text("[1]")
    (folder / "b.json").write_text(json.dumps([{"k": i, "pad": "x" * 20} for i in range(100)]))
    assert elements(spark, str(folder), whole_bytes=50) == [1, *[{"k": i, "pad": "x" * 20} for i in range(100)]]


@pytest.mark.parametrize("text", [
    "[1, 2", '[1, "a]', "[1, 2}", '{"data": [1, 2}', "[1] 2", "x [1]", "5", '{"rows": [1]}', '{"data": 5}', "[1,,2]", "[1 2]", "[{}{}]", "[1]]", "{}", "[1],[2]",
    '{"data": [1}]', '[{"a": 1]]'])
def test_malformed_documents_are_errors(spark, tmp_path, text):
    path = str(tmp_path / "bad.json")
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="(?i)json"):
        readers.read_json(spark, path, whole_bytes=0).collect()


def test_places_come_to_the_rows(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("1\n2\n")
    rows = readers.read_jsonl(spark, str(tmp_path / "a.jsonl"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert [r.seq.row for r in rows.orderBy("seq").collect()] == [0, 1]
